"""Readers: file listings, recordings, transcripts, references, training pairs."""
