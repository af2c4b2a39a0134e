"""DataFrame operators over recordings, transcripts, metrics and training pairs."""
