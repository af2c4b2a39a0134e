"""Writers: transcripts, reports, training sets, manifests."""
