"""Event logs and keyed state, in batch and as streams."""
