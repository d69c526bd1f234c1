"""tidemark.sources."""
