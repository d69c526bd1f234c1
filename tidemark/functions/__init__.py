"""tidemark.functions."""
