"""Structured Streaming versions of the incremental loaders."""
