"""Incremental counterparts of the batch products."""
