"""Readers, writers and small dimensions."""
