"""Readers of raw text and the versioned table."""
