"""Whole flows composed from operators."""
