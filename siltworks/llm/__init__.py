"""Operators for training-data corpora on documents; nothing else in the library imports them."""
