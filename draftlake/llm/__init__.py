"""Operators that turn a corpus of contest transcripts into training data; nothing else in the library imports them."""
