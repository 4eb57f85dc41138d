"""Readers: page captures, the message log, the posting collection."""
