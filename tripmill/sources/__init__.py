"""Readers of landed files and of the tables written by earlier steps."""
