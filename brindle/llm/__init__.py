"""Operators on the documents of a text corpus."""
