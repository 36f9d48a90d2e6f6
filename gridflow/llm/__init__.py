"""Operators that turn a text corpus into training data; nothing else in the library imports them."""
