"""Operators that prepare a text corpus for training language models; nothing else in the library imports this."""
