"""Whole jobs over stored tables, put together from operators, readers and writers."""
