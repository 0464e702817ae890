"""Operators that prepare training text: archives, filters, near copies, mixing, private data."""
