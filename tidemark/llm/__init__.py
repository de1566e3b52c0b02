"""Operators that prepare training text: archives, cleaning, de-duplication, tokens."""
