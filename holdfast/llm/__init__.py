"""Operators that prepare training text, each with one query over its whole table."""
