"""Operators and queries for preparing training text at scale (ten operators, see README)."""
