"""Operators for preparing training text: filters, near-duplicates, tokenisation, archives, scoring."""
