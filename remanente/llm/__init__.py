"""Operators that prepare training text: filters, deduplication, tokens and sketches."""
