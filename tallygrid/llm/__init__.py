"""Operators for preparing training text: cleaning, filtering, near duplicates, tokens."""
