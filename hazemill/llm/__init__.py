"""Operators for preparing training data: quality, dedup, secrets, formatting, scoring, tokens."""
