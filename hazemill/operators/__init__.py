"""Cleaning, constraint checks, loading and ranking."""
