"""Operators: clean, dimensions, facts, dense keys, lookups, quality."""
