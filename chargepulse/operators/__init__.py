"""Relational operators: record parsing, dimension lookups, indicators."""
