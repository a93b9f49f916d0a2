"""Operators for preparing training data: dedup, filters, scoring, tokens and mixing."""
