"""Operators for preparing training data: filters, searches, near copies, archives, tokens."""
