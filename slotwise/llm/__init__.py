"""Operators for preparing training text: quality, dedup, scans, tokens, mixing.

Nothing else in the library imports this package; it can be deleted as a whole.
"""
