"""Operators for preparing training text: splitting, packing, contamination search and redaction.

Nothing outside this package imports it.
"""
