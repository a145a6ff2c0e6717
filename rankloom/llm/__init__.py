"""Operators for the preparation of training text, and their queries (``plans``).

Nothing else in the library imports this package.
"""
