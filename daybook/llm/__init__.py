"""Operators for preparing training text at corpus scale.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``queries`` holds the thin registered queries.
"""
