"""Operators that prepare training data for language models.

Nothing else in the library imports this subpackage.
"""
