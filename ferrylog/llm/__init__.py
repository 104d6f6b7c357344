"""Operators that prepare large text collections for training.

Nothing else in the library imports this subpackage.
"""
