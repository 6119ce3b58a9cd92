"""Operators for preparing large text corpora for training.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``catalog`` registers one query per operator.
"""
