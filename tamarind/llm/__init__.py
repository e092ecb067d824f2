"""Operators that prepare text corpora for training language models.

Nothing else in the library imports this subpackage.
"""
