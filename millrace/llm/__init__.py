"""Operators for training data of language models.

Optional: nothing outside this sub-package imports it.
"""
