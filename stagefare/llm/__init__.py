"""Operators for preparing text to train language models on.

Nothing outside this package imports it; ``queries.py`` registers one query per
operator. Each operator's module states the method, its parameters and its
result for nulls, empty texts, ties and empty tables.
"""
