"""Operators for building training corpora.

One module per operator; ``queries.py`` registers the thin ``opN_`` queries over
the given tables. Nothing outside this package imports it.
"""
