"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries.py`` holds the thin ``opN_<name>`` queries that
apply them to the given tables.
"""
