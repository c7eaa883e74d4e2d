"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; ``queries.py`` lists the
queries that the entry module registers.
"""
