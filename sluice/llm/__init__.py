"""Operators for preparing language-model training data.

Nothing else in the library imports this package; ``queries`` and ``oracles`` hold its
registered queries and their SQL.
"""
