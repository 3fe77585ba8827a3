"""Operators for building language-model training data at scale.

Nothing outside this folder imports it; ``queries.py`` lists the registered queries and their SQL.
"""
