"""Operators for preparing language-model training data.

Each module holds one operator with its general interface; ``queries``
registers the queries over the benchmark tables.
"""
