"""Operators for building language-model training data.

Each module holds one operator; ``catalogue`` registers the queries that apply them
to whole tables.  Nothing else in the library imports this package.
"""
