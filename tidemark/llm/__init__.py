"""Operators for preparing language-model training data, each over whole tables.

Nothing else in the library imports this package; ``queries`` registers them.
"""
