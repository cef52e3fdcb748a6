"""Keyed, ordered, joining, aggregating and checking DataFrame transforms."""
