"""Operators and pipelines run over the driver tables, each with its DuckDB statement.

The driver tables stand in for the financial feeds: users and customers for securities,
days for sessions, orders for filings, line items for facts, positions and trades.
"""

from tidemark.catalog.base import ENTRIES, SQL
from tidemark.catalog import (  # noqa: F401  registration
    quality, history, listings, identity, documents, fundamentals, ownership, benchmark, gates, read_model, streams, landed,
    releases, disclosures,
)

__all__ = ["ENTRIES", "SQL"]
