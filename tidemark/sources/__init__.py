"""Readers with explicit schemas and sinks with contract checks."""

from tidemark.sources.feeds import *  # noqa: F401,F403
from tidemark.sources.market import *  # noqa: F401,F403
from tidemark.sources.filings import *  # noqa: F401,F403
from tidemark.sources.rejects import *  # noqa: F401,F403
from tidemark.sources.sinks import *  # noqa: F401,F403
