"""tidemark: point-in-time market and filings analytics as Spark DataFrame transforms.

``functions``  Column expressions (no Python UDFs)
``sources``    readers and sinks with explicit schemas
``operators``  keyed, windowed, joining and checking transforms
``plans``      whole tables built from the operators
``streaming``  Structured Streaming forms of the gating and upsert operators
"""

__version__ = "0.1.0"
