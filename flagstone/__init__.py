"""flagstone — configuration-driven data-quality checks as Spark plans.

Rules append 0/1 flag columns to the rows of each table (row count kept),
and produce reports, summaries and events as lazy DataFrames.
"""

__version__ = "0.1.0"
