"""Database tables through Spark's JDBC source and sink.

``postgres://user:password@host:port/db`` style URLs (password
percent-decoded) are turned into a JDBC URL plus properties. Reads of large
tables should give ``partition_column`` and bounds so Spark opens
``num_partitions`` parallel range queries instead of one.
"""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def parse_db_url(url: str) -> tuple[str, dict[str, str]]:
    """``(jdbc_url, {user, password})`` from ``scheme://user:pw@host:port/db``.
    A URL that already starts with ``jdbc:`` is returned unchanged."""
    if url.startswith("jdbc:"):
        return url, {}
    p = urlparse(url)
    scheme = {"postgres": "postgresql"}.get(p.scheme, p.scheme)
    host = p.hostname or "localhost"
    port = f":{p.port}" if p.port else ""
    props = {}
    if p.username:
        props["user"] = unquote(p.username)
    if p.password:
        props["password"] = unquote(p.password)
    return f"jdbc:{scheme}://{host}{port}{p.path}", props


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
    **options,
) -> DataFrame:
    """A query or table of a database as a DataFrame."""
    jdbc_url, props = parse_db_url(url)
    r = spark.read.format("jdbc").option("url", jdbc_url).option("fetchsize", fetch_size)
    for k, v in {**props, **options}.items():
        r = r.option(k, v)
    if partition_column:
        if table is None:
            if query is None:
                raise ValueError("give a query or a table")
            table = f"({query}) AS q"
        r = (
            r.option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions or 8)
        )
    elif query is not None:
        r = r.option("query", query)
    elif table is not None:
        r = r.option("dbtable", table)
    else:
        raise ValueError("give a query or a table")
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10000, **options) -> None:
    """Write a DataFrame (flags, reports) to a database table in parallel."""
    jdbc_url, props = parse_db_url(url)
    w = df.write.format("jdbc").mode(mode).option("url", jdbc_url).option("dbtable", table)
    w = w.option("batchsize", batch_size)
    for k, v in {**props, **options}.items():
        w = w.option(k, v)
    w.save()
