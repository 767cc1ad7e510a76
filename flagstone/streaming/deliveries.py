"""Checking deliveries as they arrive, with Structured Streaming.

Row-local rules (missing values, non-numeric text, negatives) are plain
projections, so they run unchanged on a streaming DataFrame
(:func:`flag_stream`). Rules that need a whole table (duplicates, date
bounds, membership) run per micro-batch through ``foreachBatch``
(:func:`start_delivery_checks`): each batch is the set of rows that arrived
together, which is what a delivery is. A key that occurs once in each of two
batches is therefore not a duplicate here; check stored tables for that.
Progress is kept in the checkpoint location that the caller names: started
again with the same one, a query resumes where it stopped, and the output of a
batch that is retried is replaced, not duplicated.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.missing import flag_missing
from ..operators.numeric import flag_negative, flag_non_numeric
from ..plans.runner import RunOptions, run_rules
from ..sources.delivery import DELIVERY_ENCODING, DELIVERY_GLOB, DELIVERY_SEP

# Rules that look at one row at a time and so need no state.
ROW_RULES = ("missing", "string_tables", "negative")


def read_delivery_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str = DELIVERY_GLOB,
    sep: str = DELIVERY_SEP,
    encoding: str | None = DELIVERY_ENCODING,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New delimited files of ``folder`` as a stream (schema required)."""
    r = spark.readStream.schema(schema).option("header", True).option("sep", sep).option("pathGlobFilter", pattern)
    if encoding:
        r = r.option("encoding", encoding)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(folder)


def flag_stream(
    stream: DataFrame, table: str, rules: Mapping, sequence: Sequence[str], options: RunOptions | None = None
) -> DataFrame:
    """Apply the row-local rules of ``sequence`` to a streaming DataFrame
    that carries table ``table``, with the same configuration shapes as a
    batch run (per-table missing columns, ``string_tables`` / ``negative``
    token and optional table list)."""
    opts = options or RunOptions()
    out = stream
    for rule in sequence:
        cfg = rules.get(rule)
        if rule not in ROW_RULES or cfg is None:
            continue
        if rule == "missing":
            out = flag_missing(out, (cfg or {}).get(table) or None, opts.blank_is_missing)
            continue
        if isinstance(cfg, Mapping):
            token, tables = cfg.get("value", "value"), cfg.get("tables")
        else:
            token, tables = "value", list(cfg)
        if tables and table not in tables:
            continue
        if rule == "string_tables":
            out = flag_non_numeric(out, token, null_is_bad=opts.null_is_bad)
        else:
            out = flag_negative(out, token)
    return out


def start_delivery_checks(
    stream: DataFrame,
    table: str,
    rules: Mapping,
    sequence: Sequence[str],
    output: str,
    checkpoint: str,
    reference_tables: Mapping[str, DataFrame] | None = None,
    options: RunOptions | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Run the full rule sequence on every micro-batch of ``stream``.

    The batch is table ``table``; ``reference_tables`` (e.g. a stored
    anchor table for the date rules) are added to each run. Flagged rows
    go to ``output/batch=<id>`` (Parquet), replaced if a batch is retried.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        tables = {table: batch, **(reference_tables or {})}
        res = run_rules(tables, rules, sequence, options=options)
        res.tables[table].withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            os.path.join(output, f"batch={batch_id}")
        )

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
