"""Per-rule summaries ``(rule, tbl, total, count, percent)`` and rule events
``(dag_name, dag_run_id, event_type, event_data)``.

A summary is one global aggregate over the flag column (partial per task,
one tiny merge). Events are built per failing record on the executors with
``to_json`` — nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import RESULT, ident, is_added, sql_str

SUMMARY_COLUMNS = ("rule", "tbl", "total", "count", "percent")
_PERCENT = "CAST(CASE WHEN total = 0 THEN 0.0D ELSE round(`count` * 100.0D / total, 2) END AS DOUBLE) AS percent"


def flag_summary(flagged: DataFrame, rule: str, table: str, flag_col: str) -> DataFrame:
    """One row: rows, flagged rows, and their percentage rounded to 2
    decimals (0.0 for an empty table)."""
    return flags_summary(flagged, table, [(rule, flag_col)])


def flags_summary(flagged: DataFrame, table: str, rule_flags: Sequence[tuple[str, str]]) -> DataFrame:
    """Summary rows for several ``(rule, flag column)`` pairs of one table,
    from a single aggregate (one scan, flag columns only)."""
    agg = flagged.agg(
        F.expr("CAST(count(1) AS BIGINT) AS total"),
        *[
            F.expr(f"CAST(coalesce(sum({ident(flag_col)}), 0) AS BIGINT) AS __dq_s{i}")
            for i, (_, flag_col) in enumerate(rule_flags)
        ],
    )
    per_rule = ", ".join(
        f"struct({sql_str(rule)} AS rule, __dq_s{i} AS `count`)" for i, (rule, _) in enumerate(rule_flags)
    )
    return agg.selectExpr("total", f"inline(array({per_rule}))").selectExpr("rule", f"{sql_str(table)} AS tbl", "total", "`count`", _PERCENT)


def observed_flags(flagged: DataFrame, flag_cols: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``flagged``, which counts its rows (``total``) and the sum of each flag
    (``s0``, ``s1``, …) while it is written."""
    counts = Observation()
    sums = [F.expr(f"sum({ident(c)})").alias(f"s{i}") for i, c in enumerate(flag_cols)]
    return flagged.observe(counts, F.expr("count(1)").alias("total"), *sums), counts


def summary_of_counts(spark: SparkSession, rows: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """Summary of ``(rule, tbl, total, count)`` rows, one per rule and table."""
    return spark.createDataFrame(list(rows), "rule string, tbl string, total long, count long").selectExpr("*", _PERCENT)


def union_all(frames: Iterable[DataFrame]) -> DataFrame | None:
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b), frames)


def result_column(result: DataFrame) -> str:
    """Name of the pass/fail column of a rule result (``result``, or the name it
    was given beside a data column ``result``)."""
    added = [f.name for f in result.schema.fields if is_added(f) and f.name.startswith(RESULT)]
    return added[-1] if added else RESULT


def result_events(result: DataFrame, event_type: str, dag_name: str, dag_run_id: str) -> DataFrame:
    """One event per failing record of a rule result (``result`` False): the
    record itself, as JSON with its null cells, is the event data."""
    verdict = result_column(result)
    data = ", ".join(ident(c) for c in result.columns if c != verdict)
    return result.where(f"NOT {ident(verdict)}").selectExpr(
        f"{sql_str(dag_name)} AS dag_name",
        f"{sql_str(dag_run_id)} AS dag_run_id",
        f"{sql_str(event_type)} AS event_type",
        f"to_json(struct({data}), map('ignoreNullFields', 'false')) AS event_data",
    )
