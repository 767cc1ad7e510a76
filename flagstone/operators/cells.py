"""Reports on single cells, all of a table from one scan.

Missing cells per column, offending values and unparsed dates ask the same of a
table: which cells of a column are hit, and with which text. The tests of all
such reports are evaluated in one projection, a generator makes one row per hit
cell, and one aggregate counts them by (test, text). Rows without a hit make
none, and a text or column that holds most rows is one row per task before the
shuffle. Reports are then read from the counts, not from the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ident, sql_str, unparsed_sql, with_clean_dates


@dataclass(frozen=True)
class CellTest:
    """Cells of ``column`` that ``report`` names: where ``hit`` (SQL over the table)
    holds or, with ``dt_type``, where something stands that reads as no date of that type.
    A test with ``listed`` reports their distinct texts, else their number; a listed
    ``hit`` must not hold for null."""

    report: str
    column: str
    hit: str = ""
    listed: bool = True
    dt_type: str | None = None


def cell_counts(df: DataFrame, tests: Sequence[CellTest]) -> DataFrame:
    """``(report, column, value, n)``: hit cells by test and text (null where a
    test does not list its texts)."""
    dated = dict.fromkeys(t.column for t in tests if t.dt_type not in (None, "float"))
    rows, clean = with_clean_dates(df, list(dated))
    values = []
    for i, t in enumerate(tests):
        hit = t.hit if t.dt_type is None else unparsed_sql(df, t.column, t.dt_type, clean)
        text = f"CAST({ident(t.column)} AS STRING)" if t.listed else "''"
        values.append(f"CASE WHEN {hit} THEN {text} END AS __dq_v{i}")
    # evaluated in a projection of their own, which is compiled; a generator's input is not
    cells = ", ".join(f"struct({i} AS cell, __dq_v{i} AS value)" for i in range(len(tests)))
    hits = rows.selectExpr(*values).selectExpr(f"inline(filter(array({cells}), x -> x.value IS NOT NULL))")
    counts = hits.groupBy("cell", "value").agg(F.count(F.lit(1)).alias("n"))
    of = {k: "array(" + ", ".join(sql_str(getattr(t, k)) for t in tests) + ")[cell]" for k in ("report", "column")}
    listed = "array(" + ", ".join(str(t.listed).lower() for t in tests) + ")[cell]"
    return counts.selectExpr(f"{of['report']} AS report", f"{of['column']} AS column", f"CASE WHEN {listed} THEN value END AS value", "n")


def listed_report(counts: DataFrame, report: str, table: str) -> DataFrame:
    """``(tbl, column, value)``: the distinct texts that a report lists."""
    return counts.where(F.col("report") == report).select(F.lit(table).alias("tbl"), "column", "value")


def counted_report(counts: DataFrame, report: str, table: str, columns: Sequence[str]) -> DataFrame:
    """``(column, missing, tbl)``: one row per column with the number of its hit cells."""
    sums = [f"coalesce(sum(CASE WHEN column = {sql_str(c)} THEN n END), 0L) AS __dq_m{i}" for i, c in enumerate(columns)]
    totals = counts.where(F.col("report") == report).agg(*[F.expr(s) for s in sums])
    rows = ", ".join(f"struct({sql_str(c)} AS column, __dq_m{i} AS missing, {sql_str(table)} AS tbl)" for i, c in enumerate(columns))
    return totals.selectExpr(f"inline(array({rows}))")
