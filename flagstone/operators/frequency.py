"""Frequency tables: how often each combination of values occurs.

The configuration only declares this rule (``{table: {label: [columns]}}``)
without giving it behaviour; here it is a group-by count per label, computed
with partial aggregation so hot value combinations are summed inside each
task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, ident, sql_str


def frequency(df: DataFrame, columns: Sequence[str], table: str | None = None, label: str | None = None) -> DataFrame:
    """``columns…, count`` (bigint), plus ``tbl`` / ``label`` when given.
    Null is a value of its own, as in SQL ``GROUP BY``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")
    out = df.groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    if label is not None:
        out = out.withColumn("label", F.lit(str(label)))
    if table is not None:
        out = out.withColumn("tbl", F.lit(table))
    return out


_SET = "__dq_set"


def frequencies(df: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """The frequency tables of all ``labels`` from one pass over ``df``: every
    column that any label names, a count, and ``__dq_set``, which tells the
    column lists apart (:func:`frequency_of` reads one label).

    Grouping sets over the distinct column lists: a task counts each row once
    per list before anything is shuffled."""
    for cols in labels.values():
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"columns not in table: {missing}")
    names = list(dict.fromkeys(c for cols in labels.values() for c in cols))
    keys = {c: f"__dq_g{i}" for i, c in enumerate(names)}
    sets = list(dict.fromkeys(tuple(c for c in names if c in cols) for cols in labels.values()))
    rows = df.selectExpr(*[f"{ident(c)} AS {k}" for c, k in keys.items()])
    counted = rows.groupingSets([[F.col(keys[c]) for c in s] for s in sets], *[F.col(k) for k in keys.values()])
    out = counted.agg(F.expr("count(1) AS __dq_n"), F.expr(f"CAST(grouping_id() AS BIGINT) AS {_SET}"))
    return out.selectExpr(*[f"{k} AS {ident(c)}" for c, k in keys.items()], "__dq_n", _SET)


def _set_of(found: DataFrame, columns: Sequence[str]) -> int:
    """The grouping id of a column list: a bit for each column that it leaves out."""
    names = found.columns[:-2]
    return sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in columns)


def frequency_rows(found: DataFrame, labels: Mapping[str, Sequence[str]], table: str) -> DataFrame:
    """All labels of :func:`frequencies` in long form, ``tbl, label, value, count``
    (``value`` the cells of the label's columns as text), without a second pass."""
    cases: dict[int, list[str]] = {}
    for label, cols in labels.items():
        value = ", ".join(f"CAST({ident(c)} AS STRING)" for c in cols)
        cases.setdefault(_set_of(found, cols), []).append(f"struct({sql_str(str(label))} AS label, array({value}) AS value)")
    chosen = " ".join(f"WHEN {mask} THEN array({', '.join(each)})" for mask, each in cases.items())
    return found.selectExpr(f"{sql_str(table)} AS tbl", "__dq_n AS `count`", f"inline(CASE {_SET} {chosen} END)").select("tbl", "label", "value", "count")


def frequency_of(found: DataFrame, columns: Sequence[str], table: str | None = None, label: str | None = None) -> DataFrame:
    """One label of :func:`frequencies`: ``columns…, count``, plus ``label`` / ``tbl`` when given."""
    out = found.where(f"{_SET} = {_set_of(found, columns)}").selectExpr(*[ident(c) for c in columns], "__dq_n AS `count`")
    if label is not None:
        out = out.withColumn("label", F.lit(str(label)))
    if table is not None:
        out = out.withColumn("tbl", F.lit(table))
    return out
