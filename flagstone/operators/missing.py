"""Missing-value rule.

The flag is a pure projection (no shuffle). The per-column report is one
global aggregate with a conditional count per column — Spark computes it as
partial sums per task and a single tiny final merge — then turned tall with
``inline``, so the table is scanned once whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    FLAG_MISSING,
    MISSING_FLAG,
    added_name,
    any_sql,
    data_columns,
    flag_sql,
    is_missing_sql,
    mark_added,
    sql_str,
)
from .cells import CellTest


def _columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is None or len(columns) == 0:
        return data_columns(df)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")
    return list(columns)


def flag_missing(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    blank_is_missing: bool = True,
    flag_col: str = MISSING_FLAG,
) -> DataFrame:
    """Append ``missing_flag`` = 1 when any checked column is null, NaN or
    (strings) blank. ``columns`` None or empty checks every data column."""
    cols = _columns(df, columns)
    cond = any_sql([is_missing_sql(df, c, blank_is_missing) for c in cols])
    flag = added_name(df, flag_col)
    return mark_added(df.withColumn(flag, F.expr(flag_sql(cond))), flag)


def flag_missing_null_only(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Older Spark flavour: only null and NaN are missing; flag ``flag_missing``."""
    return flag_missing(df, columns, blank_is_missing=False, flag_col=FLAG_MISSING)


def missing_tests(df: DataFrame, report: str, columns: Sequence[str] | None = None, blank_is_missing: bool = True) -> list[CellTest]:
    """The cells that :func:`missing_by_column` counts."""
    return [CellTest(report, c, is_missing_sql(df, c, blank_is_missing), listed=False) for c in _columns(df, columns)]


def missing_by_column(
    df: DataFrame,
    table: str,
    columns: Sequence[str] | None = None,
    blank_is_missing: bool = True,
) -> DataFrame:
    """Report ``(column, missing, tbl)``: one row per checked column with the
    number of missing cells (bigint)."""
    cols = _columns(df, columns)
    counts = df.agg(
        *[
            F.expr(f"count(CASE WHEN {is_missing_sql(df, c, blank_is_missing)} THEN 1 END) AS __dq_m{i}")
            for i, c in enumerate(cols)
        ]
    )
    rows = ", ".join(
        f"struct({sql_str(c)} AS column, CAST(__dq_m{i} AS BIGINT) AS missing, {sql_str(table)} AS tbl)"
        for i, c in enumerate(cols)
    )
    return counts.selectExpr(f"inline(array({rows}))")
