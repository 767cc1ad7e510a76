"""Rules on numeric fields: text that is not a non-negative number, and
negative numbers.

Columns are picked by a name token (schema only, on the driver). Flags are
projections; the report of offending values is built in long form — one row
per distinct (table, column, value) — with a single scan (``inline`` of one
struct per checked column) followed by a partially aggregated ``distinct``.
It is never collected into one array per column, because the set of bad
values in a free-text column has no size bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    FLAG_VALUES,
    NEGATIVE_FLAG,
    VALUE_FLAG,
    added_name,
    any_sql,
    flag_sql,
    ident,
    is_nan_sql,
    is_nonneg_decimal_sql,
    mark_added,
    match_columns,
    sql_str,
    to_number_sql,
)
from .cells import CellTest


def value_columns(df: DataFrame, token: str = "value", columns: Sequence[str] | None = None) -> list[str]:
    """Explicit ``columns`` win; else every column whose name holds ``token``."""
    if columns:
        absent = [c for c in columns if c not in df.columns]
        if absent:
            raise ValueError(f"columns not in table: {absent}")
        return list(columns)
    return match_columns(df, contains=token)


def _bad(df: DataFrame, name: str, null_is_bad: bool) -> str:
    bad = f"NOT {is_nonneg_decimal_sql(df, name)}"
    if null_is_bad:
        return bad
    return f"{bad} AND {ident(name)} IS NOT NULL"


def flag_non_numeric(
    df: DataFrame,
    token: str = "value",
    columns: Sequence[str] | None = None,
    null_is_bad: bool = True,
    flag_col: str = VALUE_FLAG,
) -> DataFrame:
    """Append ``value_flag`` = 1 when any checked column fails the
    non-negative decimal test (null fails too unless ``null_is_bad=False``).
    A table without a matching column is returned unchanged (no flag)."""
    cols = value_columns(df, token, columns)
    if not cols:
        return df
    cond = any_sql([_bad(df, c, null_is_bad) for c in cols])
    flag = added_name(df, flag_col)
    return mark_added(df.withColumn(flag, F.expr(flag_sql(cond))), flag)


def flag_non_numeric_spark(df: DataFrame, token: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    """Older Spark flavour of the same test, flag column ``flag_values``."""
    return flag_non_numeric(df, token, columns, null_is_bad=True, flag_col=FLAG_VALUES)


def _offending(df: DataFrame, name: str) -> str:
    return f"{_bad(df, name, null_is_bad=False)} AND NOT {is_nan_sql(df, name)}"


def offending_tests(df: DataFrame, report: str, token: str = "value", columns: Sequence[str] | None = None) -> list[CellTest]:
    """The cells that :func:`offending_values` lists."""
    return [CellTest(report, c, _offending(df, c)) for c in value_columns(df, token, columns)]


def offending_values(
    df: DataFrame,
    table: str,
    token: str = "value",
    columns: Sequence[str] | None = None,
) -> DataFrame | None:
    """Report ``(tbl, column, value)``: each distinct value that fails the
    test, as text; null and NaN are not values and are left out. None when
    the table has no matching column."""
    cols = value_columns(df, token, columns)
    if not cols:
        return None
    cells = ", ".join(
        f"struct({sql_str(c)} AS column, CASE WHEN {_offending(df, c)} THEN CAST({ident(c)} AS STRING) END AS value)" for c in cols
    )
    return (
        df.selectExpr(f"inline(array({cells}))")
        .where("value IS NOT NULL")
        .selectExpr(f"{sql_str(table)} AS tbl", "column", "value")
        .distinct()
    )


def _negative(df: DataFrame, cols: Sequence[str]) -> str:
    return any_sql([f"{to_number_sql(df, c)} < 0" for c in cols])


def negative_rows(df: DataFrame, token: str = "value", columns: Sequence[str] | None = None) -> DataFrame | None:
    """Rows where any checked column, read as a number (text that is not a
    number is ignored), is below zero. None when no column matches."""
    cols = value_columns(df, token, columns)
    if not cols:
        return None
    return df.where(F.expr(_negative(df, cols)))


def flag_negative(
    df: DataFrame,
    token: str = "value",
    columns: Sequence[str] | None = None,
    flag_col: str = NEGATIVE_FLAG,
) -> DataFrame:
    """Append ``negative_flag`` = 1 for rows :func:`negative_rows` returns."""
    cols = value_columns(df, token, columns)
    if not cols:
        return df
    flag = added_name(df, flag_col)
    return mark_added(df.withColumn(flag, F.expr(flag_sql(_negative(df, cols)))), flag)
