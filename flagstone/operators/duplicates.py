"""Duplicate-key rules.

Plan shape (all variants): one hash aggregation on the key columns — run as
a map-side partial aggregate, so even a key holding a third of all rows is
pre-summed inside each input task before anything is shuffled — then one join
of the rows to the (keys, count) groups, see
:func:`~flagstone.operators.skew.keyed_join`. Text keys take the same path.
There is no window over the key, so no task ever holds a whole key group, and
the row count is kept exactly.

For keys of really long text (whole documents) the caller can pass
``long_text=True``: text and binary key columns are then compared by their
SHA-256 digest and length, so 40 bytes are shuffled and sorted instead of the
text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import DUP_COUNT, DUP_FLAG, FLAG_DUPLICATION, RESULT, added_name, ident, mark_added
from .skew import key_counts, keyed_join, non_null_keys_sql, row_fingerprint_sql

COUNTS = "counts"
_ROWS = "__dq_rows"
_N = "__dq_n"
_WIDE = (T.StringType, T.BinaryType)


def _check_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    keys = list(keys)
    if not keys:
        raise ValueError("duplicate rules need at least one key column")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not in table: {missing}")
    return keys


def duplicate_groups(df: DataFrame, keys: Sequence[str], count_col: str = COUNTS) -> DataFrame:
    """Keys that occur at least twice, with their row count.

    Rows with a null in any key column belong to no group (as a pandas
    group-by drops them).
    """
    keys = _check_keys(df, keys)
    return key_counts(df, keys, count_col, null_keys=False).where(f"{ident(count_col)} >= 2")


def _key_sql(df: DataFrame, keys: Sequence[str], long_text: bool) -> list[str]:
    """One SQL expression per key column: the column, or its digest and length."""
    out = []
    for k in keys:
        if long_text and isinstance(df.schema[k].dataType, _WIDE):
            digest = f"struct(unhex(sha2({ident(k)}, 256)) AS h, octet_length({ident(k)}) AS n)"
            out.append(f"CASE WHEN {ident(k)} IS NOT NULL THEN {digest} END")
        else:
            out.append(ident(k))
    return out


def _dup_join(
    df: DataFrame, keys: Sequence[str], source: DataFrame | None = None, how: str = "left", long_text: bool = False
) -> DataFrame:
    """``df`` + ``__dq_n``: size of the row's key group when >= 2, else null.

    ``source`` — a table with the same rows and key columns as ``df`` (e.g.
    the input before earlier rules appended flags) — is where the per-key
    counts are computed, so earlier rules' joins are not re-run for them."""
    src = df if source is None else source
    names = [f"__dq_key{i}" for i in range(len(keys))]
    keyed = src.selectExpr(*[f"{e} AS {n}" for e, n in zip(_key_sql(src, keys, long_text), names, strict=True)])
    groups = key_counts(keyed, names, _ROWS, null_keys=False).where(f"{_ROWS} >= 2").selectExpr(*names, f"{_ROWS} AS {_N}")
    if not long_text:
        return keyed_join(df, groups, keys, names, how, side_out=[_N])
    own = [f"__dq_own{i}" for i in range(len(keys))]
    rows = df.selectExpr(*[ident(c) for c in df.columns], *[f"{e} AS {n}" for e, n in zip(_key_sql(df, keys, True), own, strict=True)])
    return keyed_join(rows, groups, own, names, how, side_out=[_N]).drop(*own)


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], source: DataFrame | None = None, long_text: bool = False
) -> DataFrame:
    """All rows of ``df`` plus ``dup_count`` (size of the key group when it is
    at least 2, else 0, as bigint) and ``dup_flag`` (1 when duplicated).

    Data columns that have one of these names stay; the added column then gets
    the suffix ``_qc``."""
    keys = _check_keys(df, keys)
    count, flag = added_name(df, DUP_COUNT), added_name(df, DUP_FLAG)
    base = [c for c in df.columns if c not in (count, flag)]
    joined = _dup_join(df.select(*[ident(c) for c in base]), keys, source, "left", long_text)
    out = joined.selectExpr(
        *[ident(c) for c in base],
        f"CAST(coalesce({_N}, 0) AS BIGINT) AS {ident(count)}",
        f"CAST(CASE WHEN {_N} IS NULL THEN 0 ELSE 1 END AS INT) AS {ident(flag)}",
    )
    return mark_added(out, count, flag)


def _report(rows: DataFrame, keys: Sequence[str], counts: str, rest: Sequence[str], order: bool) -> DataFrame:
    counts_name = COUNTS if COUNTS not in (*keys, *rest) else COUNTS + "_qc"
    out = rows.selectExpr(*[ident(k) for k in keys], f"CAST({ident(counts)} AS BIGINT) AS {counts_name}", *[ident(c) for c in rest])
    if not order:
        return out
    # The tie-breaker only orders rows inside a key group; it lets the range
    # partitioner cut a hot key across several sort tasks. It is a function
    # of the row (not of its position), so a retried task sorts the same.
    return out.orderBy(*[F.expr(ident(k)) for k in keys], F.expr(row_fingerprint_sql(out)))


def duplicate_report(df: DataFrame, keys: Sequence[str], order: bool = True) -> DataFrame:
    """Only the duplicated rows: key columns, ``counts``, then the other
    columns, sorted by the keys when ``order`` (a range-partitioned sort;
    rows of one key stay in input order only within a partition). An inner
    join of the rows that have a key to the groups."""
    keys = _check_keys(df, keys)
    rest = [c for c in df.columns if c not in keys and c not in (added_name(df, DUP_COUNT), added_name(df, DUP_FLAG))]
    return _report(_dup_join(df.where(non_null_keys_sql(keys)), keys, how="inner"), keys, _N, rest, order)


def report_from_flags(flagged: DataFrame, keys: Sequence[str], order: bool = True) -> DataFrame:
    """Duplicate report derived from an already flagged table (no new join)."""
    count, flag = added_name(flagged, DUP_COUNT), added_name(flagged, DUP_FLAG)
    rest = [c for c in flagged.columns if c not in keys and c not in (count, flag)]
    return _report(flagged.where(f"{ident(flag)} = 1"), keys, count, rest, order)


def flag_duplicates_first_key(df: DataFrame, keys: Sequence[str], flag_col: str = FLAG_DUPLICATION) -> DataFrame:
    """The older Spark flavour: a row is flagged when the number of non-null
    values of the *first* key in its key group exceeds 1. Null keys do group
    with each other here (as a window partition would), and a null first key
    counts 0. Computed as aggregate + null-safe join, not as a window, so a
    hot group is partially aggregated instead of landing in one task."""
    keys = _check_keys(df, keys)
    flag = added_name(df, flag_col)
    counts = df.groupBy(*[ident(k) for k in keys]).agg(F.expr(f"count({ident(keys[0])}) AS {_N}")).where(f"{_N} > 1")
    names = [f"__dq_key{i}" for i in range(len(keys))]
    side = counts.selectExpr(*[f"{ident(k)} AS {n}" for k, n in zip(keys, names, strict=True)], _N)
    base = [c for c in df.columns if c != flag]
    joined = keyed_join(df.select(*[ident(c) for c in base]), side, keys, names, "left", null_safe=True, side_out=[_N])
    out = joined.selectExpr(
        *[ident(c) for c in base], f"CAST(CASE WHEN {_N} IS NULL THEN 0 ELSE 1 END AS INT) AS {ident(flag)}"
    )
    return mark_added(out, flag)


def unique_key(df: DataFrame, keys: Sequence[str], source: DataFrame | None = None, long_text: bool = False) -> DataFrame:
    """All rows plus boolean ``result``: True when the key occurs once (rows
    with a null key pass). A data column named ``result`` stays; the added one
    is then ``result_qc``."""
    keys = _check_keys(df, keys)
    result = added_name(df, RESULT)
    base = [c for c in df.columns if c != result]
    joined = _dup_join(df.select(*[ident(c) for c in base]), keys, source, "left", long_text)
    return mark_added(joined.selectExpr(*[ident(c) for c in base], f"{_N} IS NULL AS {ident(result)}"), result)
