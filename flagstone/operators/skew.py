"""Equi-joins of rows to a per-key side table that survive skewed keys.

Every rule that brings per-key facts back to the rows (duplicate counts,
limit dates per id, membership of ids) joins the full table to a side with
one row per key. The side is an aggregate, so a plain join would reuse the
aggregate's partitioning and adaptive execution could not split a partition
that one key (or the null key) fills: all its rows would meet in one task.

The side is therefore rebalanced once more after its aggregate (one narrow row
per key). Both inputs of the join are then bare shuffles, and adaptive
execution measures each partition in bytes: a partition above
``spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes`` is cut along
its map outputs into tasks of the advisory size, each of which reads the one
side partition it needs. Rows are never salted, sampled or ranked, so no
setting changes a result, and a side that is measured to be small is still
broadcast.

Keys of two types are brought to one declared type before anything else
(:func:`common_key_type`): the same expression is shuffled, compared and
matched. Decimals of more than 64 bits sort slowly, as long ids agree in the
digits that a sort compares first; a hash of the key goes before them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ident

_N = "__dq_key_rows"
_KEY = "__dq_join_key"
_HASH = "__dq_join_hash"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def non_null_keys_sql(keys: Sequence[str]) -> str:
    return " AND ".join(f"{ident(k)} IS NOT NULL" for k in keys)


def key_counts(rows: DataFrame, keys: Sequence[str], n_col: str = _N, null_keys: bool = True) -> DataFrame:
    """Rows per key value (partial aggregation); rows with a null key are
    left out unless ``null_keys``."""
    src = rows if null_keys else rows.where(non_null_keys_sql(keys))
    return src.groupBy(*[ident(k) for k in keys]).agg(F.expr(f"count(1) AS {ident(n_col)}"))


def hashable(dt: T.DataType) -> bool:
    """Spark can hash every type but those that hold a map at any depth."""
    if isinstance(dt, T.ArrayType):
        return hashable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(hashable(f.dataType) for f in dt.fields)
    return not isinstance(dt, (T.MapType, T.VariantType))


def row_fingerprint_sql(rows: DataFrame) -> str:
    """Deterministic 64-bit value per row: hash of the partition index and
    every hashable column."""
    cols = [ident(f.name) for f in rows.schema.fields if hashable(f.dataType)]
    return f"xxhash64({', '.join(['spark_partition_id()', *cols])})"


def common_key_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which keys of types ``a`` and ``b`` are compared.

    Numbers meet as bigint, decimal or double; dates and timestamps as
    timestamps without zone; any other pair (text against a number, say) as
    text, so that ``'7'`` matches 7 and ``'007'`` does not."""
    if a == b:
        return a
    pair = (a, b)
    if all(isinstance(t, _INTEGRAL) for t in pair):
        return T.LongType()
    if all(isinstance(t, (*_INTEGRAL, *_FLOATS, T.DecimalType)) for t in pair):
        decimals = [t for t in pair if isinstance(t, T.DecimalType)]
        if any(isinstance(t, _FLOATS) for t in pair) or not decimals:
            return T.DoubleType()
        scale = max(t.scale for t in decimals)
        whole = max([t.precision - t.scale for t in decimals] + [19 for t in pair if isinstance(t, _INTEGRAL)])
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if all(isinstance(t, _TIMES) for t in pair):
        return T.TimestampNTZType()
    return T.StringType()


def _in_type(name: str, own: T.DataType, common: T.DataType) -> str:
    return ident(name) if own == common else f"CAST({ident(name)} AS {common.simpleString()})"


def keyed_join(
    rows: DataFrame,
    side: DataFrame,
    row_keys: Sequence[str],
    side_keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    side_out: Sequence[str] | None = None,
    side_stored: bool = False,
) -> DataFrame:
    """``rows`` joined (``left``, ``inner`` or ``left_anti``) to ``side`` on
    ``row_keys == side_keys`` (null-safe equality if ``null_safe``).

    ``side`` has one row per key. Side columns must not share names with row
    columns. The output holds the row columns plus, unless ``left_anti``,
    ``side_out`` (default: every side column). ``side_stored``: ``side`` is read
    from storage, so its shuffle is a bare one without a rebalance before it."""
    if how not in ("left", "inner", "left_anti"):
        raise ValueError("keyed_join supports left, inner and left_anti joins")
    row_types = {f.name: f.dataType for f in rows.schema.fields}
    side_types = {f.name: f.dataType for f in side.schema.fields}
    types = [common_key_type(row_types[r], side_types[s]) for r, s in zip(row_keys, side_keys, strict=True)]
    op = "<=>" if null_safe else "="
    keys = [f"{_KEY}{i}" for i in range(len(types))]
    row_sql = [_in_type(r, row_types[r], t) for r, t in zip(row_keys, types, strict=True)]
    side_sql = [f"{_in_type(s, side_types[s], t)} AS {k}" for s, t, k in zip(side_keys, types, keys, strict=True)]
    out = [] if how == "left_anti" else [c for c in (side.columns if side_out is None else side_out)]
    keyed = side.selectExpr(*side_sql, *[ident(c) for c in out])
    condition = " AND ".join(f"{r} {op} {k}" for r, k in zip(row_sql, keys, strict=True))
    if any(isinstance(t, T.DecimalType) and t.precision > 18 for t in types):
        condition = f"{_HASH} = {_HASH}_side AND {condition}"
        rows_in = rows.selectExpr(*[ident(c) for c in rows.columns], f"xxhash64({', '.join(row_sql)}) AS {_HASH}")
        keyed = keyed.selectExpr(f"xxhash64({', '.join(keys)}) AS {_HASH}_side", *keys, *[ident(c) for c in out])
    else:
        rows_in = rows
    joined = rows_in.join(keyed if side_stored else keyed.hint("rebalance"), F.expr(condition), how)
    return joined.selectExpr(*[ident(c) for c in rows.columns], *[ident(c) for c in out])
