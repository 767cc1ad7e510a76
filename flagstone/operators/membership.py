"""Referential membership: does each key of one table exist in another?

The superset is reduced to its distinct keys (partially aggregated, so a key
repeated a billion times is one row per task before the shuffle) and joined
to the subset so that adaptive execution can split a hot subset key (see
:mod:`flagstone.operators.skew`), and still broadcasts the key set when its
measured size allows. Ids of two types are compared in one declared type: a
number and a text meet as text. No ``NOT IN`` (which would become a broadcast
nested-loop join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import RESULT, added_name, col, ident, mark_added
from .skew import keyed_join

_MARK = "__dq_present"


def _keys(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _key_set(superset: DataFrame, keys: list[str], aliases: list[str]) -> DataFrame:
    return superset.select(*[col(k).alias(a) for k, a in zip(keys, aliases)]).distinct()


def mappable_id(
    subset: DataFrame,
    superset: DataFrame,
    columns: str | Sequence[str],
    superset_columns: str | Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """All rows of ``subset`` plus boolean ``result`` (``result_qc`` if the data
    has a ``result``): True when the key is found in ``superset``. With ``null_safe`` a null key matches a null key
    of the superset (as a pandas ``isin`` matches NaN with NaN)."""
    keys = _keys(columns)
    sup_keys = _keys(superset_columns) if superset_columns is not None else keys
    if len(keys) != len(sup_keys):
        raise ValueError("subset and superset key lists differ in length")
    aliases = [f"__dq_sk{i}" for i in range(len(keys))]
    present = _key_set(superset, sup_keys, aliases).withColumn(_MARK, F.lit(True))
    result = added_name(subset, RESULT)
    base = [c for c in subset.columns if c != result]
    rows = subset.select(*[ident(c) for c in base])
    joined = keyed_join(rows, present, keys, aliases, "left", null_safe, side_out=[_MARK])
    return mark_added(joined.selectExpr(*[ident(c) for c in base], f"{_MARK} IS NOT NULL AS {ident(result)}"), result)


def unmapped_rows(
    subset: DataFrame,
    superset: DataFrame,
    columns: str | Sequence[str],
    superset_columns: str | Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Only the rows of ``subset`` whose key is not in ``superset`` (anti-join)."""
    keys = _keys(columns)
    sup_keys = _keys(superset_columns) if superset_columns is not None else keys
    aliases = [f"__dq_sk{i}" for i in range(len(keys))]
    return keyed_join(subset, _key_set(superset, sup_keys, aliases), keys, aliases, "left_anti", null_safe)
