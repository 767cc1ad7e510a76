"""Helpers shared by the training-data operators.

Intermediate tables are written below the folder that ``spark.checkpoint.dir``
names (every executor can read them again, so a lost executor costs a task and
not a result). Row identity inside a job is the pair (``doc_id``, 128-bit digest of
the text), compared null-safe: rows that share an id, or have none, but not a text stay apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import scratch_path

# Text handed to one vectorised step inside a task, in bytes: bounds the
# memory of a Python worker whatever the size of an Arrow batch.
STEP_BYTES = 4 << 20


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, *roles: str) -> DataFrame:
    """``docs`` with every column but ``roles`` under a neutral name, so that no
    column of the caller meets a column of the operator."""
    return docs.select(*[docs[f"`{c}`"].alias(c if c in roles else f"extra__{i}") for i, c in enumerate(docs.columns)])


def put_back(result: DataFrame, docs: DataFrame, *roles: str, added: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``docs`` under their own names again, then ``added`` (which
    replace columns of ``docs`` of that name)."""
    kept = [F.col(c if c in roles else f"extra__{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added]
    return result.select(*kept, *added)


def arrow_schema(fields: list[StructField], added: str) -> StructType:
    """Fields that pass through a task, and the ``added`` ones as DDL."""
    return StructType([*(StructField(f.name, f.dataType) for f in fields), *StructType.fromDDL(added).fields])


def text_key(text: str | Column) -> Column:
    """128-bit digest that tells apart rows with one ``doc_id`` or none (null text: no bytes)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.unhex(F.md5(text.cast("string").cast("binary"))), F.lit(b""))


def steps(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``limit`` bytes or one row."""
    for batch in batches:
        col = batch.column(column)
        sizes = np.zeros(batch.num_rows, dtype=np.int64)
        if batch.num_rows:
            sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
        cum, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            base = cum[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(cum, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of bytes other than space and U+0009 to U+000D."""
    return text.split() if text else []


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast only where the counted ``rows`` stay below ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def by_shuffle(df: DataFrame) -> DataFrame:
    """Mark a join side that grows with the corpus: the join sorts and merges at any size,
    and adaptive execution can split its skewed partitions."""
    return df.hint("merge")


def partitions_for(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Partitions that hold about ``per_partition`` rows each, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_partition))


def whole_groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that end where the ``keys`` change (input sorted by
    them); a group is never cut, so a table may hold one larger group."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        same = np.ones(len(table), dtype=bool)
        for k in keys:
            same &= np.asarray(table.column(k)) == table.column(k)[-1].as_py()
        cut = int(np.flatnonzero(same)[0])
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).to_batches(), len(table) - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def group_bounds(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Row numbers where the groups of a sorted table begin, and its length."""
    change = np.zeros(len(table), dtype=bool)
    for k in keys:
        x = np.asarray(table.column(k))
        change[1:] |= x[1:] != x[:-1]
    return np.r_[0, np.flatnonzero(change), len(table)]


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Point the groups of ``a`` and ``b`` at their smallest member (``label`` starts as arange)."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits (wrapping uint64)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
