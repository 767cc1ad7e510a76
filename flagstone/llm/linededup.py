"""Line dedup over overlapping windows of three lines.

Every run of ``window`` consecutive lines is hashed (128 bits). Of the places
where a window occurs, the smallest (document, line) stays; the lines covered
by any later occurrence are removed. Overlapping windows merge, so a passage of
any length goes as a whole, while a line that repeats alone stays.

Windows are judged on the input. Defined cases: a text of fewer lines than the
window, an empty text and a null text are left alone; windows of blank lines
only are ignored; rows equal in id and text are one document, all of them get
the same result; rows with one id and different texts are told apart by a hash
of the text; null ids sort first; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, by_shuffle, put_back, raw_texts, save, set_aside, steps, text_key

FIRST, LATER = "_first", "_later"


def _line_windows(window: int):
    def run(batches):
        for whole in batches:
            for batch in steps([whole], "text"):
                ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
                out = ([], [], [], [], [])
                for i, k, text in zip(ids, keys, raw_texts(batch, "text"), strict=True):
                    lines = (text or b"").split(b"\n")
                    if len(lines) < window:
                        continue
                    marks, filled = [xxhash.xxh3_128_digest(x) for x in lines], [bool(x.strip()) for x in lines]
                    for p in range(len(lines) - window + 1):
                        if any(filled[p : p + window]):
                            h = xxhash.xxh3_128_intdigest(b"".join(marks[p : p + window]))
                            for column, v in zip(out, (h >> 64, h & (2**64 - 1), i, k, p), strict=True):
                                column.append(v)
                hi, lo = (np.array(x, dtype=np.uint64).view(np.int64) for x in out[:2])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hi), pa.array(lo), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.int32())],
                    ["hi", "lo", "doc_id", "text_key", "pos"],
                )

    return run


def _without(window: int, text_col: str):
    """Rewrite the text column of rows that have covered windows; add the counts."""

    def run(batches):
        for whole in batches:
            for batch in steps([whole], text_col):
                kept, n_lines, n_removed = [], [], []
                for text, starts in zip(raw_texts(batch, text_col), batch.column(LATER).to_pylist(), strict=True):
                    lines = [] if text is None else text.split(b"\n")
                    covered = {p + i for p in starts or () for i in range(window)}
                    n_lines.append(len(lines))
                    n_removed.append(len(covered))
                    kept.append(text if not covered else b"\n".join(x for p, x in enumerate(lines) if p not in covered))
                names = [n for n in batch.schema.names if n not in (LATER, text_col)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in names],
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array(n_lines, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                    ],
                    [*names, text_col, "_n_lines", "_n_removed"],
                )

    return run


def later_windows(docs: DataFrame, window: int = 3) -> DataFrame:
    """(doc_id, text_key, starts): first lines of the windows that occur earlier elsewhere.

    ``docs`` has doc_id (long) and text."""
    source = docs.select("doc_id", text_key("text").alias("text_key"), "text")
    schema = "hi long, lo long, doc_id long, text_key binary, pos int"
    windows = save(source.mapInArrow(_line_windows(window), schema), "line-windows")
    place = F.struct("doc_id", "text_key", "pos")
    firsts = windows.groupBy("hi", "lo").agg(F.min(place).alias(FIRST), F.max(place).alias("last"))
    firsts = save(firsts.where(F.col(FIRST) != F.col("last")).select("hi", "lo", FIRST), "line-firsts")
    later = windows.join(firsts, ["hi", "lo"]).where(place > F.col(FIRST))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("starts"))


def line_dedup(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text cut to the kept lines, and the columns ``_n_lines`` and ``_n_removed``."""
    plain = set_aside(docs, id_col, text_col)
    text = F.col(text_col).cast("string")
    found = save(later_windows(plain.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")), window), "line-later")
    found = by_shuffle(found.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("starts").alias(LATER)))
    same = plain[id_col].cast("long").eqNullSafe(F.col("_doc")) & (text_key(plain[text_col].cast("string")) == F.col("_key"))
    joined = plain.join(found, same, "left").drop("_doc", "_key").withColumn(text_col, text)
    passed = [f for f in plain.schema.fields if f.name != text_col]
    out = joined.mapInArrow(_without(window, text_col), arrow_schema(passed, f"`{text_col}` string, _n_lines long, _n_removed long"))
    return put_back(out, docs, id_col, text_col, added=("_n_lines", "_n_removed"))


def drop_repeated_lines(docs: DataFrame, window: int = 3) -> DataFrame:
    """``docs`` (doc_id, text, n_chars and more) with shortened texts and their new lengths; every row stays."""
    out = line_dedup(docs, window)
    if "n_chars" in docs.columns:
        length = F.when(F.col("_n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", length)
    return out.select(*[f"`{c}`" for c in docs.columns])
