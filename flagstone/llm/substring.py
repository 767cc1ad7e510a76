"""Substring dedup by winnowed windows, in three levels (no doubling of lengths).

Words covered by a window of ``window`` words that also starts anywhere else
(same document included) are removed. Windows are judged on the input.

Level 1 looks at windows of ``seed`` words. Not every position is needed: each
window of full length is represented by its smallest seed window (by hash), and
equal windows have equal representatives. Representatives that occur once end
here; only those repeated go on.

Level 2 extends a repeated representative to the stretch of all full windows
that it stands for (about twice the seed length and more). A stretch that
occurs again as a whole is repeated throughout.

Level 3 takes what level 2 leaves open: representatives with more than one kind
of stretch. One stretch of each kind is cut into its full windows, and those
that occur in two stretches (or in a stretch that occurs twice) are repeated.
No candidate is left after that.

Hashes are polynomials over 64-bit word hashes modulo 2**64, mixed; a decision
rests on two independent ones (128 bits). Counting is by aggregation and
written tables are joined back, so a passage that a third of all documents
share is one row per task in the counts, and adaptive execution can split it in
the joins.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, by_shuffle, mix64, put_back, raw_texts, save, set_aside, steps, text_key

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSE = tuple(pow(m, -1, 1 << 64) for m in _ODD)


def _powers(m: int, n: int) -> np.ndarray:
    out = np.full(n, m, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Hashes of all words of some texts, end to end, with window hashes over them."""

    def __init__(self, texts: list[bytes | None]):
        words = [t.split() if t else [] for t in texts]
        self.counts = np.array([len(w) for w in words], dtype=np.int64)
        self.start = np.r_[0, np.cumsum(self.counts)]
        n = int(self.start[-1])
        digest = xxhash.xxh3_64_intdigest
        self.hashes = np.fromiter(map(digest, chain.from_iterable(words)), np.uint64, n)
        self._sums: dict[int, np.ndarray] = {}

    def windows(self, at: np.ndarray, length: np.ndarray | int, kind: int = 0) -> np.ndarray:
        """64-bit hash of the ``length`` words from each position ``at``."""
        if kind not in self._sums:
            values = self.hashes if kind == 0 else mix64(self.hashes + np.uint64(kind))
            n = len(values)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(values * _powers(_ODD[kind], n), out=sums[1:])
            self._sums[kind] = sums
            self._back = getattr(self, "_back", {})
            self._back[kind] = _powers(_INVERSE[kind], n + 1)
        sums, back = self._sums[kind], self._back[kind]
        return mix64((sums[at + length] - sums[at]) * back[at] + np.uint64(1) * np.asarray(length, dtype=np.uint64))


def stretches(words: Words, window: int, seed: int):
    """(text, first, last, representative) arrays: runs of window starts, relative to
    the text, that share a representative; its position is over all texts."""
    n = len(words.hashes)
    empty = np.zeros(0, dtype=np.int64)
    if n < window:
        return empty, empty, empty, empty
    place_bits = max(1, int(n).bit_length())
    seeds = words.windows(np.arange(n - seed + 1), seed)
    least = (seeds >> np.uint64(place_bits) << np.uint64(place_bits)) | np.arange(len(seeds), dtype=np.uint64)
    width, done = window - seed + 1, 1
    while done < width:  # running minimum over `width` seeds, doubling
        step = min(done, width - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    rep = (least & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    at = np.arange(len(rep))
    text = np.searchsorted(words.start, at, side="right") - 1
    inside = at + window <= words.start[text + 1]
    at, rep, text = at[inside], rep[inside], text[inside]
    new = np.r_[True, (rep[1:] != rep[:-1]) | (text[1:] != text[:-1])] if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(at) - 1] if len(first) else empty
    text = text[first]
    return text, at[first] - words.start[text], at[last] - words.start[text], rep[first]


def _seeds(window: int, seed: int):
    """Level 1 rows: representative, hash of its stretch, document, first and last window."""

    def run(batches):
        for whole in batches:
            for batch in steps([whole], "text"):
                words = Words(raw_texts(batch, "text"))
                text, first, last, rep = stretches(words, window, seed)
                begin = words.start[text] + first
                kind = words.windows(begin, last - first + window, 1) if len(text) else np.zeros(0, np.uint64)
                h = words.windows(rep, seed) if len(text) else np.zeros(0, np.uint64)
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(kind.view(np.int64)),
                        batch.column("doc_id").take(rows),
                        batch.column("text_key").take(rows),
                        pa.array(first.astype(np.int32)),
                        pa.array((last - first).astype(np.int32)),
                    ],
                    ["h", "kind", "doc_id", "text_key", "first", "more"],
                )

    return run


def _windows(window: int):
    """Level 3 rows: the full windows of open stretches, from the texts that hold them."""

    def run(batches):
        for whole in batches:
            for batch in steps([whole], "text"):
                words = Words(raw_texts(batch, "text"))
                first, more, times, text = [], [], [], []
                for t, found in enumerate(batch.column("open").to_pylist()):
                    for s in found:
                        text.append(t)
                        first.append(s["first"])
                        more.append(s["more"])
                        times.append(s["times"])
                width = np.array(more, dtype=np.int64) + 1
                text = np.repeat(np.array(text, dtype=np.int64), width)
                offset = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                at = np.repeat(np.array(first, dtype=np.int64), width) + offset
                place = words.start[text] + at
                a, b = (words.windows(place, window, k).view(np.int64) if len(place) else np.zeros(0, np.int64) for k in (0, 1))
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a),
                        pa.array(b),
                        pa.array(np.repeat(np.array(times, dtype=np.int64), width)),
                        batch.column("doc_id").take(rows),
                        batch.column("text_key").take(rows),
                        pa.array(at.astype(np.int32)),
                    ],
                    ["a", "b", "times", "doc_id", "text_key", "first"],
                )

    return run


def repeated_spans(docs: DataFrame, window: int = 35, seed: int = 9) -> DataFrame:
    """(doc_id, text_key, found): word spans (first, more) of repeated windows; a span
    covers the windows that start at ``first`` to ``first + more``.

    ``docs`` has doc_id (long) and text."""
    source = docs.select("doc_id", text_key("text").alias("text_key"), "text")
    schema = "h long, kind long, doc_id long, text_key binary, first int, more int"
    level1 = save(source.mapInArrow(_seeds(window, seed), schema), "sub-seeds")
    repeated = save(level1.groupBy("h").count().where("count > 1").select("h"), "sub-repeated")
    level2 = save(level1.join(by_shuffle(repeated), "h"), "sub-stretches")

    one = F.min(F.struct("doc_id", "text_key", "first", "more")).alias("one")
    kinds = save(level2.groupBy("h", "kind").agg(F.count(F.lit(1)).alias("times"), one), "sub-kinds")
    twice = kinds.where("times > 1").select("h", "kind")
    whole = level2.join(by_shuffle(twice), ["h", "kind"]).select("doc_id", "text_key", "first", "more")

    several = save(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "sub-open")
    open_ = kinds.join(by_shuffle(several), "h").select("one.doc_id", "one.text_key", F.struct("one.first", "one.more", "times").alias("s"))
    open_ = save(open_.groupBy("doc_id", "text_key").agg(F.collect_set("s").alias("open")), "sub-open-docs")
    texts = open_.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "open")
    same = source["doc_id"].eqNullSafe(texts["_doc"]) & (source["text_key"] == texts["_key"])
    cut = source.join(by_shuffle(texts), same).select("doc_id", "text_key", "text", "open")
    schema = "a long, b long, times long, doc_id long, text_key binary, first int"
    windows = save(cut.mapInArrow(_windows(window), schema), "sub-windows")
    counted = save(windows.groupBy("a", "b").agg(F.sum("times").alias("n")).where("n > 1").select("a", "b"), "sub-counted")
    single = windows.join(by_shuffle(counted), ["a", "b"]).where("times = 1").select("doc_id", "text_key", "first", F.lit(0).alias("more"))
    return whole.union(single).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "more")).alias("found"))


def _keep(window: int, text_col: str):
    """Rows with the kept words joined by one space, and the two counts."""

    def run(batches):
        for whole in batches:
            for batch in steps([whole], text_col):
                kept, n_words, n_removed = [], [], []
                for text, found in zip(raw_texts(batch, text_col), batch.column("_found").to_pylist(), strict=True):
                    words = text.split() if text else []
                    cover = np.zeros(len(words) + 1, dtype=np.int64)
                    if found:
                        first = np.array([s["first"] for s in found], dtype=np.int64)
                        np.add.at(cover, first, 1)
                        np.add.at(cover, first + np.array([s["more"] for s in found], dtype=np.int64) + window, -1)
                    gone = np.cumsum(cover)[:-1] > 0
                    n_words.append(len(words))
                    n_removed.append(int(gone.sum()))
                    kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if found else b" ".join(words))
                names = [n for n in batch.schema.names if n not in ("_found", text_col)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in names],
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array([sha256(k).hexdigest() for k in kept]),
                    ],
                    [*names, text_col, "_n_words", "_n_removed", "_sha256"],
                )

    return run


def substring_dedup(docs: DataFrame, window: int = 35, seed: int = 9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text cut to its kept words (joined by one space), and the
    columns ``_n_words``, ``_n_removed`` and ``_sha256`` (of the kept text).

    Defined cases: null and blank texts have no words; texts shorter than a
    window keep all; rows equal in id and text count as different places, so
    both lose their repeated windows; rows with one id and different texts are
    told apart by a hash of the text; extra columns are kept."""
    plain = set_aside(docs, id_col, text_col)
    text = F.col(text_col).cast("string")
    keyed = plain.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    spans = save(repeated_spans(keyed, window, seed), "sub-spans")
    spans = spans.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("found").alias("_found"))
    same = plain[id_col].cast("long").eqNullSafe(F.col("_doc")) & (text_key(plain[text_col].cast("string")) == F.col("_key"))
    joined = plain.join(by_shuffle(spans), same, "left").drop("_doc", "_key").withColumn(text_col, text)
    passed = [f for f in plain.schema.fields if f.name != text_col]
    schema = arrow_schema(passed, f"`{text_col}` string, _n_words long, _n_removed long, _sha256 string")
    out = joined.mapInArrow(_keep(window, text_col), schema)
    return put_back(out, docs, id_col, text_col, added=("_n_words", "_n_removed", "_sha256"))
