"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is the set of its windows of ``window`` words (one window if
it has fewer), a window the sequence of its word shingles. A document contains
a window only if it contains every shingle of it, so the necessary prefix of a
window is one shingle: the rarest, by its count over all documents. Documents
are joined on these prefix shingles only; the offset of the shingle fixes where
the window would start and end (positional and length bounds), and the words in
between are compared one by one.

The benchmark is read in blocks of at most ``block_bytes`` of text; each block
is indexed, broadcast and joined with all documents, so that a benchmark of any
size needs bounded memory. A window whose rarest shingle occurs in no document
is left out.

Defined cases: null and word-less documents have no words and no hits; null
and word-less items have no windows; items that share an id are one item, a
null id reads ``null``; repeated document rows get repeated results; an empty
benchmark or table gives zero hits or no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, by_shuffle, mix64, put_back, raw_texts, save, set_aside, steps, text_key

# ASCII letters in lower case, digits and every byte from 0x80 on stay; the rest parts words.
_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
SPANS = "n_words long, starts array<int>, ends array<int>, items array<string>"
RESULT = f"doc_id long, text_key binary, {SPANS}"


def item_words(text: bytes | None) -> list[bytes]:
    return text.translate(_KEEP).split() if text else []


class WindowIndex:
    """Distinct windows of a block of items over a numbered vocabulary."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int, shingle: int):
        self.shingle = shingle
        self.names: list[str] = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.vocab: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for name, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in item_words(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + window]), set()).add(number[name])
        self.windows = list(owners)
        self.lengths = np.array([len(w) for w in self.windows], dtype=np.int64)
        self.flat = np.array(list(chain.from_iterable(self.windows)), dtype=np.int64)
        self.offset = np.r_[0, np.cumsum(self.lengths)].astype(np.int64)
        self.owners = [np.array(sorted(o), dtype=np.int64) for o in owners.values()]
        self.sizes = sorted({min(shingle, len(w)) for w in self.windows})
        self.prefix_keys = np.zeros(0, dtype=np.uint64)

    def shingles(self) -> dict[int, list[tuple[int, int]]]:
        """Shingle key to the (window, offset) places that have it."""
        places: dict[int, list[tuple[int, int]]] = {}
        for w, ids in enumerate(self.windows):
            size = min(self.shingle, len(ids))
            for off, key in enumerate(shingle_keys(np.array(ids, dtype=np.int64), size).tolist()):
                places.setdefault(key, []).append((w, off))
        return places

    def choose_prefixes(self, counts: dict[int, int]) -> None:
        """Keep one shingle per window, the rarest; drop windows with an absent one."""
        best: dict[int, tuple[int, int, int]] = {}
        absent = set()
        for key, places in self.shingles().items():
            n = counts.get(key, 0)
            for w, off in places:
                if n == 0:
                    absent.add(w)
                best[w] = min(best.get(w, (1 << 62, 0, 0)), (n, key, off))
        rows = sorted((key, w, off) for w, (_, key, off) in best.items() if w not in absent)
        keys = np.array([r[0] for r in rows], dtype=np.uint64)
        self.prefix_keys, self.prefix_start = np.unique(keys, return_index=True)
        self.prefix_end = np.r_[self.prefix_start[1:], len(rows)].astype(np.int64)
        self.prefix_window = np.array([r[1] for r in rows], dtype=np.int64)
        self.prefix_offset = np.array([r[2] for r in rows], dtype=np.int64)

    def word_ids(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary numbers (-1: not in the block) of all words, and words per text."""
        words = [item_words(t) for t in texts]
        counts = np.array([len(w) for w in words], dtype=np.int64)
        ids = np.fromiter(map(self.vocab.get, chain.from_iterable(words), repeat(-1)), np.int64, int(counts.sum()))
        return ids, counts

    def contained(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence of a window inside one text."""
        bounds = np.r_[0, np.cumsum(counts)]
        found_w, found_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size in self.sizes if len(self.prefix_keys) else ():
            at = known_positions(ids, size)
            keys = shingle_keys(ids, size, at)
            where = np.minimum(np.searchsorted(self.prefix_keys, keys), len(self.prefix_keys) - 1)
            same = self.prefix_keys[where] == keys
            at, where = at[same], where[same]
            width = self.prefix_end[where] - self.prefix_start[where]
            row = np.repeat(self.prefix_end[where] - np.cumsum(width), width) + np.arange(width.sum())
            at, w = np.repeat(at, width), self.prefix_window[row]
            start = at - self.prefix_offset[row]
            text = np.searchsorted(bounds, at, side="right") - 1
            fits = (start >= bounds[text]) & (start + self.lengths[w] <= bounds[text + 1])
            start, w = start[fits], w[fits]
            for i in range(int(self.lengths[w].max()) if len(w) else 0):
                short = self.lengths[w] <= i
                ok = short | (ids[np.where(short, start, start + i)] == self.flat[np.where(short, 0, self.offset[w] + i)])
                start, w = start[ok], w[ok]
            found_w.append(w)
            found_s.append(start)
        return np.concatenate(found_w), np.concatenate(found_s)


def known_positions(ids: np.ndarray, size: int) -> np.ndarray:
    """Positions from which ``size`` words in a row are in the vocabulary."""
    known = ids >= 0
    ok = known[: max(0, len(ids) - size + 1)].copy()
    for i in range(1, size):
        ok &= known[i : i + len(ok)]
    return np.flatnonzero(ok)


def shingle_keys(ids: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    at = np.arange(max(0, len(ids) - size + 1)) if at is None else at
    key = np.full(len(at), size, dtype=np.uint64)
    for i in range(size):
        key = mix64(key + ids[at + i].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return key


def _count_shingles(index, keys):
    """Task: occurrences of the block's shingles in its documents, one row per shingle."""

    def run(batches):
        block, known = index.value, np.array(sorted(keys.value), dtype=np.uint64)
        total = np.zeros(len(known), dtype=np.int64)
        for whole in batches:
            for batch in steps([whole], "text"):
                ids, _ = block.word_ids(raw_texts(batch, "text"))
                for size in block.sizes:
                    got = shingle_keys(ids, size, known_positions(ids, size))
                    where = np.minimum(np.searchsorted(known, got), max(0, len(known) - 1))
                    total += np.bincount(where[known[where] == got], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known[seen].view(np.int64)), pa.array(total[seen])], ["shingle", "n"])

    return run


def spans(mask: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.r_[0, mask.astype(np.int8), 0])
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def _find(index, passed: tuple[str, ...] = ("doc_id", "text_key")):
    """Task: the ``passed`` columns of every document with its covered spans and items."""

    def run(batches):
        block = index.value
        for whole in batches:
            for batch in steps([whole], "text"):
                ids, counts = block.word_ids(raw_texts(batch, "text"))
                w, start = block.contained(ids, counts)
                cover = np.zeros(len(ids) + 1, dtype=np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + block.lengths[w], -1)
                hit = np.cumsum(cover)[:-1] > 0
                bounds = np.r_[0, np.cumsum(counts)]
                text = np.searchsorted(bounds, start, side="right") - 1
                items: dict[int, set[int]] = {}
                for t, x in set(zip(text.tolist(), w.tolist(), strict=True)):
                    items.setdefault(t, set()).update(block.owners[x].tolist())
                starts, ends = [[] for _ in counts], [[] for _ in counts]
                for t in items:
                    starts[t], ends[t] = spans(hit[bounds[t] : bounds[t + 1]])
                names = [[block.names[x] for x in sorted(items.get(t, ()))] for t in range(len(counts))]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in passed],
                        pa.array(counts),
                        pa.array(starts, pa.list_(pa.int32())),
                        pa.array(ends, pa.list_(pa.int32())),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    [*passed, "n_words", "starts", "ends", "items"],
                )

    return run


def _union_spans(batches):
    """Merge the word spans that several blocks found in a document."""
    for batch in batches:
        starts, ends = [], []
        for s, e in zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            out_s, out_e = [], []
            for a, b in sorted(zip(s, e, strict=True)):
                if out_e and a <= out_e[-1]:
                    out_e[-1] = max(out_e[-1], b)
                else:
                    out_s.append(a)
                    out_e.append(b)
            starts.append(out_s)
            ends.append(out_e)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(n) for n in ("doc_id", "text_key", "n_words")],
                pa.array(starts, pa.list_(pa.int32())),
                pa.array(ends, pa.list_(pa.int32())),
                batch.column("items"),
            ],
            ["doc_id", "text_key", "n_words", "starts", "ends", "items"],
        )


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Items in blocks of at most ``block_bytes`` of text (or one item)."""
    held, size = [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.col("text").cast("binary")).toLocalIterator():
        text = None if row[1] is None else bytes(row[1])
        if held and size + len(text or b"") > block_bytes:
            yield held
            held, size = [], 0
        held.append((row[0], text))
        size += len(text or b"")
    if held:
        yield held


def _indexes(source: DataFrame, benchmark: DataFrame, window: int, shingle: int, block_bytes: int) -> list:
    """Broadcast index of every benchmark block, with prefixes by the counts over ``source``."""
    sc, out = source.sparkSession.sparkContext, []
    for items in _blocks(benchmark, block_bytes):
        index = WindowIndex(items, window, shingle)
        counted = source.mapInArrow(_count_shingles(sc.broadcast(index), sc.broadcast(set(index.shingles()))), "shingle long, n long")
        counts = counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()  # no more rows than the block has shingles
        index.choose_prefixes({r["shingle"] % (1 << 64): r["n"] for r in counts})
        out.append(sc.broadcast(index))
    return out or [sc.broadcast(WindowIndex([], window, shingle))]


def _spans_by_block(source: DataFrame, indexes: list) -> DataFrame:
    if len(indexes) == 1:
        return source.mapInArrow(_find(indexes[0]), RESULT)
    found = reduce(DataFrame.union, (source.mapInArrow(_find(i), RESULT) for i in indexes))
    merged = found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        (F.count(F.lit(1)) / len(indexes)).cast("int").alias("rows"),
    )
    merged = merged.select("*", F.explode(F.array_repeat(F.lit(1), F.col("rows")))).drop("rows", "col")
    return merged.mapInArrow(_union_spans, RESULT)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("text_key"), text.alias("text"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    shingle: int = 3,
    block_bytes: int = 8 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, starts and ends (word spans
    covered by occurring windows, merged) and items (ids whose windows occur)."""
    source = _source(docs, id_col, text_col)
    return _spans_by_block(source, _indexes(source, benchmark, window, shingle, block_bytes))


def with_verdict(found: DataFrame, share: int = 20) -> DataFrame:
    """Add n_hit and contaminated: at least one word in ``share`` is covered."""
    lengths = F.zip_with("ends", "starts", lambda e, s: (e - s).cast("long"))
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, shingle: int = 3, block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` (doc_id, text and more) without the contaminated rows.

    With a benchmark of one block the rows are judged where they are read; with
    more, the contaminated ids are joined."""
    source = _source(docs, "doc_id", "text")
    indexes = _indexes(source, benchmark, window, shingle, block_bytes)
    plain = set_aside(docs, "doc_id", "text")
    if len(indexes) == 1:
        found = plain.mapInArrow(_find(indexes[0], tuple(plain.columns)), arrow_schema(plain.schema.fields, SPANS))
        return put_back(with_verdict(found, share).where("NOT contaminated"), docs, "doc_id", "text")
    verdict = with_verdict(_spans_by_block(source, indexes), share).where("contaminated")
    out = by_shuffle(save(verdict.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")), "contaminated"))
    same = plain["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (text_key(plain["text"].cast("string")) == F.col("_key"))
    return put_back(plain.join(out, same, "left_anti"), docs, "doc_id", "text")
