"""SimHash near-dedup with BK-trees.

1. A 64-bit fingerprint per whole text: a bit is set if it is set in over half
   of the XXH64 hashes of the word shingles. Equal fingerprints collapse first,
   so copies cost nothing below.
2. Sharding without loss: with the 64 bits in ``blocks`` blocks, two
   fingerprints within ``radius`` bits agree on at least ``blocks - radius``
   whole blocks, hence meet in the shard of that block combination and value.
3. Each shard is a BK-tree: children are keyed by their integer Hamming
   distance to the parent, and a search follows only the edges within the
   radius of its own distance. A shard above ``tree_size`` fingerprints is cut
   into several trees; every tree is sent to each query block of its shard
   (and to no other), so that no task holds more than two pieces.
4. A task returns a star per local group of linked fingerprints, not pairs;
   the stars are joined to components.

The trees of many small shards are built and searched together, level by
level, with numpy.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_shuffle, group_bounds, merge_labels, put_back, raw_texts, save, set_aside, steps, text_key, whole_groups
from .components import components

SEED = 42
HASHES_AT_ONCE = 1 << 16
# Query and node pairs that may be visited at once while a tree is searched.
PAIRS_AT_ONCE = 4 << 20


# --- fingerprints ---------------------------------------------------------


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of the lower-cased word shingles of one text (0: no words)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    size = min(shingle, len(words))
    parts = zip(*(words[i:] for i in range(size)), strict=False)
    joined = map(b" ".join, parts)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        count = min(HASHES_AT_ONCE, n - at)
        hashes = np.fromiter((digest(s, SEED) for s, _ in zip(joined, range(count), strict=False)), np.uint64, count)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        for whole in batches:
            for batch in steps([whole], "text"):
                prints = np.array([fingerprint(t, shingle) for t in raw_texts(batch, "text")], dtype=np.uint64)
                columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(prints.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): one row per document, ``fp`` as a signed long."""
    text = F.col(text_col).cast("string").alias("text")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col).cast("string")).alias("text_key"), text)
    return source.mapInArrow(_fingerprints(shingle), "doc_id long, text_key binary, fp long")


# --- BK-trees ---------------------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """BK-trees over the rows of ``prints``, one per run of equal ``tree`` numbers.

    ``keys`` holds parent * 65 + edge of every child, sorted, so the children of
    a node within a range of edges are one slice."""

    def __init__(self, prints: np.ndarray, tree: np.ndarray):
        self.prints = prints
        first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else np.zeros(0, np.int64)
        self.root_of = dict(zip(tree[first].tolist(), first.tolist(), strict=True))
        at = np.repeat(first, np.diff(np.r_[first, len(tree)]))
        open_ = np.setdiff1d(np.arange(len(tree)), first, assume_unique=True)
        at, keys, nodes = at[open_], [], []
        while len(open_):
            key = at * 65 + _distance(prints[open_], prints[at])
            taken, index, inverse = np.unique(key, return_index=True, return_inverse=True)
            keys.append(taken)
            nodes.append(open_[index])
            rest = np.ones(len(open_), dtype=bool)
            rest[index] = False
            at, open_ = open_[index][inverse][rest], open_[rest]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        node = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.nodes = key[order], node[order]

    def search(self, prints: np.ndarray, roots: np.ndarray, radius: int):
        """Yield (query, node) index pairs within ``radius``; ``roots`` is the tree root per query."""
        query, node = np.arange(len(prints)), roots
        while len(query):
            d = _distance(prints[query], self.prints[node])
            hit = d <= radius
            yield query[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), side="right")
            width = high - low
            query = np.repeat(query, width)
            node = self.nodes[np.repeat(high - np.cumsum(width), width) + np.arange(len(query))]


def link_blocks(block: np.ndarray, piece: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (row, centre) of the rows linked inside each run of equal ``block``.

    A block with one piece number searches its own tree; in a block of two
    pieces the rows of the first search the tree of the second."""
    start = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    size = np.diff(np.r_[start, len(block)])
    number = np.repeat(np.arange(len(start)), size)
    low, high = np.minimum.reduceat(piece, start), np.maximum.reduceat(piece, start)
    in_tree = piece == high[number]
    asks = (piece == low[number]) & (size[number] > 1)
    rows = np.flatnonzero(in_tree & (size[number] > 1))
    forest = Forest(prints[rows], number[rows])
    label = np.arange(len(block))
    queries = np.flatnonzero(asks)
    cost = np.cumsum(np.bincount(number[rows], minlength=len(start))[number[queries]])
    at = 0
    while at < len(queries):
        base = cost[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(cost, base + PAIRS_AT_ONCE, side="right")))
        part = queries[at:stop]
        roots = np.array([forest.root_of[n] for n in number[part].tolist()], dtype=np.int64)
        for q, n in forest.search(prints[part], roots, radius):
            label = merge_labels(label, part[q], rows[n])
        at = stop
    moved = np.flatnonzero(label != np.arange(len(block)))
    return moved, label[moved]


BLOCK = ("c", "v", "low", "high")


def _links(radius: int, rows_at_once: int = 1 << 16):
    """Task over rows sorted by block: whole blocks are linked and return stars."""

    def run(batches):
        for table in whole_groups(batches, BLOCK, rows_at_once):
            start = group_bounds(table, BLOCK)
            block = np.repeat(np.arange(len(start) - 1), np.diff(start))
            prints, reps = np.asarray(table.column("fp")).view(np.uint64), np.asarray(table.column("rep"))
            a, b = link_blocks(block, np.asarray(table.column("piece")), prints, radius)
            yield pa.RecordBatch.from_arrays([pa.array(reps[a]), pa.array(reps[b])], ["a", "b"])

    return run


def _masks(blocks: int, radius: int) -> list[int]:
    """Signed 64-bit masks of every combination of ``blocks - radius`` blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = (sum(c) for c in combinations(parts, blocks - radius))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_links(prints: DataFrame, radius: int = 3, blocks: int = 5, tree_size: int = 4096) -> DataFrame:
    """(a, b): edges whose components are those of "at most ``radius`` bits apart".

    ``prints`` has distinct ``fp`` and a representative ``rep`` each."""
    if blocks <= radius:
        raise ValueError("blocks must exceed radius, or fingerprints within it may not meet")
    keys = F.array(*[F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for c, m in enumerate(_masks(blocks, radius))])
    keyed = prints.select("fp", "rep", F.explode(keys).alias("k")).select("k.c", "k.v", "fp", "rep")
    large = keyed.groupBy("c", "v").count().where(F.col("count") > tree_size)
    large = save(large.select("c", "v", F.ceil(F.col("count") / F.lit(tree_size)).cast("int").alias("pieces")), "bk-large")
    pieces = F.coalesce(F.col("pieces"), F.lit(1))
    placed = keyed.join(large, ["c", "v"], "left").select(
        "c", "v", "fp", "rep", pieces.alias("pieces"), F.pmod(F.xxhash64("fp"), pieces).cast("int").alias("piece")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    paired = placed.select("*", other.alias("other")).select(
        "c", "v", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"), "piece", "fp", "rep"
    )
    dealt = paired.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "rep")
    return dealt.mapInArrow(_links(radius), "a long, b long")


def simhash_classes(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    blocks: int = 5,
    tree_size: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_key, fp, component_id) for every row; ``component_id`` is the smallest
    doc_id reachable over links of at most ``radius`` differing bits.

    Defined cases: a null, empty or blank text has fingerprint 0 and links like
    any other; a text shorter than a shingle is hashed as a whole; repeated
    rows give repeated results; a null id stays a row, represents nothing and
    gets the component of its fingerprint; an empty table gives none; other
    columns are ignored."""
    prints = save(fingerprints(docs, shingle, id_col, text_col), "sim-prints")
    reps = save(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "sim-reps")
    linked = components(near_links(reps.where("rep IS NOT NULL"), radius, blocks, tree_size))
    classes = reps.join(linked, reps["rep"] == linked["node"], "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "rep").alias("component_id")
    )
    classes = save(classes, "sim-classes")
    return prints.join(by_shuffle(classes), prints["fp"] == classes["_fp"]).select("doc_id", "text_key", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` (doc_id, text and more) with one document of each group of linked
    fingerprints, the one with the smallest id.

    Rows that share an id are versions of one document: if the id stays, the
    version with the smallest text hash does. Rows with a null id go if their
    fingerprint group has an id, else one per fingerprint stays."""
    classes = save(simhash_classes(docs, shingle, radius), "sim-found")
    firsts = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    version = F.when(F.col("doc_id").isNull(), F.col("fp"))
    keep = firsts.groupBy("doc_id", "text_key", version.alias("version")).count()
    keep = keep.groupBy("doc_id", "version").agg(F.min(F.struct("text_key", "count")).alias("k"))
    keep = save(keep.select(F.col("doc_id").alias("_doc"), F.col("k.text_key").alias("_key"), F.col("k.count").alias("_rows")), "sim-keep")
    plain = set_aside(docs, "doc_id", "text")
    same = plain["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (text_key(plain["text"].cast("string")) == F.col("_key"))
    out = plain.join(by_shuffle(keep), same, "left_semi")
    out = out.dropDuplicates(["doc_id", "text"]) if keep.where("_rows > 1").take(1) else out
    return put_back(out, docs, "doc_id", "text")
