"""Embedding near-dedup over a robust-pruned flat graph.

1. Equal vectors of a label collapse to one point with a count.
2. Overlapping cluster shards: a label is split around well separated centres,
   taken from a bounded sample of its points; every point joins the shards of
   its ``overlap`` nearest centres, and large shards are split again. Where no
   separated centres exist (points all alike), the shard is cut into pieces and
   every pair of pieces is compared in full, so dense groups are not split apart.
3. Each piece builds a graph: nearest neighbours and some far points, kept by
   the robust-prune rule (a neighbour goes if a kept one is nearer to it by the
   factor ``ALPHA`` than the node is), made mutual and connected. The adjacency
   lists that a point has in its shards are joined.
4. Each shard is searched for each of its points: greedily from the medoid over
   the joined lists, a beam of the best so far, and on through every point
   within the threshold (range expansion).
5. Cosines are computed in double precision; a pair that shares several shards
   is counted in the first of them, where it is compared directly, so that no
   later shard finds a pair that is not counted. A task returns one row per
   point: its links and the centre of its local group.
6. Recall is audited: for a bounded sample of points all links are counted
   exactly over all rows, and the lower of the recall of links and the mean recall
   of points holds; below ``min_recall`` the shards are built again with twice the
   overlap, and where that does not suffice all pairs of a label are compared.

Defined cases: a null label, and vectors that are null, empty, zero or hold
null or non-finite components, link with nothing; vectors of different lengths
do not link; repeated rows are vectors of their own, linked as equals; a null
id takes part and is never the smallest id unless alone; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_bounds, merge_labels, save, whole_groups
from .components import components

SHARD = 1024  # points of a shard, or of a piece of one
CENTRES = 512  # most centres of one split
SAMPLE = 4096  # points from which the centres of a shard are taken
APART = 0.8  # cosine below which two centres are apart
LEVELS = 12
NEAR, FAR, DEGREE, ALPHA = 40, 8, 24, 1.2
BEAM, WIDTH = 40, 4
PIECE, BLOCK = ("cell", "piece"), ("cell", "low", "high")


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column (equal lengths) as unit vectors in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- points and shards --------------------------------------------------------


def points_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points (pid, cell, vec, times) of the vectors that can link, and (vec_id, pid) of all rows."""
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad
    good = good & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.when(F.coalesce(good, F.lit(False)), vec).alias("vec"))
    points = rows.where("vec IS NOT NULL").groupBy("label", "vec").agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("rep"))
    points = points.select(
        F.monotonically_increasing_id().alias("pid"), F.xxhash64("label", F.size("vec")).alias("cell"), "label", "vec", "times", "rep"
    )
    return save(points, "vec-points"), rows


def _centres(wanted: int, least: int):
    """Well separated points of a shard's sample; none if fewer than ``least``."""

    def run(sample: pd.DataFrame) -> pd.DataFrame:
        x = np.array(sample["vec"].tolist(), dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        k = min(CENTRES, max(4 * least, -(-int(sample["n"].iloc[0]) // wanted)))
        nearest, chosen = np.full(len(x), -np.inf), []
        for i in range(len(x)):
            if nearest[i] < APART:
                chosen.append(i)
                if len(chosen) == k:
                    break
                nearest = np.maximum(nearest, x @ x[i])
        if len(chosen) < least:
            chosen = []
        found = pd.DataFrame({"child": range(len(chosen)), "vec": pd.Series([x[i].tolist() for i in chosen], dtype=object)})
        found.insert(0, "cell", sample["cell"].iloc[0])
        return found

    return run


def _deal(overlap: int):
    """Task over (cell, block) runs, centres first: the nearest children of every point."""

    def run(batches):
        key, centres = None, None
        for table in whole_groups(batches, ("cell", "block"), 1):
            bounds = group_bounds(table, ("cell", "block"))
            for a, b in zip(bounds, bounds[1:], strict=False):
                part = table.slice(a, b - a)
                child = np.asarray(part.column("child"))
                n = int((child >= 0).sum())
                here = (part.column("cell")[0].as_py(), part.column("block")[0].as_py())
                if n:
                    key, centres = here, _unit(part.column("vec").slice(0, n))
                if here != key or n == len(part):
                    continue
                score = _unit(part.column("vec").slice(n)) @ centres.T
                near = np.argpartition(-score, overlap - 1, axis=1)[:, :overlap]
                pid = np.repeat(np.asarray(part.column("pid"))[n:], overlap)
                cell = np.repeat(np.asarray(part.column("cell"))[n:], overlap)
                yield pa.RecordBatch.from_arrays([pa.array(pid), pa.array(cell), pa.array(near.ravel())], ["pid", "cell", "child"])

    return run


def shards(points: DataFrame, overlap: int, deal_rows: int = 8192) -> DataFrame:
    """(pid, cell, pieces): the final shards of every point."""
    open_ = points.select("pid", "cell", "vec")
    done = None
    for level in range(LEVELS):
        sizes = save(open_.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "vec-sizes")
        large = sizes.where(F.col("n") > SHARD)
        if level == LEVELS - 1 or not large.take(1):
            break
        place = F.pmod(F.xxhash64(F.lit(level), F.col("pid")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = open_.join(large, "cell").where(place < F.lit(0.9 * SAMPLE) / F.col("n"))
        schema = "cell long, child int, vec array<double>"
        centres = save(sample.groupBy("cell").applyInPandas(_centres(SHARD // 4, 4 * overlap), schema), "vec-centres")
        split = save(centres.groupBy("cell").agg(F.count(F.lit(1)).alias("k")).join(large, "cell"), "vec-split")
        if not split.take(1):
            break
        blocks = F.ceil(F.col("n") / F.lit(deal_rows)).cast("int")
        rows = open_.join(split, "cell").select(
            "cell", F.pmod(F.xxhash64(F.lit("deal"), F.col("pid")), blocks).cast("int").alias("block"), "pid", F.lit(-1).alias("child"), "vec"
        )
        heads = centres.join(split, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(0).cast("long").alias("pid"), "child", "vec"
        )
        dealt = rows.union(heads).repartition("cell", "block")
        dealt = dealt.sortWithinPartitions("cell", "block", (F.col("child") < 0).cast("int"), "child", "pid")
        dealt = dealt.mapInArrow(_deal(overlap), "pid long, cell long, child long")
        dealt = dealt.select("pid", F.xxhash64("cell", "child").alias("cell")).distinct()
        kept = open_.join(split.select("cell"), "cell", "left_anti").select("pid", "cell")
        done = kept if done is None else done.union(kept)
        vec = points.select("pid", "vec")
        open_ = save(save(dealt, "vec-dealt").join(vec, "pid").select("pid", "cell", "vec"), "vec-open")
    last = open_.select("pid", "cell")
    members = save(last if done is None else done.union(last), "vec-members")
    sizes = members.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(SHARD))).cast("int").alias("pieces"))
    return members.join(save(sizes, "vec-pieces"), "cell").select("pid", "cell", "pieces")


# --- graph ----------------------------------------------------------------------


def robust_prune(score: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Which ``candidates`` (per node, best first) stay as neighbours; ``score`` has all cosines."""
    n, width = candidates.shape
    rows = np.arange(n)[:, None]
    away = 2 - 2 * score[rows, candidates]
    kept = np.zeros((n, width), dtype=bool)
    for j in range(width):
        between = 2 - 2 * score[candidates[:, j][:, None], candidates[:, :j]]
        covered = (kept[:, :j] & (ALPHA * ALPHA * between <= away[:, j : j + 1])).any(axis=1)
        kept[:, j] = ~covered & (candidates[:, j] != np.arange(n)) & (kept.sum(axis=1) < DEGREE)
    return kept


def medoid(x: np.ndarray) -> int:
    return int(np.argmax(x @ x.mean(axis=0)))


def build_graph(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directed edges (node, neighbour) over unit vectors: pruned, mutual, all connected."""
    n = len(x)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    score = x @ x.T
    far = np.random.default_rng(seed).integers(0, n, (n, FAR))
    np.fill_diagonal(score, -2)
    near = np.argpartition(-score, min(NEAR, n - 1) - 1, axis=1)[:, : min(NEAR, n - 1)]
    np.fill_diagonal(score, 1)
    candidates = np.c_[near, far]
    rows = np.arange(n)[:, None]
    candidates = candidates[rows, np.argsort(-score[rows, candidates], axis=1, kind="stable")]
    a, j = np.nonzero(robust_prune(score, candidates))
    b = candidates[a, j]
    label = merge_labels(np.arange(n), a, b)
    home = label == label[medoid(x)]
    extra_a, extra_b = [], []
    while not home.all():
        inside, outside = np.flatnonzero(home), np.flatnonzero(~home)
        i, o = np.unravel_index(np.argmax(score[np.ix_(inside, outside)]), (len(inside), len(outside)))
        extra_a.append(inside[i])
        extra_b.append(outside[o])
        home |= label == label[outside[o]]
    a, b = np.r_[a, b, extra_a, extra_b].astype(np.int64), np.r_[b, a, extra_b, extra_a].astype(np.int64)
    key = np.unique(a * n + b)
    return key // n, key % n


def _graphs(batches):
    """Task over (cell, piece) runs: the adjacency list of every point."""
    for table in whole_groups(batches, PIECE, 4 * SHARD):
        bounds = group_bounds(table, PIECE)
        for s, e in zip(bounds, bounds[1:], strict=False):
            part = table.slice(s, e - s)
            pid = np.asarray(part.column("pid"))
            a, b = build_graph(_unit(part.column("vec")), int(pid[0]) % (1 << 32))
            offsets = np.searchsorted(a, np.arange(len(pid) + 1))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pid[b], pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("pid").combine_chunks(), lists], ["pid", "near"])


# --- search ---------------------------------------------------------------------


def range_search(x: np.ndarray, near: np.ndarray, queries: np.ndarray, threshold: float, own: np.ndarray | None = None) -> np.ndarray:
    """Cosines of ``queries`` with the points that the search reaches (-inf elsewhere).

    ``near`` has a row of neighbours per point, -1 for none. Starts are the medoid
    and, for queries that are points themselves, their own place."""
    q, n = len(queries), len(x)
    score = np.full((q, n), -np.inf)
    spent = np.zeros((q, n), dtype=bool)

    def visit(rows: np.ndarray, cols: np.ndarray) -> None:
        for at in range(0, len(rows), 1 << 16):
            r, c = rows[at : at + (1 << 16)], cols[at : at + (1 << 16)]
            score[r, c] = np.einsum("ij,ij->i", queries[r], x[c])

    def neighbours(r: np.ndarray, c: np.ndarray, rows: int) -> np.ndarray:
        """Points next to the expanded ones, for every query."""
        if len(r) * near.shape[1] > rows * n:  # dense groups: many expansions share their neighbours
            step, go = np.zeros((n, n + 1), dtype=np.float32), np.zeros((rows, n), dtype=np.float32)
            step[np.arange(n)[:, None], near] = 1  # -1 lands in the last column
            go[r, c] = 1
            return (go @ step)[:, :n] > 0
        out = np.zeros((rows, n + 1), dtype=bool)
        for k in range(near.shape[1]):
            out[r, near[c, k]] = True
        return out[:, :n]

    everyone = np.arange(q)
    visit(everyone, np.full(q, medoid(x)))
    if own is not None:
        visit(everyone, own)
    active = everyone
    while len(active):
        s, done = score[active], spent[active]
        waiting = np.where(done, -np.inf, s)
        width, beam = min(WIDTH, n), min(BEAM, n)
        bar = np.partition(s, n - beam, axis=1)[:, n - beam]
        best = np.argpartition(-waiting, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(waiting, best, axis=1)
        go = np.zeros_like(done)
        np.put_along_axis(go, best, np.isfinite(value) & (value >= bar[:, None]), axis=1)
        go |= waiting >= threshold
        r, c = np.nonzero(go)
        if not len(r):
            break
        rows = active[r]
        spent[rows, c] = True
        fresh = neighbours(r, c, len(active)) & np.isneginf(s)
        if 4 * fresh.sum() > fresh.size:
            score[active] = np.where(fresh, queries[active] @ x.T, s)
        else:
            a, b = np.nonzero(fresh)
            visit(active[a], b)
        active = active[go.any(axis=1)]
    return score


def _local(near: pa.Array, pid: np.ndarray) -> np.ndarray:
    """Adjacency lists as rows of local numbers, without points from elsewhere."""
    near = near.combine_chunks() if isinstance(near, pa.ChunkedArray) else near
    counts = np.asarray(pc.list_value_length(near)).astype(np.int64)
    owner, target = np.repeat(np.arange(len(pid)), counts), np.asarray(near.flatten())
    order = np.argsort(pid)
    at = np.minimum(np.searchsorted(pid[order], target), len(pid) - 1)
    here = pid[order][at] == target
    owner, target = owner[here], order[at[here]]
    start = np.searchsorted(owner, np.arange(len(pid) + 1))
    out = np.full((len(pid), max(1, int(np.diff(start).max()))), -1)
    out[owner, np.arange(len(owner)) - start[owner]] = target
    return out


def _memberships(cells: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Points by the shards they belong to, as a 0/1 matrix, and the numbers of the shards."""
    number = np.array(sorted({c for row in cells for c in row}), dtype=np.int64)
    place = {c: i for i, c in enumerate(number.tolist())}
    out = np.zeros((len(cells), len(number)), dtype=np.float32)
    for i, row in enumerate(cells):
        for c in row:
            out[i, place[c]] = 1
    return out, number


def _search(threshold: float, exact: bool = False):
    """Task over (cell, low, high) runs: links and local group of every point."""

    def block(part: pa.Table) -> pa.RecordBatch:
        low, high = part.column("low")[0].as_py(), part.column("high")[0].as_py()
        piece, pid = np.asarray(part.column("piece")), np.asarray(part.column("pid"))
        x, times = _unit(part.column("vec")), np.asarray(part.column("times"))
        member, number = _memberships(part.column("cells").to_pylist())
        before = member[:, number < part.column("cell")[0].as_py()]
        a, b = np.flatnonzero(piece == low), np.flatnonzero(piece == high)
        found = x[a] @ x[b].T >= threshold
        if low == high:
            if not exact:
                found &= member @ member.T > 1
                found |= range_search(x, _local(part.column("near"), pid), x, threshold, np.arange(len(x))) >= threshold
            found |= found.T
            np.fill_diagonal(found, False)
        i, j = np.nonzero(found)
        label = merge_labels(np.arange(len(pid)), a[i], b[j])
        counted = found if exact else found & ~((before[a] @ before[b].T) > 0)
        links = np.zeros(len(pid), dtype=np.int64)
        links[a] += counted @ times[b]
        if low != high:
            links[b] += counted.T @ times[a]
        return pa.RecordBatch.from_arrays([pa.array(pid), pa.array(links), pa.array(pid[label])], ["pid", "links", "centre"])

    def run(batches):
        for table in whole_groups(batches, BLOCK, 2 * SHARD):
            bounds = group_bounds(table, BLOCK)
            for s, e in zip(bounds, bounds[1:], strict=False):
                yield block(table.slice(s, e - s))

    return run


def _whole_cells(points: DataFrame) -> DataFrame:
    """(pid, cell, pieces) with every label as one shard."""
    sizes = points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(SHARD))).cast("int").alias("pieces"))
    return points.select("pid", "cell").join(save(sizes, "vec-pieces"), "cell").select("pid", "cell", "pieces")


def _found(points: DataFrame, overlap: int, threshold: float, exact: bool = False) -> DataFrame:
    """(pid, links, centre) rows, one per point and searched block."""
    members = save(_whole_cells(points) if exact else shards(points, overlap), "vec-shards")
    piece = F.pmod(F.xxhash64(F.lit("piece"), F.col("pid")), F.col("pieces")).cast("int").alias("piece")
    placed = members.select("pid", "cell", "pieces", piece)
    graph_in = placed.join(points.select("pid", "vec"), "pid").select("cell", "piece", "pid", "vec")
    graph_in = graph_in.repartition(*PIECE).sortWithinPartitions(*PIECE, "pid")
    near = graph_in.mapInArrow(_graphs, "pid long, near array<long>")
    near = near.groupBy("pid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    cells = members.groupBy("pid").agg(F.collect_set("cell").alias("cells"))
    full = save(points.select("pid", "vec", "times").join(near, "pid").join(cells, "pid"), "vec-graph")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    asked = placed.select("pid", "cell", "piece", other.alias("other"))
    asked = asked.select("pid", "cell", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"), "piece")
    dealt = asked.join(full, "pid").repartition(*BLOCK).sortWithinPartitions(*BLOCK, "pid")
    return save(dealt.mapInArrow(_search(threshold, exact), "pid long, links long, centre long"), "vec-found")


def _exact_links(sample, threshold: float):
    """Task: for the sampled points, the exact links with the rows of the task, by label."""

    def run(batches):
        groups = {}
        for pid, cell, vec in sample.value:
            groups.setdefault(cell, []).append((pid, vec))
        groups = {c: (np.array([p for p, _ in g]), np.array([v for _, v in g])) for c, g in groups.items()}
        total: dict[int, int] = {}
        for table in whole_groups(batches, ("cell",), 1):
            bounds = group_bounds(table, ("cell",))
            for s, e in zip(bounds, bounds[1:], strict=False):
                part = table.slice(s, e - s)
                if (got := groups.get(part.column("cell")[0].as_py())) is None:
                    continue
                linked = (got[1] @ _unit(part.column("vec")).T >= threshold) & (got[0][:, None] != np.asarray(part.column("pid"))[None, :])
                for p, n in zip(got[0].tolist(), (linked @ np.asarray(part.column("times"))).tolist(), strict=True):
                    total[p] = total.get(p, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["pid", "exact"])

    return run


def audit(points: DataFrame, links: DataFrame, threshold: float, queries: int = 256) -> float:
    """Share of the exact links of about ``queries`` sampled points that were found, or its mean over
    the points that have links if that is lower (1 if there are none)."""
    n = points.count()
    chosen = points.where(F.pmod(F.xxhash64(F.lit("audit"), F.col("pid")), F.lit(max(1, n // queries))) == 0)
    sample = [(r["pid"], r["cell"], np.array(r["vec"]) / np.linalg.norm(r["vec"])) for r in chosen.limit(4 * queries).select("pid", "cell", "vec").collect()]
    shared = points.sparkSession.sparkContext.broadcast(sample)
    # within a task the rows of one label come together
    exact = points.select("cell", "pid", "vec", "times").sortWithinPartitions("cell").mapInArrow(_exact_links(shared, threshold), "pid long, exact long")
    exact = exact.groupBy("pid").agg(F.sum("exact").alias("exact"))
    got = exact.where("exact > 0").join(links, "pid", "left").select("exact", F.least("exact", F.coalesce("links", F.lit(0))).alias("found"))
    r = got.agg(F.sum("exact").alias("exact"), F.sum("found").alias("found"), F.avg(F.col("found") / F.col("exact")).alias("mean")).first()
    return min(r["found"] / r["exact"], r["mean"]) if r["exact"] else 1.0


def near_vectors(vectors: DataFrame, threshold: float = 0.93, overlap: int = 3, min_recall: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    points, rows = points_of(vectors)
    exact = False
    while True:
        found = _found(points, overlap, threshold, exact)
        links = save(found.groupBy("pid").agg(F.sum("links").alias("links")), "vec-links")
        recall = audit(points, links, threshold)
        logging.getLogger(__name__).info("overlap %d: recall %.4f", overlap, recall)
        if exact or recall >= min_recall:
            break
        exact = overlap > CENTRES // 8
        overlap *= 2
    linked = components(found.select("pid", "centre"), "pid", "centre")
    grouped = points.select("pid", "label", "vec", "times", "rep").join(linked, F.col("pid") == F.col("node"), "left")
    grouped = save(grouped.withColumn("component", F.coalesce("component", "pid")).drop("node"), "vec-grouped")
    smallest = save(grouped.groupBy("component").agg(F.min("rep").alias("component_id")), "vec-smallest")
    result = grouped.join(smallest, "component").join(links, "pid", "left")
    result = save(
        result.select(F.col("label").alias("_label"), F.col("vec").alias("_vec"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"),
        "vec-result",
    )
    joined = rows.join(result, rows["label"].eqNullSafe(result["_label"]) & rows["vec"].eqNullSafe(result["_vec"]), "left")
    component = F.when(F.col("_vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
