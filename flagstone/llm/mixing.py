"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Every copy of a document gets the virtual finish time at which a fair queue
would have sent it: the tokens of its source up to and including it, in a
shuffled order, divided by the target of the source. Copies are range-sorted
by finish time over the whole corpus and cut where the total budget is spent.
A source whose target exceeds its size is queued again, up to ``max_epochs``
times.

Prefix sums never pass through one task: a source is cut into hash ranges of
about ``slice_rows`` documents, running sums are taken inside a slice and the
slice totals are added on top. The order of the sources, the order in which they
fill up and the range where the budget is spent are cut into ranges of about
20,000 rows in the same way.

Defined cases: a null or blank text has size 0 and is never taken; a null
source is a source of its own, last in order; rows equal in every column count
one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, by_shuffle, partitions_for, put_back, save, set_aside, text_key

WORDS = r"[^\x20\x09-\x0D]+"
# Sources are broadcast up to this many rows (about 10 MB), else joined by shuffle.
MAX_BROADCAST_SOURCES = 100_000
# Rows that a running sum over a whole order takes in one task.
RANGE_ROWS = 20_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def before_all(df: DataFrame, order: list[Column], sums: dict[str, str], rows: int, per_range: int = RANGE_ROWS) -> DataFrame:
    """Add for every name in ``sums`` the sum of its column over all rows ahead in ``order``.

    The rows are range-sorted and written; sums run inside a range, and the totals
    of the ranges ahead come on top, so no task holds more than one range."""
    ranged = df.repartitionByRange(-(-max(rows, 1) // per_range), *order).select("*", F.spark_partition_id().alias("range"))
    ranged = save(ranged, "mix-ranges")
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    totals = totals.select("range", *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"{n}_ahead") for n in sums])
    ranged = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{n}_inside") for n, c in sums.items()])
    return ranged.join(totals, "range").select(
        *[f"`{c}`" for c in df.columns], *[(F.col(f"{n}_ahead") + F.col(f"{n}_inside")).alias(n) for n in sums]
    )


def cycle_weights(sizes: DataFrame, rows: int, cycle: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """Give sources, ordered by code point with null last, the weights of ``cycle`` in turn."""
    ranked = before_all(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"sid": "one"}, rows)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return ranked.drop("one").withColumn("weight", F.get(weights, (F.col("sid") % len(cycle)).cast("int")))


def targets(sizes: DataFrame, rows: int, max_epochs: int = 3) -> DataFrame:
    """Add ``target``: the share of the summed ``source_size`` by ``weight``, no source
    above ``max_epochs`` times its size, the excess reshared by weight.

    Sources are ordered by the unit of weight at which they fill up. The first
    one that does not fill fixes the unit of all that follow it."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    s = sizes.select("*", cap.alias("cap"), (cap / F.col("weight")).alias("fills_at"))
    whole = s.agg(F.sum("source_size").cast("double").alias("total"), F.sum("weight").alias("weight")).first()
    s = before_all(s, [F.col("fills_at"), F.col("sid")], {"caps": "cap", "weights": "weight"}, rows)
    unit = (F.lit(whole["total"]) - F.col("caps")) / (F.lit(whole["weight"]) - F.col("weights"))
    s = save(s.select("*", unit.alias("unit")), "mix-units")
    place = F.struct("fills_at", "sid", "unit")
    edge = s.where(F.col("cap") > F.col("unit") * F.col("weight")).agg(F.min(place).alias("first")).first()["first"]
    target = F.col("cap")
    if edge is not None:
        full = F.struct("fills_at", "sid") < F.struct(F.lit(edge["fills_at"]).alias("fills_at"), F.lit(edge["sid"]).alias("sid"))
        target = F.when(full, F.col("cap")).otherwise(F.lit(edge["unit"]) * F.col("weight"))
    return s.select("source", "sid", "source_size", "n_docs", "weight", target.alias("target"))


def _queue(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    """One narrow row per document: id, source, size and its place in the shuffle."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        text_key(F.col(text_col).cast("string")).alias("text_key"),
        word_count(text_col).alias("size"),
        digest.alias("place"),
    )


def _running_sums(queue: DataFrame, sources: DataFrame, slice_rows: int) -> DataFrame:
    """Add ``upto``: words of the source up to and including the document."""
    joined = queue.join(sources, queue["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    n_slices = F.ceil(F.col("n_docs") / F.lit(slice_rows))
    at = F.conv(F.substring("place", 1, 12), 16, 10).cast("long") / F.lit(float(16**12))
    sliced = joined.withColumn("slice", F.floor(at * n_slices))
    sums = save(sliced.groupBy("sid", "slice").agg(F.sum("size").alias("slice_size")), "mix-slices")
    ahead = Window.partitionBy("sid").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "slice", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("sid", "slice").orderBy("place", "doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    sliced = sliced.withColumn("inside", F.sum("size").over(inside))
    return sliced.join(sums, ["sid", "slice"]).withColumn("upto", F.col("ahead") + F.col("inside")).drop("inside", "ahead", "slice")


def _finish(epoch: Column) -> Column:
    return F.try_divide((epoch - 1) * F.col("source_size") + F.col("upto"), F.col("target"))


def _edge(ranges: DataFrame, budget: int):
    """The first range whose running total exceeds ``budget``: its number, rows, words
    and the words ahead of it, or None."""
    totals = ranges.groupBy("range").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    upto = F.sum("words").over(Window.orderBy("range"))
    totals = totals.select("range", "words", "n", upto.alias("upto"))
    return totals.where(F.col("upto") > F.lit(budget)).orderBy("range").first()


def _cut(queued: DataFrame, max_epochs: int, per_partition: int = 2_000_000, leaf: int = RANGE_ROWS):
    """Finish time and source of the first copy beyond the budget, or None.

    The copies are range-sorted once and written; the budget is followed over
    the totals of the sorted ranges. The range where it is spent is cut into
    ranges again, until one holds at most ``leaf`` copies or copies of one place."""
    spark = queued.sparkSession
    copies = (
        queued.where("size > 0 AND target > 0")
        .select("sid", "size", F.explode(F.array([_finish(F.lit(e)) for e in range(1, max_epochs + 1)])).alias("finish"))
    )
    stats = queued.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not stats[1]:
        return None
    budget, parts = stats[1], partitions_for(spark, stats[0] * max_epochs, per_partition)
    while True:
        ranges = copies.repartitionByRange(parts, "finish", "sid").select("*", F.spark_partition_id().alias("range"))
        ranges = save(ranges, "mix-sorted")
        edge = _edge(ranges, budget)
        if edge is None:
            return float("inf"), 0
        budget -= edge["upto"] - edge["words"]
        copies = ranges.where(F.col("range") == edge["range"]).drop("range")
        place = F.struct("finish", "sid")
        ends = copies.agg(F.min(place).alias("first"), F.max(place).alias("last")).first()
        if ends["first"] == ends["last"]:
            return tuple(ends["first"])
        if edge["n"] <= leaf:
            break
        parts = max(2, -(-edge["n"] // leaf))
    running = F.sum("size").over(Window.orderBy("finish", "sid").rowsBetween(Window.unboundedPreceding, 0))
    last = copies.select("finish", "sid", running.alias("upto")).where(F.col("upto") > F.lit(budget))
    return tuple(last.orderBy("finish", "sid").first()[:2])


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    cycle: tuple[float, ...] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix",
    slice_rows: int = 2000,
) -> DataFrame:
    """One row per document: doc_id, text_key, source, size, source_size, target, epochs, taken.

    ``epochs`` is how often the mix takes the document (0 to ``max_epochs``) and
    ``taken`` the words that makes. The same input and seed give the same mix."""
    queue = save(_queue(docs, id_col, source_col, text_col, seed), "mix-queue")
    sizes = queue.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    sizes = save(sizes, "mix-sizes")
    n_sources = sizes.count()
    sources = save(targets(cycle_weights(sizes, n_sources, cycle), n_sources, max_epochs), "mix-sources")
    sources = broadcast_if_small(sources, n_sources, MAX_BROADCAST_SOURCES)
    queued = save(_running_sums(queue, sources, slice_rows), "mix-queued")
    cut = _cut(queued, max_epochs)
    epochs = F.lit(0)
    if cut is not None:
        for e in range(1, max_epochs + 1):
            f = _finish(F.lit(e))
            within = (f < F.lit(cut[0])) | ((f == F.lit(cut[0])) & (F.col("sid") < F.lit(cut[1])))
            epochs = epochs + F.when((F.col("size") > 0) & (F.col("target") > 0) & within, 1).otherwise(0)
    return queued.select(
        "doc_id", "text_key", "source", "size", "source_size", "target", epochs.alias("epochs"), (F.col("size") * epochs).alias("taken")
    )


def mixed_documents(docs: DataFrame, cycle: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """``docs`` (doc_id, text, source and more) that the mix takes, with ``epochs``.

    Rows equal in id and text get the largest number of epochs among them."""
    taken = mix(docs, cycle=cycle, max_epochs=max_epochs).where("epochs > 0")
    taken = taken.groupBy("doc_id", "text_key").agg(F.max("epochs").alias("epochs"))
    taken = taken.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "epochs")
    plain = set_aside(docs, "doc_id", "text")
    same = plain["doc_id"].eqNullSafe(F.col("_doc")) & (text_key(plain["text"].cast("string")) == F.col("_key"))
    return put_back(plain.join(by_shuffle(taken), same), docs, "doc_id", "text", added=("epochs",))
