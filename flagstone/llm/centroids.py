"""Centroid clustering of integer vectors with built-in expressions only.

Vectors become integers, ``floor(scale * x)``. The distance to a centroid is
``zip_with`` and ``aggregate`` over the vector and a literal array, the cluster
is the ``array_min`` of structs (distance, number), so ties go to the smaller
number. Each round takes one aggregate: column sums and a count per cluster,
partial inside every task, so a cluster that holds a third of all rows costs a
task one row. What comes to the driver is ``k`` rows of ``dim`` sums, whatever
the size of the table. All arithmetic is on whole numbers: runs agree exactly.

Nothing is written between the rounds; a lost executor repeats its tasks.

Defined cases: a vector that is null, has another length than ``dim``, or holds
a null, non-finite or (after scaling, beyond ``LARGEST``) too large component
is left out; the seeds are the ``k`` kept rows with the smallest digests, equal
digests (repeated or null ids) in the order of their vectors; with fewer rows
than ``k`` every row is a seed; seeds may be equal, and the later ones then
stay empty and as they are; an empty table gives no rows; other columns of the
table are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest scaled component: a squared distance over 256 of them fits a long.
LARGEST = 2**26


@dataclass(frozen=True)
class Clustering:
    """Rows (vec_id, cluster, distance), the final centroids, and per cluster its rows and inertia."""

    rows: DataFrame
    centroids: list[list[int]]
    sizes: dict[int, int]
    inertias: dict[int, int | None]


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``vec_id`` and ``v``, the integer vector, of the rows that take part."""
    x = F.col(vector_col)
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    fits = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double") * F.lit(float(scale))) <= F.lit(float(LARGEST)), F.lit(False)))
    # NaN is above every number, so the comparison leaves it out as well
    usable = (F.size(x) == dim) & fits
    return table.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("vec_id"), scaled.alias("v"))


# Expressions are written as SQL text and parsed at once: thousands of literals
# and functions as Column objects would cost the driver a round trip each.


def squared_distance(vector: str, centroid: Sequence[int]) -> str:
    to = ", ".join(f"{int(c)}L" for c in centroid)
    return f"aggregate(zip_with({vector}, array({to}), (a, b) -> a - b), 0L, (total, d) -> total + d * d)"


def nearest(vector: str, centroids: Sequence[Sequence[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid."""
    each = [f"struct({squared_distance(vector, c)} AS distance, {i} AS cluster)" for i, c in enumerate(centroids)]
    return F.expr(f"array_min(array({', '.join(each)}))")


def seeds(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors of the ``k`` rows with the smallest digest of their id."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in vectors.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: the floor of the mean of their rows; without rows, as they were."""
    dim = len(centroids[0])
    near = vectors.select("v", nearest("v", centroids).alias("near")).select("v", F.col("near.cluster").alias("cluster"))
    sums = near.groupBy("cluster").agg(F.expr("count(1) AS n"), *[F.expr(f"sum(v[{i}]) AS s{i}") for i in range(dim)])
    found = {r["cluster"]: [r[f"s{i}"] // r["n"] for i in range(dim)] for r in sums.collect()}
    return [found.get(i, c) for i, c in enumerate(centroids)]


def cluster(
    table: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dim: int = 64,
    scale: int = 64,
    seed: str = "1",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clustering:
    """Assign every vector to one of ``k`` centroids after ``rounds`` rounds."""
    vectors = integer_vectors(table, id_col, vector_col, dim, scale)
    centroids = seeds(vectors, k, seed)
    if not centroids:
        none = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering(none, [], {}, {})
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    near = vectors.select("vec_id", nearest("v", centroids).alias("near"))
    rows = near.select("vec_id", F.col("near.cluster").alias("cluster"), F.col("near.distance").alias("distance"))
    # null where a sum does not fit a long
    totals = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.expr("try_sum(distance)").alias("inertia")).collect()
    return Clustering(rows, centroids, {r["cluster"]: r["n"] for r in totals}, {r["cluster"]: r["inertia"] for r in totals})


def centroid_digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_totals(found: Clustering) -> DataFrame:
    """The rows with the inertia of their cluster and of all, and the digest of their centroid."""
    at = F.col("cluster")

    def by_cluster(values: list, ddl: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(ddl) for v in values]), at) if values else F.lit(None).cast(ddl)

    each = [found.inertias.get(i, 0) for i in range(len(found.centroids))]
    whole = None if any(x is None for x in each) or sum(each) >= 2**63 else sum(each)
    return found.rows.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster(each, "long").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"),
        by_cluster([centroid_digest(c) for c in found.centroids], "string").alias("centroid_sha256"),
    )
