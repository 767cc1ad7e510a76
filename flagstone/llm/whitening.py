"""Embedding whitening by principal components.

Entries become whole numbers, ``floor(scale * c) + offset``. Four passes over
the table: sums per dimension (exact), the covariance of the centred vectors,
and, for the audit, sums and covariance of the whitened vectors. A task returns
one small matrix; the matrices are summed by Spark, entry by entry, so the
driver gets ``dim * dim`` numbers whatever the number of tasks. The leading
eigenvectors of that matrix are found there (:mod:`.eigen`) and broadcast: they
have the size of ``components`` vectors. Nothing is written in between; each
pass reads the table again.

Vectors are centred before they are multiplied, as ``n * x - S`` in whole
numbers and divided by ``n`` once, so a large offset costs no digits.

Defined cases: a vector that is null, empty, or holds a null, non-finite or
(scaled, beyond ``LARGEST``) too large entry is left out; so are vectors of
another length than most have (of equally frequent lengths the longest counts);
repeated rows and rows without an id are vectors like any other; a component
without variance (its eigenvalue is zero to rounding) gets ``whitened`` null and
is left out of the identity error; ``deviation`` is null where it does not fit a
long; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save
from .eigen import EPS, leading

# Largest scaled entry, so that entries are exact in double precision.
LARGEST = 2**52
# Vectors handled at once inside a task.
STEP_ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """What the projection needs: vectors and sums of the fit, and the components."""

    n: int
    sums: list[int]
    least: list[int]
    most: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def usable(self) -> np.ndarray:
        """Components that have variance."""
        return self.values > len(self.sums) * EPS * max(float(self.values.max(initial=0.0)), 0.0)


# --- vectors in tasks ------------------------------------------------------------


def _columns(batch: pa.RecordBatch, scale: float, offset: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, ids, integer vectors) of the usable rows of a batch, by length."""
    ids, lists = batch.column("vec_id"), batch.column("vector")
    size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
    for length in np.unique(size[size > 0]):
        at = np.flatnonzero(size == length)
        for start in range(0, len(at), STEP_ROWS):
            rows = at[start : start + STEP_ROWS]
            flat = lists.take(pa.array(rows)).flatten().cast(pa.float64())
            c = np.asarray(flat.fill_null(np.nan)).reshape(len(rows), length)
            with np.errstate(all="ignore"):
                x = np.floor(c * scale)
                good = (np.abs(x) <= LARGEST).all(axis=1)
            if good.any():
                yield int(length), ids.take(pa.array(rows[good])), x[good].astype(np.int64) + offset


def _deviations(x: np.ndarray, fit: Whitening) -> np.ndarray:
    """``n * x - S``, exact: machine integers where every product fits, else Python's."""
    largest = max(max(abs(v) for v in (*fit.least, *fit.most)) * fit.n, max(abs(s) for s in fit.sums))
    if largest < 2**62:
        return x * fit.n - np.array(fit.sums, dtype=np.int64)
    return x.astype(object) * fit.n - np.array(fit.sums, dtype=object)


def _centred(x: np.ndarray, fit: Whitening) -> np.ndarray:
    return _deviations(x, fit).astype(np.float64) / fit.n


def _project(x: np.ndarray, fit: Whitening) -> np.ndarray:
    use = fit.usable
    out = np.full((len(x), len(use)), np.nan)
    out[:, use] = _centred(x, fit) @ fit.vectors[use].T / np.sqrt(fit.values[use])
    return out


def _squared(x: np.ndarray, fit: Whitening) -> list[int | None]:
    """Sum of squared deviations per row; None beyond a long."""
    most = sum(max(fit.n * hi - s, s - fit.n * lo) ** 2 for lo, hi, s in zip(fit.least, fit.most, fit.sums, strict=True))
    dev = _deviations(x, fit)
    if most >= 2**63:
        dev = dev.astype(object)
    return [v if v < 2**63 else None for v in (dev * dev).sum(axis=1).tolist()]


# --- passes ----------------------------------------------------------------------


def _matrix(table: DataFrame, scale: float, offset: int, length: int, centred, side: int) -> np.ndarray:
    """Sum over all vectors of the products of ``centred(x)`` with itself."""

    def run(batches):
        total = np.zeros((side, side))
        for batch in batches:
            for n, _, x in _columns(batch, scale, offset):
                if n == length:
                    y = centred(x)
                    total += y.T @ y
        i, j = np.triu_indices(side)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    out = np.zeros((side, side))
    for r in table.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _sums(table: DataFrame, scale: float, offset: int) -> DataFrame:
    """Per length and dimension: vectors, sum, least and largest entry."""

    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for n, _, x in _columns(batch, scale, offset):
                old = found.setdefault(n, [0, [0] * n, x[0], x[0]])
                # sums of halves stay exact in machine integers; their total is Python's
                low, high = (x & 0xFFFFFFFF).sum(axis=0).tolist(), (x >> 32).sum(axis=0).tolist()
                old[0] += len(x)
                old[1] = [s + a + (b << 32) for s, a, b in zip(old[1], low, high, strict=True)]
                old[2], old[3] = np.minimum(old[2], x.min(axis=0)), np.maximum(old[3], x.max(axis=0))
        for n, (rows, sums, least, most) in found.items():
            columns = [pa.array([n] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([rows] * n, pa.int64())]
            columns += [pa.array([str(s) for s in sums]), pa.array(least), pa.array(most)]
            yield pa.RecordBatch.from_arrays(columns, ["length", "dim", "n", "s", "least", "most"])

    parts = table.mapInArrow(run, "length int, dim int, n long, s string, least long, most long")
    return parts.groupBy("length", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def fit(table: DataFrame, components: int, scale: float, offset: int) -> Whitening | None:
    """Sums, covariance, its leading components, and the audit. ``table``: vec_id, vector."""
    sums = save(_sums(table, scale, offset), "whiten-sums")
    top = sums.groupBy("length").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if top is None:
        return None
    length, n = top["length"], top["n"]
    rows = sorted(sums.where(F.col("length") == length).collect(), key=lambda r: r["dim"])
    s, least, most = [int(r["s"]) for r in rows], [r["least"] for r in rows], [r["most"] for r in rows]
    start = Whitening(n, s, least, most, np.zeros(0), np.zeros((0, length)), np.zeros(0))
    covariance = _matrix(table, scale, offset, length, lambda x: _centred(x, start), length) / n
    values, vectors = leading(covariance, components)
    trace = float(np.trace(covariance))
    values = np.maximum(values, 0.0)
    explained = values / trace if trace > 0 else np.zeros(len(values))
    made = Whitening(n, s, least, most, values, vectors, explained)
    return Whitening(n, s, least, most, values, vectors, explained, _identity_error(table, scale, offset, made))


def _identity_error(table: DataFrame, scale: float, offset: int, made: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened vectors less the identity."""
    use, length = made.usable, len(made.sums)
    k = int(use.sum())
    if k == 0:
        return None

    def totals(batches):
        total = np.zeros(k)
        for batch in batches:
            for n, _, x in _columns(batch, scale, offset):
                if n == length:
                    total += _project(x, made)[:, use].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total)], ["i", "v"])

    mean = np.zeros(k)
    for r in table.mapInArrow(totals, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        mean[r["i"]] = r["v"] / made.n
    covariance = _matrix(table, scale, offset, length, lambda x: _project(x, made)[:, use] - mean, k) / made.n
    return float(np.max(np.abs(covariance - np.eye(k))))


def whiten(
    table: DataFrame,
    components: int = 32,
    scale: float = 64.0,
    offset: int = 1_000_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, Whitening | None]:
    """One row per usable vector: vec_id, deviation, whitened (array by component), and the fit."""
    plain = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    id_type = plain.schema["vec_id"].dataType.simpleString()
    made = fit(plain, components, scale, offset)
    schema = f"vec_id {id_type}, deviation long, whitened array<double>"
    if made is None:
        return table.sparkSession.createDataFrame([], schema), None
    held = table.sparkSession.sparkContext.broadcast(made)

    def run(batches):
        f = held.value
        for batch in batches:
            for n, ids, x in _columns(batch, scale, offset):
                if n == len(f.sums):
                    w = _project(x, f)
                    flat = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), flat)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(_squared(x, f), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return plain.mapInArrow(run, schema), made


def by_component(rows: DataFrame, made: Whitening | None) -> DataFrame:
    """One row per vector and component, with the figures of the fit."""
    n, error = (made.n, made.identity_error) if made else (0, None)
    shares = F.array(*[F.lit(float(x)) for x in made.explained]) if made else F.lit(None).cast("array<double>")
    long = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
