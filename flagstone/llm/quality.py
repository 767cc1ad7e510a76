"""Quality classifier with hierarchical empirical Bayes.

1. Document evidence: a logistic regression on measures of the whole text
   (letters, symbols, capitals, repetition, line and word shape), fitted on at
   most ``max_labels`` labelled documents.
2. Site evidence: the evidence of all documents is summed by host (the source
   up to its first ``/``) and by path (host and first path part). Posterior
   means shrink a path towards its host and a host towards the global mean; the
   strength of each prior comes from the spread between the groups (method of
   moments), so sparse sites stay near the prior.
3. Decision: the log-odds of the document, moved by the log-odds of its path
   against the global ones.

Step 2 is grouped aggregation; the only rows that reach the driver are the
bounded training sample and one row of moments per level.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, broadcast_if_small, put_back, raw_texts, save, set_aside, steps

MAX_BROADCAST_SITES = 100_000
N_FEATURES = 13

_ASCII = np.arange(256)
_IS_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_IS_LETTER = _IS_UPPER | ((_ASCII >= 97) & (_ASCII <= 122)) | (_ASCII >= 128)
_IS_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_IS_SPACE = (_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13))
_IS_STOP = np.isin(_ASCII, [ord(c) for c in ".,;:'\"-()"])
# 0 letter, 1 capital, 2 digit, 3 space, 4 usual punctuation, 5 other symbol
_KIND = np.select([_IS_UPPER, _IS_LETTER, _IS_DIGIT, _IS_SPACE, _IS_STOP], [1, 0, 2, 3, 4], 5).astype(np.uint8)


def features(text: bytes | None) -> np.ndarray:
    """Measures of one text; zeros where there are no words."""
    words = text.split() if text else []
    out = np.zeros(N_FEATURES)
    if not words:
        return out
    n = np.bincount(_KIND[np.frombuffer(text, dtype=np.uint8)], minlength=6).astype(float)
    letters, seen = max(1.0, n[0] + n[1]), max(1.0, n.sum() - n[3])
    distinct = len(set(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    bare = sum(1 for w in words if len(w) == 1 and _KIND[w[0]] >= 4)
    out[0] = n[5] / seen
    out[1] = n[1] / letters
    out[2] = n[2] / seen
    out[3] = n[4] / seen
    out[4] = np.log(distinct / len(words))
    out[5] = np.log(len(words)) / 10
    out[6] = out[4] * out[5]
    out[7] = bare / len(words)
    out[8] = np.log1p(seen / len(words)) / 3
    out[9] = 1 - len(set(lines)) / max(1, len(lines))
    out[10] = sum(map(len, set(words))) / max(1, sum(map(len, words)))
    out[11] = np.sqrt(out[0])
    out[12] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    return out


class Classifier:
    """Logistic regression with standardised features, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
        spread = x.std(axis=0) if len(x) else np.ones(N_FEATURES)
        self.spread = np.where(spread > 1e-9, spread, 1.0)
        self.weights = np.zeros(N_FEATURES + 1)
        if len(set(y.tolist())) < 2:  # one class or no labels: its smoothed share for every document
            good = (y.sum() + 1) / (len(y) + 2)
            self.weights[0] = np.log(good / (1 - good))
            return
        a = self._design(x)
        penalty = np.diag([1e-6] + [ridge] * N_FEATURES)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ self.weights, -30, 30)))
            slope = a.T @ (y - p) - penalty @ self.weights
            curve = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + penalty
            step = np.linalg.solve(curve, slope)
            self.weights += step
            if np.abs(step).max() < 1e-8:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(x)), (x - self.mean) / self.spread]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.weights, -12, 12)


def _labelled(docs: DataFrame, labels: DataFrame, max_labels: int, id_col: str, text_col: str) -> DataFrame:
    """At most about ``max_labels`` labelled documents, chosen by a hash of the id.

    A document with several labels counts as good if most of them say so."""
    votes = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_doc"))
    votes = votes.agg((F.avg("quality") >= 0.5).cast("double").alias("good"))
    share = max_labels / max(1, votes.count())
    if share < 1:
        votes = votes.where(F.pmod(F.xxhash64("_doc"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = save(votes, "quality-labels")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(broadcast_if_small(chosen, max_labels, 1_000_000), F.col("_id") == F.col("_doc")).select("text", "good")


def _featured(batches):
    for whole in batches:
        for batch in steps([whole], "text"):
            x = [features(t).tolist() for t in raw_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(x, pa.list_(pa.float64()))], ["good", "x"])


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Fit on a bounded sample: only a row of measures per sampled document reach the driver."""
    rows = _labelled(docs, labels, max_labels, id_col, text_col).mapInArrow(_featured, "good double, x array<double>").collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(-1, N_FEATURES)
    return Classifier(x, np.array([r["good"] for r in rows], dtype=float))


def _log_odds(model: Classifier, text_col: str, keep_text: bool):
    def run(batches):
        for whole in batches:
            for batch in steps([whole], text_col):
                x = np.array([features(t) for t in raw_texts(batch, text_col)]).reshape(-1, N_FEATURES)
                names = [n for n in batch.schema.names if keep_text or n != text_col]
                columns = [batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(model.log_odds(x))], [*names, "_log_odds"])

    return run


def with_log_odds(docs: DataFrame, model: Classifier, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    passed = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    return docs.mapInArrow(_log_odds(model, text_col, keep_text), arrow_schema(passed, "_log_odds double"))


def host_of(source: Column) -> Column:
    """The source without a scheme, up to its first slash; a null source is the host ''."""
    return F.coalesce(F.regexp_extract(source, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/]*)", 1), F.lit(""))


def path_of(source: Column) -> Column:
    """Host and first path part."""
    return F.coalesce(F.regexp_extract(source, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/]*/?[^/?#]*)", 1), F.lit(""))


def _strength(groups: DataFrame, prior: str) -> float:
    """Prior strength in documents, by moments: the mean spread inside a group against the
    spread between groups that sampling does not explain. 1 to 10,000."""
    m, v = F.col(prior), F.col("good") / F.col("n")
    r = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * (v - m) * (v - m)).alias("between"),
        F.sum("inside").alias("inside"),
    ).first()
    if not r["n"] or r["n"] <= r["k"]:
        return 1.0
    inside = max(r["inside"] / (r["n"] - r["k"]), 1e-9)
    between = (r["between"] - r["k"] * inside) / max(r["n"] - r["nn"] / r["n"], 1.0)
    return float(min(max(inside / max(between, 1e-9), 1.0), 10_000.0))


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, n, path_mean) for every path, and the global mean.

    ``scored`` has host, path and p (the evidence of each document, 0 to 1)."""
    sums = [F.count(F.lit(1)).alias("n"), F.sum("p").alias("good"), F.sum(F.col("p") * F.col("p")).alias("squares")]
    paths = save(scored.groupBy("host", "path").agg(*sums), "quality-paths")
    inside = (F.col("squares") - F.col("good") * F.col("good") / F.col("n")).alias("inside")
    paths = paths.select("host", "path", "n", "good", "squares", inside)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("squares").alias("squares"))
    hosts = hosts.select("host", "n", "good", inside)
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = (total["good"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    hosts = hosts.withColumn("mean", F.lit(mean))
    k = _strength(hosts, "mean")
    hosts = hosts.select("host", ((F.col("good") + k * F.col("mean")) / (F.col("n") + k)).alias("host_mean"))
    paths = save(paths.join(hosts, "host"), "quality-hosts")
    k = _strength(paths, "host_mean")
    return paths.select("host", "path", "n", ((F.col("good") + k * F.col("host_mean")) / (F.col("n") + k)).alias("path_mean")), mean


def _logit(p):
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def _combined(scored: DataFrame, sites: DataFrame, mean: float) -> DataFrame:
    """Add ``probability``: the document evidence moved by that of its path."""
    sites = sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "path_mean")
    sites = broadcast_if_small(sites, sites.count(), MAX_BROADCAST_SITES)
    joined = scored.join(sites, (scored["_h"] == sites["_host"]) & (scored["_p"] == sites["_path"]))
    odds = F.col("_log_odds") + _logit(F.col("path_mean")) - _logit(F.lit(mean))
    return joined.withColumn("probability", 1 / (1 + F.exp(-odds))).drop("_host", "_path", "_h", "_p")


def quality_scores(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, document, path_mean, probability, good) for every row.

    Defined cases: null, empty and word-less texts have zero measures, scored
    like any other; a null source is a site of its own; labels for unknown ids
    or other than 0 and 1 are ignored; without labels of both kinds the
    evidence is the smoothed share of good labels (0.5 without any); repeated
    rows count one by one; an empty table gives no rows; extra columns are
    ignored."""
    model = fit(docs, labels, max_labels, id_col, text_col)
    source = F.col(source_col).cast("string")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), host_of(source).alias("_h"), path_of(source).alias("_p"), F.col(text_col).cast("string").alias("text")
    )
    scored = save(with_log_odds(narrow, model, keep_text=False), "quality-scores")
    evidence = (1 / (1 + F.exp(-F.col("_log_odds")))).alias("p")
    sites, mean = site_posteriors(scored.select(F.col("_h").alias("host"), F.col("_p").alias("path"), evidence))
    out = _combined(scored, sites, mean)
    return out.select("doc_id", evidence.alias("document"), "path_mean", "probability", (F.col("probability") >= 0.5).alias("good"))


def keep_good(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> DataFrame:
    """``docs`` (doc_id, text, source and more) without the documents the classifier rejects."""
    model = fit(docs, labels, max_labels)
    plain = set_aside(docs, "text", "source")
    source = F.col("source").cast("string")
    sited = plain.select("*", host_of(source).alias("_h"), path_of(source).alias("_p"))
    evidence = (1 / (1 + F.exp(-F.col("_log_odds")))).alias("p")
    scored = with_log_odds(sited.select("_h", "_p", F.col("text").cast("string").alias("text")), model, keep_text=False)
    sites, mean = site_posteriors(scored.select(F.col("_h").alias("host"), F.col("_p").alias("path"), evidence))
    out = _combined(with_log_odds(sited, model), sites, mean)
    return put_back(out.where("probability >= 0.5"), docs, "text", "source")
