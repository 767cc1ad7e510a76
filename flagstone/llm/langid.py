"""Language identification as multilingual mixture inference.

Every language is a distribution over character trigrams, learned from labelled
texts. A document is a mixture: each word comes from one language, with the
likelihood of its trigrams. Expectation-maximisation estimates the proportions
of the languages in each document. Which languages take part is chosen by
penalised likelihood: languages are added in the order of their estimated
proportions as long as the log-likelihood gains more than ``penalty`` times the
logarithm of the number of words.

Training reads whole texts of at most about ``per_language`` documents of each
language, chosen by a hash of the id; the counts (languages times ``buckets``)
are summed by Spark and bounded. Documents are scored in batches inside tasks.
"""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, steps

UNKNOWN = "und"
RESULT = "lang_pred string, score double, langs array<string>, shares array<double>"


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)], dtype=bool)


def word_trigrams(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around every letter (a word border counts as a space), the
    index of its first trigram for every word, and the text of every word."""
    joined = "\n".join(t or "" for t in texts)
    lowered = joined.lower()
    if len(lowered) != len(joined):  # a few letters grow in lower case: keep one each
        lowered = "".join(c.lower()[0] for c in joined)
    points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    padded = np.r_[np.uint32(32), points, np.uint32(32)]
    letter = _letters()[padded]
    padded = np.where(letter, padded, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    key = (padded[at - 1] << np.uint64(42)) | (padded[at] << np.uint64(21)) | padded[at + 1]
    first = np.flatnonzero(~letter[at - 1])
    text = np.searchsorted(ends, at[first] - 1, side="right")
    return (mix64(key) % np.uint64(buckets)).astype(np.int64), first, text


def _count(languages_column: str, buckets: int):
    """Task: trigram counts by language, one row per language and used bucket."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in steps([whole], "text"):
                langs, texts = batch.column(languages_column).to_pylist(), batch.column("text").to_pylist()
                for lang in set(langs):
                    grams, _, _ = word_trigrams([t for t, x in zip(texts, langs, strict=True) if x == lang], buckets)
                    total.setdefault(lang, np.zeros(buckets, np.int64))
                    total[lang] += np.bincount(grams, minlength=buckets)
        for lang, n in total.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(n[used])], ["lang", "bucket", "n"])

    return run


class Model:
    """Log-probabilities of trigram buckets by language (rows in name order)."""

    def __init__(self, counts: dict[str, np.ndarray], buckets: int, smoothing: float = 0.2):
        self.languages = sorted(counts)
        self.buckets = buckets
        n = np.array([counts[x] for x in self.languages], dtype=float).reshape(len(self.languages), buckets) + smoothing
        self.log_p = np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32).T.copy()

    @staticmethod
    def _fit(like, start, owner, size, mask, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Proportions by expectation-maximisation among the languages of ``mask``, and the log-likelihood."""
        share = mask / mask.sum(axis=1, keepdims=True)
        for _ in range(rounds):
            joint = like * share[owner]
            joint /= joint.sum(axis=1, keepdims=True) + 1e-300
            share = np.add.reduceat(joint, start, axis=0) / size[:, None]
        fitted = np.log((like * share[owner]).sum(axis=1) + 1e-300)
        return share, np.add.reduceat(fitted, start)

    def infer(self, texts: list[str | None], penalty: float = 2.0, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the languages in each text (0 outside the chosen set), and words per text."""
        grams, first, text = word_trigrams(texts, self.buckets)
        n_words = np.bincount(text, minlength=len(texts))
        shares = np.zeros((len(texts), len(self.languages)))
        if not len(first) or not self.languages:
            return shares, n_words
        words = np.add.reduceat(self.log_p[grams], first, axis=0).astype(float)
        top = words.max(axis=1, keepdims=True)
        like = np.exp(words - top)
        start = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        owner, size = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(text)])), n_words[text[start]]

        order, every = self._fit(like, start, owner, size, np.ones((len(start), len(self.languages))), rounds)
        order = np.argsort(-order, axis=1, kind="stable")
        rows = np.arange(len(start))
        best = np.zeros((len(start), len(self.languages)))
        best[rows, order[:, 0]] = 1
        value = np.add.reduceat(np.log(like[np.arange(len(owner)), order[owner, 0]] + 1e-300), start)
        # no set gains more than all languages together
        bar = penalty * np.log(size + 1)
        growing = np.flatnonzero(every - value > bar)
        for k in range(1, len(self.languages)):
            if not len(growing):
                break
            at = np.zeros(len(start), dtype=np.int64)
            at[growing] = np.arange(len(growing))
            chosen = np.isin(owner, growing)
            mask = (best[growing] > 0).astype(float)
            mask[np.arange(len(growing)), order[growing, k]] = 1
            first_word = np.r_[0, np.cumsum(size[growing])[:-1]]
            share, gained = self._fit(like[chosen], first_word, at[owner[chosen]], size[growing], mask, rounds)
            better = gained - value[growing] > bar[growing]
            growing = growing[better]
            best[growing], value[growing] = share[better], gained[better]
        shares[text[start]] = best
        return shares, n_words


def train(labelled: DataFrame, per_language: int = 4000, buckets: int = 1 << 16, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from the rows of ``labelled`` with a language and a text.

    The sample is bounded by languages times ``per_language`` documents, the counts
    that reach the driver by languages times ``buckets`` numbers."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").count().collect()
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["count"]))]) if sizes else None
    if share is not None:
        place = F.pmod(F.xxhash64(F.lit("train"), F.col("id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        rows = rows.where(place < share[F.col("lang")])
    counted = rows.mapInArrow(_count("lang", buckets), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for lang, bucket, n in counted.toPandas().itertuples(index=False):
        counts.setdefault(lang, np.zeros(buckets))[bucket] = n
    return Model(counts, buckets)


def _infer(model, penalty: float):
    def run(batches):
        m = model.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for whole in batches:
            for batch in steps([whole], "text", 1 << 20):
                shares, n_words = m.infer(batch.column("text").to_pylist(), penalty)
                known = (n_words > 0) & (len(m.languages) > 0)
                top = shares.argmax(axis=1) if len(m.languages) else np.zeros(len(n_words), np.int64)
                score = shares[np.arange(len(top)), top] if len(m.languages) else np.zeros(len(n_words))
                chosen = [np.flatnonzero(s) for s in shares]
                chosen = [c[np.argsort(-s[c], kind="stable")] for c, s in zip(chosen, shares, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in batch.schema.names if n != "text"],
                        pa.array(names[np.where(known, top, len(m.languages))], pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                        pa.array([[m.languages[i] for i in c] for c in chosen], pa.list_(pa.string())),
                        pa.array([s[c].tolist() for c, s in zip(chosen, shares, strict=True)], pa.list_(pa.float64())),
                    ],
                    [*[n for n in batch.schema.names if n != "text"], "lang_pred", "score", "langs", "shares"],
                )

    return run


def identify(docs: DataFrame, model: Model, penalty: float = 2.0, keep: list[Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, langs, shares) for every row: the language of the largest
    proportion, that proportion, and the chosen set, largest first.

    Defined cases: a null text, or one without a letter, is ``und`` with score 0
    and an empty set; so is every text if nothing was learned; equal proportions
    go to the language first by name; repeated rows get repeated results; extra
    columns are ignored."""
    source = docs.select(F.col(id_col).alias("doc_id"), *(keep or []), F.col(text_col).cast("string").alias("text"))
    fields = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in source.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return source.mapInArrow(_infer(shared, penalty), ", ".join([*fields, RESULT]))
