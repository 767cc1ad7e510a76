"""Rows without an id, or with one id, are told apart by more than 32 bits of their text."""

import pytest
from pyspark.sql import functions as F

from flagstone.llm.common import text_key
from flagstone.llm.decontam import decontaminate
from flagstone.llm.linededup import drop_repeated_lines
from flagstone.llm.substring import substring_dedup

SHARED = "\n".join(" ".join(f"shared{r}w{i}" for i in range(14)) for r in range(3))
OWN = "\n".join(" ".join(f"own{r}w{i}" for i in range(14)) for r in range(3))


@pytest.fixture(scope="module")
def pair(spark):
    """Two texts, one with a shared passage and one without, that Spark's 32-bit hash takes for equal."""
    n = spark.range(300_000)
    texts = n.select(F.concat(F.lit(SHARED + "\n"), "id").alias("a"), F.concat(F.lit(OWN + "\n"), "id").alias("b"))
    a, b = texts.select(F.hash("a").alias("h"), "a"), texts.select(F.hash("b").alias("h"), "b")
    found = a.join(b, "h").first()
    assert found is not None and found.a != found.b
    return found.a, found.b


@pytest.fixture(scope="module")
def docs(spark, pair):
    rows = [(None, pair[0]), (None, pair[1]), (1, SHARED + "\nend"), (7, pair[0]), (7, pair[1]), (None, None), (None, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()


def test_texts_have_keys_of_their_own(docs):
    assert docs.select(text_key("text").alias("k")).distinct().count() == 5  # null and empty apart too
    assert docs.where("text IS NULL").select(F.length(text_key("text"))).first()[0] == 0


def test_lines_of_the_other_text_stay(docs, pair):
    kept = sorted((r.doc_id is None, r.text or "") for r in drop_repeated_lines(docs.where("doc_id IS NULL OR doc_id = 1"), window=3).collect())
    assert (True, pair[1]) in kept


def test_words_of_the_other_text_stay(docs, pair):
    found = substring_dedup(docs.where("doc_id IS NULL OR doc_id = 1"), window=35).collect()
    removed = sorted((r.doc_id is None, r["_n_words"], r["_n_removed"]) for r in found)
    assert removed == [(False, 43, 42), (True, 0, 0), (True, 0, 0), (True, 43, 0), (True, 43, 42)]


@pytest.mark.parametrize("ids", ["doc_id IS NULL", "doc_id = 7"])
def test_the_other_text_is_not_contaminated(spark, docs, pair, ids):
    items = spark.createDataFrame([(1, SHARED)], "item_id long, text string")
    kept = [r.text for r in decontaminate(docs.where(ids), items, window=13, share=20).collect()]
    assert pair[1] in kept and pair[0] not in kept


def test_many_equal_rows_without_id(spark):
    """Equal rows get equal results, in time that grows with their number."""
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(SHARED + "\n" + OWN).alias("text"))
    found = substring_dedup(rows, window=35).groupBy("_n_words", "_n_removed").count().collect()
    assert [tuple(r) for r in found] == [(84, 84, 20_000)]
    kept = drop_repeated_lines(rows, window=3)
    assert kept.count() == 20_000
