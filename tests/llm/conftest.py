import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _doc string, _key int, fp string, size int"


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def row(i, text, lang="en", source="a.example/x"):
    return (i, text, lang, source, None if text is None else len(text), "mine", 7, "print", 3)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with every awkward case: nulls in each column, empty, blank and long
    texts, repeated rows, an id with two texts, shared passages, clashing columns."""
    rng = random.Random(5)
    passage = words(rng, 60)
    lines = [" ".join(words(rng, 9)) for _ in range(5)]
    rows = [
        row(1, "\n".join([*lines, "own line one"])),
        row(2, "\n".join(["another start", *lines])),
        row(3, " ".join(words(rng, 40) + passage + words(rng, 30))),
        row(4, " ".join(passage + words(rng, 80))),
        row(5, " ".join(words(rng, 3000, 5000)), source="b.example"),
        row(6, "short"),
        row(7, "short"),
        row(8, ""),
        row(9, " \n\t \n \n"),
        row(10, None),
        row(11, "Ünïcode wörds über Straße   naïve", lang=None),
        row(12, "no source here", source=None),
        row(13, "twice the same row"),
        row(13, "twice the same row"),
        row(14, "one id, first text"),
        row(14, "one id, second text"),
        row(None, "no id at all"),
        row(15, "same same " * 80, source="b.example"),
        row(16, "12 34 !!"),
        row(17, "\n".join([lines[0], lines[1], "x", lines[0], lines[1], "x", lines[0], lines[1], "x"])),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, 1, 0), (15, 0, 0), (16, 0, 0), (None, 1, 0), (99, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark, docs):
    texts = {r.doc_id: r.text for r in docs.where("doc_id IN (3, 4, 5)").collect()}
    four = texts[4].split()
    items = [
        (1, " ".join(four[5:25]).upper()),
        (2, " ".join(texts[5].split()[100:113])),
        (3, "Short!"),
        (4, None),
        (5, " ... "),
        (6, "absent words only here"),
        (None, "straße"),
        (7, " ".join(four[0:12])),
        (7, "same, same"),
    ]
    return spark.createDataFrame(items, "item_id long, text string")
