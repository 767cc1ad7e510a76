"""Whitening, packing and centroid clustering against brute-force versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from flagstone.llm import centroids, eigen, packing, queries, whitening

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# --- eigenvectors -----------------------------------------------------------------


def matrices():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    low = rng.standard_normal((6, 40))
    yield "general", np.cov(rng.standard_normal((300, 40)).T)
    yield "one value many times", q @ np.diag([5.0] * 15 + [1.0] * 25) @ q.T
    yield "graded", q @ np.diag(10.0 ** -np.arange(40)) @ q.T
    yield "low rank", low.T @ low
    yield "identity", np.eye(40)
    yield "falls into blocks", np.kron(np.eye(5), np.cov(rng.standard_normal((8, 100))))
    yield "tiny", 1e-200 * np.cov(rng.standard_normal((300, 40)).T)
    yield "one by one", np.array([[3.0]])
    yield "two by two", np.array([[2.0, 1.0], [1.0, 2.0]])


@pytest.mark.parametrize("name,a", list(matrices()))
def test_leading_eigenvectors(name, a):
    values, rows = eigen.leading(a, 20)
    scale, want = np.abs(a).max(), np.linalg.eigvalsh(a)[::-1][:20]
    assert np.abs(values - want).max() <= 1e-13 * scale
    assert np.abs(rows @ a - values[:, None] * rows).max() <= 1e-13 * scale
    above = values > 1e-13 * scale
    assert np.abs(rows[above] @ rows[above].T - np.eye(above.sum())).max() <= 1e-13


def test_sturm_counts():
    rng = np.random.default_rng(2)
    d, e = rng.standard_normal(12), rng.standard_normal(11)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-5, 5, 101)
    assert eigen.counts_below(d, e, at).tolist() == [int((values < x).sum()) for x in at]


# --- whitening --------------------------------------------------------------------


def plain_whitening(vectors, components):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = x * n - s
    y = dev.astype(np.float64) / n
    v = y.T @ y / n
    values, columns = np.linalg.eigh(v)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    return (dev * dev).sum(axis=1).tolist(), y @ columns, values, np.trace(v)


def check_whitening(got, vectors, components=32):
    """``got``: vec_id -> {component: row}, ``vectors``: vec_id -> list."""
    ids = sorted(vectors)
    dev, projected, values, trace = plain_whitening([vectors[i] for i in ids], components)
    assert sorted(got) == ids
    for c in range(min(components, len(vectors[ids[0]]))):
        column = [got[i][c + 1] for i in ids]
        assert [r["deviation"] for r in column] == dev and {r["n"] for r in column} == {len(ids)}
        assert column[0]["explained"] == pytest.approx(values[c] / trace, rel=1e-4)
        if values[c] < 1e-9 * trace:
            assert {r["whitened"] for r in column} == {None}
            continue
        w, want = np.array([r["whitened"] for r in column]), projected[:, c] / np.sqrt(values[c])
        assert min(np.abs(w - want).max(), np.abs(w + want).max()) < 1e-8
        assert 0 <= column[0]["identity_error"] <= 1e-4


def by_id(rows):
    out = defaultdict(dict)
    for r in rows:
        assert r["component"] not in out[r["vec_id"]]
        out[r["vec_id"]][r["component"]] = r.asDict()
    return out


def test_op11(spark):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    got = by_id(queries.op11_whitening(spark, SF).collect())
    check_whitening(got, {r["vec_id"]: r["embedding"] for r in rows})


VECTORS = "vec_id long, embedding array<float>, label int, vector string, whitened int, n string"


def test_whitening_cases(spark):
    rng = random.Random(3)
    good = {i: [rng.gauss(0, 1), rng.gauss(0, 2), rng.gauss(5, 0.5), 7.0] for i in range(300)}
    awkward = [None, [], [1.0, None, 1.0, 1.0], [1.0, float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0, 1.0], [1.0, 2.0], [3e38] * 4]
    rows = [(i, v, 1, "x", 2, "y") for i, v in good.items()] + [(1000 + i, v, None, None, 2, "y") for i, v in enumerate(awkward)]
    table = spark.createDataFrame(rows, VECTORS).repartition(5)
    found, made = whitening.whiten(table, components=32)
    got = by_id(whitening.by_component(found, made).collect())
    single = {i: [np.float32(c) for c in v] for i, v in good.items()}
    check_whitening(got, single)
    # the constant fourth dimension has no variance
    assert {r[4]["whitened"] for r in got.values()} == {None} and made.usable.tolist() == [True, True, True, False]
    # repeated rows and rows without id
    twice, _ = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0], 0, "", 0, ""), (None, [1.0, 2.0], 0, "", 0, ""), (1, [2.0, 1.0], 0, "", 0, "")], VECTORS))
    assert sorted(r["deviation"] for r in twice.collect()) == [2 * 64**2, 2 * 64**2, 8 * 64**2]
    # all alike, and no rows at all
    alike, made = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0, "", 0, "") for i in range(3)], VECTORS))
    assert [(r["deviation"], r["whitened"]) for r in alike.collect()] == [(0, [None, None])] * 3 and made.identity_error is None
    nothing, made = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert made is None and whitening.by_component(nothing, made).count() == 0


def test_whitening_large_entries(spark):
    """Sums and deviations beyond 64 bits stay exact, or are null."""
    vectors = {i: [float(2**45 * (1 if i % 2 else -1)), float(i % 7)] for i in range(40)}
    table = spark.createDataFrame([(i, v) for i, v in vectors.items()], "vec_id long, embedding array<double>").repartition(3)
    found, made = whitening.whiten(table)
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in vectors.items()}
    assert made.sums == [sum(v[j] for v in x.values()) for j in range(2)]
    exact = {i: sum((40 * a - s) ** 2 for a, s in zip(v, made.sums)) for i, v in x.items()}
    assert {r["vec_id"]: r["deviation"] for r in found.collect()} == {i: d if d < 2**63 else None for i, d in exact.items()}


# --- packing ----------------------------------------------------------------------


def check_pieces(pieces, docs, max_tokens=4096, end_id=2, most_padding=0.001):
    """``docs``: Counter of texts by id; every id in one piece, sequences gapless, little padding."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    want, got = Counter(), Counter()
    for (i, text), n in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], dtype="<u4")
        want[(i, ids.tobytes())] += n
    # pieces of rows that share an id are told apart by their sequence and start
    by_doc, spans = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_doc[p["doc_id"]].append(p)
        spans[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, parts in by_doc.items():
        starts = Counter(p["start"] for p in parts)
        if max(starts.values()) == 1:
            parts.sort(key=lambda p: p["start"])
            assert [p["start"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts]])[:-1].tolist()
            whole = b"".join(bytes(p["ids"]) for p in parts)
            assert {p["doc_tokens"] for p in parts} == {len(whole) // 4}
            got[(i, whole)] += 1
        else:  # rows alike that were cut differently: their pieces add up
            want = Counter({k: n for k, n in want.items() if k[0] != i})
            assert sum(p["length"] for p in parts) == sum(len(w) // 4 * n for (j, w), n in every(docs, tokenizer, end_id).items() if j == i)
    assert got == want
    padding = total = 0
    for parts in spans.values():
        parts.sort()
        ends = np.cumsum([0, *[n for _, n in parts]]).tolist()
        assert [at for at, _ in parts] == ends[:-1] and ends[-1] <= max_tokens
        total += ends[-1]
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else max_tokens - ends[-1]
    assert padding <= most_padding * total


def every(docs, tokenizer, end_id):
    return Counter({(i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id], dtype="<u4").tobytes()): n for (i, t), n in docs.items()})


def test_op12(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    pieces = queries.op12_packing(spark, SF).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = {d["doc_id"]: np.array([*tokenizer.encode(d["text"], add_special_tokens=False).ids, 2], dtype="<u4") for d in docs}
    for p in pieces:
        ids = texts[p["doc_id"]]
        assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) and p["doc_tokens"] == len(ids)
    with_ids = [{**p.asDict(), "ids": texts[p["doc_id"]][p["start"] : p["start"] + p["length"]].tobytes()} for p in pieces]
    check_pieces(with_ids, Counter((d["doc_id"], d["text"]) for d in docs))


def test_packing_cases(spark, docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    odd = ["Ｆｕｌｌ ÉÉ İstanbul Σίσυφος ΣΑΣ", "a b c\x1cd\x85e", "<|endoftext|> x <|startoftext|>y", "漢字" * 3000, "it's we'll 'S", " ́ ́a", "x" * 5000]
    rows += [(100 + i, t) for i, t in enumerate(odd)]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS ids", "1 AS part", "2 AS length").repartition(4)
    for max_tokens in (4096, 64):
        found = [r.asDict() for r in packing.pack(table, VOCABULARY, max_tokens=max_tokens, slack=0).collect()]
        check_pieces(found, Counter(rows), max_tokens)
    assert packing.pack(empty, VOCABULARY).count() == 0
    lone = packing.pack(spark.createDataFrame([(None, None)], "doc_id long, text string"), VOCABULARY).collect()
    assert [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset) for r in lone] == [(None, 0, 1, 1, 0)]


def test_packing_hot_length(spark):
    """One length holds most rows, in copies; no sequence is short of it."""
    rows = [(i, "one two three four five") for i in range(900)] + [(i, "word " * (i % 97)) for i in range(900, 1300)]
    found = [r.asDict() for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), VOCABULARY, max_tokens=128, slack=0).collect()]
    check_pieces(found, Counter(rows), 128)


@pytest.mark.parametrize(
    "histogram",
    [
        {},
        {1: 1},
        {3000: 1000},
        {4095: 10, 2: 3},
        {10: 20_000},
        {2500: 5000, 1700: 3000, 3: 11},
        dict(Counter(min(4095, int(random.Random(i).lognormvariate(6, 1)) + 1) for i in range(20_000))),
    ],
)
def test_plan_of_histogram(histogram):
    plan = packing.plan_packs(histogram, 4096)
    places, spans = packing.Places(plan), defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            cuts = places.find(length, rank)
            assert sum(c[2] for c in cuts) == length
            for sequence, offset, size in cuts:
                spans[sequence].append((offset, size))
    for parts in spans.values():
        parts.sort()
        ends = np.cumsum([0, *[n for _, n in parts]]).tolist()
        assert [at for at, _ in parts] == ends[:-1]
        assert ends[-1] >= 4096 - 4 and ends[-1] <= 4096 or ends[-1] & (ends[-1] - 1) == 0


# --- centroids --------------------------------------------------------------------


def plain_clusters(rows, k=16, rounds=3, dim=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(64 * float(c)) for c in v]))
    digest = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    cent = [list(v) for _, _, v in sorted((digest(i), v, v) for i, v in kept)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        cent = [[sum(x) // len(members[j]) for x in zip(*members[j], strict=True)] if j in members else c for j, c in enumerate(cent)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), name[j]) for i, d, j in found)


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def test_op13(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    assert Counter(tuple(r[c] for c in COLUMNS) for r in queries.op13_centroids(spark, SF).collect()) == plain_clusters(rows)


def test_centroid_cases(spark):
    rng = random.Random(9)
    good = [(i, [rng.gauss(0, 1), rng.gauss(0, 1), -1e-9]) for i in range(200)]
    same = [(i, [0.25, 0.25, 0.0]) for i in range(200, 300)] + [(200, [0.25, 0.25, 0.0]), (None, [1.0, 1.0, 1.0]), (None, [1.0, 2.0, 1.0])]
    bad = [(400, None), (401, []), (402, [1.0, 2.0]), (403, [1.0, None, 1.0]), (404, [float("nan")] * 3), (405, [1.0, float("-inf"), 0.0])]
    schema = "vec_id long, embedding array<double>, v int, cluster string, near double"
    for rows in (good + same + bad, same, good[:3], bad, []):
        table = spark.createDataFrame([(i, v, 1, "c", 0.5) for i, v in rows], schema).repartition(3)
        got = centroids.with_totals(centroids.cluster(table, k=5, dim=3))
        assert Counter(tuple(r[c] for c in COLUMNS) for r in got.collect()) == plain_clusters(rows, k=5, dim=3)
    large = spark.createDataFrame([(1, [1e30, 0.0, 0.0], 1, "", 0.0), (2, [1.0, 0.0, 0.0], 1, "", 0.0)], schema)
    assert [r.vec_id for r in centroids.cluster(large, k=5, dim=3).rows.collect()] == [2]


def test_packing_encodes_only_what_is_new():
    """Words of letters alone are not searched for cuts, known words not again; ids are those of whole texts."""
    encoder, cut = packing.Encoder(VOCABULARY, False, 2), []
    own = encoder._cut
    encoder._cut = lambda w: cut.append(w) or own(w)
    long_word = b"x" * (packing.KEPT_BYTES + 1)
    texts = [b"Plain words", b"plain x-y words " + long_word, None, b"", b"plain caf\xc3\xa9 x-y"]
    want = encoder._encode([t or b"" for t in texts])
    assert encoder.ids(texts) == want
    assert sorted(cut) == sorted([b"x-y", "café".encode()])
    cut.clear()
    assert encoder.ids(texts[::-1]) == want[::-1] and not cut


def test_packing_looks_up_a_word_once_a_step():
    """Words are looked up once among many texts, new words of letters share a line; ids are those of whole texts."""
    encoder, asked, lines = packing.Encoder(VOCABULARY, False, 2), [], []
    of_words, of_line = encoder._ids_of_words, encoder._encode_line
    encoder._ids_of_words = lambda words: asked.append(words) or of_words(words)
    encoder._encode_line = lambda words: lines.append(words) or of_line(words)
    odd = ["İstanbul ıI ŉ ÀB àb ǅ é́ ª²", "it's we'll, ok!! 4.0.", "漢字 Σίς −x", " \t\x0b\x0c\r\n", "\x1c\x85\xa0a", "-é- é-- --é"]
    texts = [t.encode() for t in odd] + [None, b"", b"a\xff! \xc3 b!\xc3"] + [b" one Two,  two three\n"] * 500
    want = encoder._encode([t or b"" for t in texts])
    import pyarrow as pa

    column = pa.array([b"left out", *texts], pa.binary()).view(pa.string()).slice(1)
    assert encoder.ids(column) == want and encoder.ids(texts) == want
    assert len(asked) == 2 and len(asked[0]) == len(set(asked[0])) < 60
    assert len(lines) == 1 and {"one", "two", "three"} <= set(lines[0])
    assert encoder._encode_line(["áb", "x,y"]) is None
    assert packing.Encoder(VOCABULARY, True, 2).ids(texts[:9]) == packing.Encoder(VOCABULARY, True, 2)._encode([t or b"" for t in texts[:9]])
