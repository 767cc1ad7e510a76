"""Dedup and decontamination operators against brute force over awkward documents."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from flagstone.llm import decontam, linededup, simhash, substring
from flagstone.llm.common import merge_labels
from flagstone.llm.components import components


def table(df):
    return [r.asDict() for r in df.collect()]


def same_rows(got, want):
    return Counter(map(repr, got)) == Counter(map(repr, want))


# --- SimHash --------------------------------------------------------------


def plain_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius=3):
    """Smallest id reachable for (id, print) rows; a null id never names a class."""
    group = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if bin(a ^ b).count("1") <= radius and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    ids = {}
    for (i, _), g in zip(prints, group, strict=True):
        if i is not None:
            ids[g] = min(ids.get(g, i), i)
    return [ids.get(g) for g in group]


def test_simhash_classes(spark, docs, empty):
    rows = table(docs)
    prints = [(r["doc_id"], plain_print(r["text"])) for r in rows]
    want = [(i, p - (1 << 64) if p >> 63 else p, c) for (i, p), c in zip(prints, plain_classes(prints), strict=True)]
    got = simhash.simhash_classes(docs).select("doc_id", "fp", "component_id").collect()
    assert same_rows(map(tuple, got), want)
    assert simhash.simhash_classes(empty).count() == 0


def test_simhash_hash_is_sparks(spark):
    text = "one two three"
    want = spark.sql(f"SELECT xxhash64('{text}') AS h").first().h
    assert simhash.fingerprint(text.encode()) == want % (1 << 64)


def test_simhash_chunks_of_a_long_text(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.fingerprint(text) == whole == plain_print(text.decode())


@pytest.mark.parametrize("tree_size", [4, 4096])
def test_near_links_lose_nothing(spark, tree_size):
    """Chains, dense groups and strangers, also with shards cut into many trees."""
    rng = random.Random(tree_size)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for seed in list(prints)[:12]:
        x = seed
        for _ in range(12):
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << b
            prints.add(x)
    prints |= {1 << b for b in range(40)} | {0, (1 << 64) - 1}
    rows = [(i, p) for i, p in enumerate(sorted(prints))]
    df = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in rows], "rep long, fp long")
    found = {r.node: r.component for r in components(simhash.near_links(df, 3, tree_size=tree_size)).collect()}
    assert [found.get(i, i) for i, _ in rows] == plain_classes(rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=60, unique=True), st.integers(0, 12), st.randoms())
def test_forest_search_equals_scan(prints, radius, rng):
    p = np.array(prints, dtype=np.uint64)
    tree = np.sort(np.array([rng.randrange(4) for _ in prints]))
    forest = simhash.Forest(p, tree)
    roots = np.array([forest.root_of[t] for t in tree.tolist()])
    pairs = {(int(a), int(b)) for q, n in forest.search(p, roots, radius) for a, b in zip(q, n, strict=True)}
    want = {(i, j) for i in range(len(p)) for j in range(len(p)) if tree[i] == tree[j] and bin(prints[i] ^ prints[j]).count("1") <= radius}
    assert pairs == want


def test_drop_near_copies_keeps_one_of_each_group(spark, docs, empty):
    out = table(simhash.drop_near_copies(docs))
    assert simhash.drop_near_copies(docs).columns == docs.columns
    ids = Counter(r["doc_id"] for r in out)
    assert ids[13] == 1 and ids[14] == 1 and ids[None] == 1 and ids[6] + ids[7] == 1 and 7 not in ids
    assert ids[8] + ids[9] + ids[10] == 1
    assert simhash.drop_near_copies(empty).count() == 0


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (None, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 20)), max_size=40))
def test_merge_labels(pairs):
    a, b = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
    label = merge_labels(np.arange(21), a, b)
    want = list(range(21))
    for _ in range(21):
        for x, y in pairs:
            want = [min(want[x], want[y]) if w in (want[x], want[y]) else w for w in want]
    assert label.tolist() == want


# --- lines ------------------------------------------------------------------


def plain_lines(rows):
    """First places by (id, text hash, line); rows equal in id and text are one document."""
    first, out = {}, {}
    for r in rows:
        if r["text"] is None:
            continue
        lines = r["text"].split("\n")
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if any(x.strip(" \t\n\r\x0b\x0c") for x in w):
                at = (r["doc_id"] is not None, r["doc_id"] or 0, r["k"], p)
                first[w] = min(first.get(w, at), at)
    for r in rows:
        lines = [] if r["text"] is None else r["text"].split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if w in first and (r["doc_id"] is not None, r["doc_id"] or 0, r["k"], p) > first[w]:
                gone |= {p, p + 1, p + 2}
        text = None if r["text"] is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out[(r["doc_id"], r["text"])] = (text, len(lines), len(gone))
    return out


def test_line_dedup(spark, docs, empty):
    rows = table(docs.selectExpr("*", "hash(text) AS k"))
    want = plain_lines(rows)
    got = linededup.line_dedup(docs)
    assert got.columns == [*docs.columns, "_n_lines", "_n_removed"]
    found = table(got)
    assert Counter((r["doc_id"], r["text"], r["_n_lines"], r["_n_removed"]) for r in found) == Counter((r["doc_id"], *want[(r["doc_id"], r["text"])]) for r in rows)
    assert sum(r["_n_removed"] for r in found) >= 5 and all(r["_doc"] == "mine" and r["fp"] == "print" for r in found)
    assert linededup.line_dedup(empty).count() == 0
    stage = linededup.drop_repeated_lines(docs)
    assert stage.columns == docs.columns
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in table(stage))


# --- substrings ---------------------------------------------------------------


def plain_substrings(rows, window):
    count = Counter()
    for r in rows:
        w = (r["text"] or "").encode().split()
        count.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for r in rows:
        w = (r["text"] or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((r["doc_id"], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window, seed", [(35, 9), (6, 3), (4, 4)])
def test_substring_dedup(spark, docs, empty, window, seed):
    rows = table(docs)
    got = substring.substring_dedup(docs, window, seed)
    found = table(got)
    assert Counter((r["doc_id"], r["_n_words"], r["_n_removed"], r["_sha256"]) for r in found) == Counter(plain_substrings(rows, window))
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["_sha256"] for r in found)
    assert all(r["_doc"] == "mine" for r in found)
    if window == 35:
        assert substring.substring_dedup(empty).count() == 0


def test_substring_random_texts(spark):
    """Low-entropy texts: repeats inside a text, overlapping and nested passages."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = " ".join(rng.choice("ab" if i % 3 else "abcde") for _ in range(rng.randrange(0, 60)))
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for window, seed in ((7, 3), (12, 4)):
        found = table(substring.substring_dedup(df, window, seed))
        want = plain_substrings([{"doc_id": i, "text": t} for i, t in rows], window)
        assert Counter((r["doc_id"], r["_n_words"], r["_n_removed"], r["_sha256"]) for r in found) == Counter(want)


# --- decontamination ------------------------------------------------------------


def plain_contamination(rows, items, window=13):
    pattern = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    owner = {}
    for name, text in items:
        w = pattern.findall((text or "").encode().lower())
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owner.setdefault(tuple(w[i : i + window]), set()).add("null" if name is None else str(name))
    out = []
    for r in rows:
        w = pattern.findall((r["text"] or "").encode().lower())
        hit, names = set(), set()
        for x, o in owner.items():
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    names |= o
        out.append((r["doc_id"], len(w), len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination(spark, docs, benchmark, block_bytes):
    want = plain_contamination(table(docs), [(r.item_id, r.text) for r in benchmark.collect()])
    got = decontam.with_verdict(decontam.contamination(docs, benchmark, block_bytes=block_bytes))
    found = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"])), r["contaminated"]) for r in table(got)]
    assert Counter(found) == Counter(want)
    assert any(w[4] for w in want) and any(w[2] and not w[4] for w in want)


def test_contamination_without_rows(spark, docs, empty, benchmark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in table(decontam.with_verdict(decontam.contamination(docs, none)))} == {0}
    assert decontam.contamination(empty, benchmark).count() == 0


def test_decontaminate_keeps_clean_rows(spark, docs, benchmark):
    want = plain_contamination(table(docs), [(r.item_id, r.text) for r in benchmark.collect()])
    for block_bytes in (1 << 20, 60):
        out = decontam.decontaminate(docs, benchmark, block_bytes=block_bytes)
        assert out.columns == docs.columns and all(r["_doc"] == "mine" for r in table(out))
        assert Counter(r["doc_id"] for r in table(out)) == Counter(w[0] for w in want if not w[4])
