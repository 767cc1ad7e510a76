"""The registered queries over whole tables (sf0.001): against their SQL, a brute-force
version or held-out labels; and the pipeline, stage by stage."""

import hashlib
import html as html_lib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from test_models import plain_best, plain_links, plain_targets
from test_text_operators import plain_classes, plain_contamination, plain_lines, plain_print, plain_substrings

import __spark_entry__ as entry
import corpus_pipeline
from flagstone.llm import quality, queries

SF = "/root/testdata/sf0.001"


def rows_of(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def found(spark, name, *columns):
    return Counter(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SF).collect())


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert found(spark, name, *cols) == Counter(res.fetchall())


def test_op1(spark):
    docs = [(d["doc_id"], plain_print(d["text"])) for d in rows_of("documents")]
    want = Counter((i, f"{p:016x}", c) for (i, p), c in zip(docs, plain_classes(docs), strict=True))
    assert found(spark, "op1_simhash", "doc_id", "fingerprint", "component_id") == want


def test_op2(spark):
    docs = {d["doc_id"]: d for d in rows_of("documents")}
    got = queries.op2_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id]["lang"] for r in held) >= 0.95 * len(held)


def test_op5(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in rows_of("embeddings")]
    assert found(spark, "op5_embedding_dedup", "vec_id", "n_links", "component_id", "kept") == Counter(plain_links(rows))


def test_op6(spark):
    labels = {r["doc_id"]: r["quality"] for r in rows_of("labels")}
    got = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    assert len(got) == len(rows_of("documents"))
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(got[i].good for i in good) >= 0.99 * len(good) and sum(not got[i].good for i in bad) >= 0.9 * len(bad)


def test_op7(spark):
    assert found(spark, "op7_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(plain_substrings(rows_of("documents"), 35))


def test_op8(spark):
    want = Counter()
    for d in rows_of("documents"):
        best = sorted(((-s, n, at) for n, (s, at) in plain_best(d["text"]).items()))
        want[(d["doc_id"], best[0][1] if best else None, best[0][2] if best else None, len(best))] += 1
    assert found(spark, "op8_license_scan", "doc_id", "license", "line", "n_licenses") == want


def test_op9(spark):
    want = Counter()
    for p in rows_of("pages"):
        article = re.sub("</?b>", "", p["html"][p["html"].index("<article>") : p["html"].index("</article>")])
        blocks = [" ".join(html_lib.unescape(x.replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1|article)>", article)]
        text = "\n\n".join(x for x in blocks if x)
        want[(p["page_id"], p["url"], text, len(text))] += 1
    assert found(spark, "op9_html_extraction", "page_id", "url", "text", "n_chars") == want


def test_op10(spark):
    items = [(r["item_id"], r["text"]) for r in rows_of("benchmark")]
    want = Counter(
        (i, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bad)
        for i, n, hit, names, bad in plain_contamination(rows_of("documents"), items)
    )
    assert found(spark, "op10_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


# --- pipeline --------------------------------------------------------------------


def plain_quality(rows, labels):
    """Ids that pass: classifier odds moved by those of the path, all in plain Python."""
    votes = {}
    for r in labels:
        if r["doc_id"] is not None and r["quality"] in (0, 1):
            votes.setdefault(r["doc_id"], []).append(r["quality"])
    known = [(d["text"], sum(votes[d["doc_id"]]) / len(votes[d["doc_id"]]) >= 0.5) for d in rows if d["doc_id"] in votes]
    x = np.array([quality.features((t or "").encode()) for t, _ in known]).reshape(-1, quality.N_FEATURES)
    model = quality.Classifier(x, np.array([float(g) for _, g in known]))
    odds = model.log_odds(np.array([quality.features((d["text"] or "").encode()) for d in rows]))
    p = 1 / (1 + np.exp(-odds))
    path = [re.match(r"[^/]*/?[^/?#]*", d["source"] or "")[0] for d in rows]
    host = [x.split("/")[0] for x in path]

    def strength(groups, prior):
        n = sum(len(g) for g in groups.values())
        if not n or n <= len(groups):
            return 1.0
        inside = max(sum(((np.array(g) - np.mean(g)) ** 2).sum() for g in groups.values()) / (n - len(groups)), 1e-9)
        between = sum(len(g) * (np.mean(g) - prior(k)) ** 2 for k, g in groups.items()) - len(groups) * inside
        between /= max(n - sum(len(g) ** 2 for g in groups.values()) / n, 1.0)
        return min(max(inside / max(between, 1e-9), 1.0), 10_000.0)

    hosts, paths = {}, {}
    for h, q, v in zip(host, path, p, strict=True):
        hosts.setdefault(h, []).append(v)
        paths.setdefault((h, q), []).append(v)
    mean = (p.sum() + 0.5) / (len(p) + 1)
    k = strength(hosts, lambda h: mean)
    host_mean = {h: (sum(g) + k * mean) / (len(g) + k) for h, g in hosts.items()}
    k = strength(paths, lambda x: host_mean[x[0]])
    path_mean = {x: (sum(g) + k * host_mean[x[0]]) / (len(g) + k) for x, g in paths.items()}
    logit = lambda v: math.log(min(max(v, 1e-4), 1 - 1e-4) / (1 - min(max(v, 1e-4), 1 - 1e-4)))
    return [o + logit(path_mean[(h, q)]) - logit(mean) >= 0 for o, h, q in zip(odds, host, path, strict=True)]


def plain_mix(rows):
    """(id, epochs) of the documents a fair queue takes."""
    size = {id(d): len((d["text"] or "").encode().split()) for d in rows}
    names = sorted({d["source"] for d in rows if d["source"] is not None}) + [None]
    totals = {s: sum(size[id(d)] for d in rows if d["source"] == s) for s in {d["source"] for d in rows}}
    target = plain_targets(totals)
    copies = []
    for s in totals:
        queue = sorted((d for d in rows if d["source"] == s), key=lambda d: (hashlib.md5(f"mix{d['doc_id']}".encode()).hexdigest(), d["doc_id"]))
        for e in range(3):
            upto = e * totals[s]
            for d in queue:
                upto += size[id(d)]
                if size[id(d)] and target[s]:
                    copies.append((upto / target[s], names.index(s), size[id(d)], d["doc_id"]))
    spent, epochs = 0, Counter()
    for _, _, n, i in sorted(copies):
        spent += n
        if spent > sum(totals.values()):
            break
        epochs[i] += 1
    return epochs


def test_pipeline(spark, docs, labels, benchmark, tmp_path):
    """Every stage takes all rows of its predecessor and decides as brute force does."""
    unique = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text", "lang", "source", "n_chars")
    unique.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    current = spark.read.parquet(str(tmp_path / "documents.parquet"))
    outputs = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, current, str(tmp_path))
        out.write.parquet(str(tmp_path / f"stage{i}"))
        rows = [r.asDict() for r in current.selectExpr("*", "hash(text) AS k").collect()]
        current = spark.read.parquet(str(tmp_path / f"stage{i}"))
        got = [r.asDict() for r in current.collect()]
        outputs.append((rows, got))
        if i < 4:
            assert current.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda got: sorted(r["doc_id"] for r in got)

    rows, got = outputs[0]
    passes = plain_quality(rows, [r.asDict() for r in labels.collect()])
    assert ids(got) == sorted(d["doc_id"] for d, ok in zip(rows, passes, strict=True) if ok) and 0 < len(got) < len(rows)
    rows, got = outputs[1]
    want = plain_lines(rows)
    assert {r["doc_id"]: r["text"] for r in got} == {d["doc_id"]: want[(d["doc_id"], d["text"])][0] for d in rows}
    rows, got = outputs[2]
    prints = [(d["doc_id"], plain_print(d["text"])) for d in rows]
    assert ids(got) == sorted(i for (i, _), c in zip(prints, plain_classes(prints), strict=True) if i == c)
    rows, got = outputs[3]
    bad = plain_contamination(rows, [(r.item_id, r.text) for r in benchmark.collect()])
    assert ids(got) == sorted(w[0] for w in bad if not w[4]) and any(w[4] for w in bad)
    rows, got = outputs[4]
    assert {r["doc_id"]: r["epochs"] for r in got} == dict(plain_mix(rows))
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text, r.epochs) for r in whole) == Counter((r["doc_id"], r["text"], r["epochs"]) for r in got)
    assert os.path.isdir(str(tmp_path / "stage4"))
