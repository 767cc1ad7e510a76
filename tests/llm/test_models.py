"""Mixing, quality, language, licence, page and vector operators."""

import random
import re
import textwrap
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flagstone.llm import html, langid, license as licences, mixing, quality, vectors


def table(df):
    return [r.asDict() for r in df.collect()]


# --- mixing -----------------------------------------------------------------------


def plain_targets(sizes, cycle=(5, 2, 1), most=3):
    """Share by weight, cut at ``most`` times the size, reshare until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(full.values())
        unit = left / sum(weight[s] for s in open_) if open_ else 0
        above = [s for s in open_ if unit * weight[s] >= most * sizes[s]]
        if not above:
            return {s: full.get(s, unit * weight[s]) for s in names}
        full.update({s: most * sizes[s] for s in above})


def test_mix(spark, docs, empty):
    rows = table(docs)
    size = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    want, largest = plain_targets(sizes), max(size(r["text"]) for r in rows)
    got = table(mixing.mix(docs, slice_rows=3))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], size(r["text"])) for r in rows)
    taken = Counter()
    for r in got:
        assert r["taken"] == r["size"] * r["epochs"] and 0 <= r["epochs"] <= 3
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["taken"]
    assert sum(taken.values()) <= sum(sizes.values())
    assert all(abs(taken[s] - want[s]) <= 2 * largest for s in sizes)
    again = Counter((r["doc_id"], r["epochs"]) for r in table(mixing.mix(docs.repartition(5), slice_rows=1000)))
    assert again == Counter((r["doc_id"], r["epochs"]) for r in got)
    assert mixing.mix(empty).count() == 0


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("x" * rng.randrange(1, 40)), rng.choice(["a"] * 6 + ["b", "c", "d", None])) for i in range(3000)]
    rows = [(i, " ".join(t.replace(" ", "")), s) for i, t, s in rows]
    got = table(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), slice_rows=50))
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(plain_targets({s: sum(r["size"] for r in got if r["source"] == s) for s in target}))
    assert all(abs(taken[s] - target[s]) <= 41 for s in target)


def test_mix_in_many_ranges(spark, monkeypatch):
    """Sources, their order of filling and the range where the budget ends, cut into ranges of a few rows."""
    rows = [(i, "w " * (1 + i * 7 % 23), f"s{i * i % 40:02d}" if i % 11 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {(r["doc_id"], r["target"], r["epochs"]) for r in table(mixing.mix(df))}
    monkeypatch.setattr(mixing.before_all, "__defaults__", (7,))
    monkeypatch.setattr(mixing._cut, "__defaults__", (100, 5))
    assert {(r["doc_id"], r["target"], r["epochs"]) for r in table(mixing.mix(df))} == want


def test_mix_without_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["size"], r["taken"], r["target"]) for r in table(mixing.mix(df))} == {(0, 0, 0.0)}


def test_mixed_documents(spark, docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "epochs"] and all(r["epochs"] > 0 for r in table(out))
    assert out.count() <= docs.count()


# --- quality ------------------------------------------------------------------------


def test_quality_scores(spark, docs, empty, labels):
    got = table(quality.quality_scores(docs, labels))
    assert Counter(r["doc_id"] for r in got) == Counter(r.doc_id for r in docs.collect())
    assert all(0 <= r["probability"] <= 1 and r["good"] == (r["probability"] >= 0.5) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["good"] and by_id[5]["good"] and not by_id[16]["good"] and not by_id[15]["good"]
    assert quality.quality_scores(empty, labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in table(kept)) == Counter(r["doc_id"] for r in got if r["good"])


def test_quality_without_labels(spark, docs, labels):
    got = table(quality.quality_scores(docs, labels.where("false")))
    assert {r["document"] for r in got} == {0.5} and all(r["good"] for r in got)


def test_quality_held_out(spark):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["the", "house", "river", "walks", "slowly,", "and", "sees."], 60)) + f" n{i}" for i in range(200)]
    bad = ["$$$ win### " * int(rng.integers(5, 40)) for _ in range(200)]
    rows = [(i, t, f"h{i % 7}/p{i % 3}") for i, t in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400) if i % 2], "doc_id long, quality int")
    got = {r["doc_id"]: r["good"] for r in table(quality.quality_scores(df, labels))}
    assert sum(got[i] == (i < 200) for i in range(0, 400, 2)) >= 198


def test_sparse_sites_shrink_to_the_prior(spark):
    rows = [("big", "big/a", 0.9)] * 500 + [("big", "big/b", 0.1)] * 500 + [("bad", "bad/", 0.02)] * 500 + [("one", "one/", 0.02)]
    sites, mean = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {r.path: r.path_mean for r in sites.collect()}
    assert got["big/a"] > 0.85 and got["big/b"] < 0.15 and got["bad/"] < 0.06
    assert got["bad/"] < got["one/"] < mean


def test_sites_of_sources(spark):
    df = spark.createDataFrame([("https://a.b/x/y?z",), ("a.b/x",), ("src1",), ("",), (None,)], "s string")
    got = [tuple(r) for r in df.select(quality.host_of(df.s), quality.path_of(df.s)).collect()]
    assert got == [("a.b", "a.b/x"), ("a.b", "a.b/x"), ("src1", "src1"), ("", ""), ("", "")]


# --- language -------------------------------------------------------------------------

PARTS = {"aa": ["kato", "mira", "selu", "tano"], "bb": ["grüp", "zwörk", "schlim", "bropf"], "cc": ["équé", "loiseau", "naître", "vieux"]}


def prose(rng, lang, n):
    return " ".join(rng.choice(PARTS[lang]) + rng.choice(PARTS[lang]) for _ in range(n))


def test_language_mixture(spark, docs, empty):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, 30), lang) for i, lang in enumerate(list(PARTS) * 30)]
    model = langid.train(spark.createDataFrame([*rows, (900, None, "aa"), (901, "kato", None)], "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    texts = [
        (1, prose(rng, "aa", 40)),
        (2, prose(rng, "bb", 30) + "\n" + prose(rng, "cc", 10)),
        (3, prose(rng, "cc", 4).upper()),
        (4, None),
        (5, ""),
        (6, "123 !!\n"),
        (7, "İstanbul " + prose(rng, "bb", 6)),
        (1, prose(rng, "aa", 2000)),
    ]
    got = langid.identify(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert [r.lang_pred for r in got] == ["aa", "bb", "cc", "und", "und", "und", "bb", "aa"]
    assert got[0].langs == ["aa"] and got[0].score == 1.0
    assert got[1].langs == ["bb", "cc"] and got[1].shares == pytest.approx([0.75, 0.25], abs=0.06)
    assert got[3].score == 0.0 and got[3].langs == []
    everything = langid.identify(docs, model).collect()
    assert len(everything) == docs.count() and all(0 <= r.score <= 1 for r in everything)
    assert langid.identify(empty, model).count() == 0
    untrained = langid.train(empty)
    assert {r.lang_pred for r in langid.identify(docs, untrained).collect()} == {"und"}


def test_language_batches_agree():
    """A text alone and among others, borders included."""
    rng = random.Random(4)
    counts = {}
    for lang in PARTS:
        grams, _, _ = langid.word_trigrams([prose(rng, lang, 300)], 1 << 12)
        counts[lang] = np.bincount(grams, minlength=1 << 12)
    model = langid.Model(counts, 1 << 12)
    texts = [prose(rng, rng.choice(list(PARTS)), rng.randrange(1, 9)) for _ in range(20)] + ["", None, "x", "İİ y"]
    together, n = model.infer(texts)
    for i, t in enumerate(texts):
        alone, m = model.infer([t])
        assert n[i] == m[0] and np.allclose(alone[0], together[i])


# --- licences ---------------------------------------------------------------------------


def plain_best(text, threshold=0.8):
    best = {}
    for at, passage in licences.passages(text or ""):
        scores = [
            (-licences.dice(licences.bigrams(licences.normalise(passage)), licences.bigrams(licences.normalise(t))), name)
            for name, ts in sorted(licences.TEMPLATES.items())
            for t in ts
        ]
        score, name = min(scores)
        if -score >= threshold and -score > best.get(name, (0, 0))[0]:
            best[name] = (-score, at)
    return {n: (round(s, 9), at) for n, (s, at) in best.items()}


def test_license_scan(spark, docs):
    mit = licences.TEMPLATES["MIT"][2]
    words = mit.split()
    extra = [
        (100, "Prose first.\nReleased under the MIT License."),
        (101, "Copyright (c) 2020 Someone\n\n" + mit.replace("AS IS", "as is")),
        (102, "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12))),
        (103, "Some text.\n\n" + mit + " And a word more.\nlicensed under cc by-nc 4.0"),
        (104, " ".join(words[:60])),
        (105, "licensed under the terms of nothing"),
        (106, None),
        (107, ""),
        (108, "Licensed under the Apache License, Version 2.0. " * 400),
    ]
    df = spark.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    got = table(licences.license_scan(df))
    texts = table(df)
    want = Counter(repr((r["doc_id"], sorted(plain_best(r["text"]).items()))) for r in texts)
    found = Counter(repr((r["doc_id"], sorted((n, (round(s, 9), a)) for n, s, a in zip(r["licenses"], r["scores"], r["lines"], strict=True)))) for r in got)
    assert found == want
    by_id = {r["doc_id"]: r["licenses"] for r in got if r["doc_id"] and r["doc_id"] >= 100}
    assert by_id[100] == by_id[101] == by_id[102] == ["MIT"] and sorted(by_id[103]) == ["CC-BY-NC-4.0", "MIT"]
    assert by_id[104] == by_id[105] == by_id[106] == by_id[107] == by_id[108] == []


def test_own_templates(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b c x"), (3, "word")], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.scores) for r in licences.license_scan(df, {"T": ["a b c d"], "W": ["word"]}, 0.6).collect()}
    assert got == {1: (["T"], [1.0]), 2: (["T"], [2 / 3]), 3: (["W"], [1.0])}


def plain_runs(words, templates, threshold=0.8):
    """(start, end, licence, Dice): the best of all runs of words, then those before and after it."""
    found = []
    for i in range(len(words)):
        for j in range(i + 1, len(words) + 1):
            grams = licences.bigrams(words[i:j])
            for name, ts in templates.items():
                for t in ts:
                    other = licences.bigrams(licences.normalise(t))
                    if (score := licences.dice(grams, other)) >= threshold:
                        found.append((-score, -len(other), name, i, j))
    if not found:
        return []
    score, _, name, i, j = min(found)
    after = plain_runs(words[j:], templates, threshold)
    return [*plain_runs(words[:i], templates, threshold), (i, j, name, -score), *((a + j, b + j, n, s) for a, b, n, s in after)]


def test_runs_of_words_by_brute_force():
    rng = random.Random(8)
    templates = {"A": ["a b c d e f", "b a"], "B": ["a b c d x f", "c c c"], "C": ["w"], "D": ["e f a b a b c d"]}
    for threshold in (0.5, 0.66, 0.8, 1.0):
        index = licences.Templates(templates, threshold)
        for _ in range(60):
            words = [rng.choice("abcdefxyw") for _ in range(rng.randrange(8))]
            for _ in range(rng.randrange(4)):
                words += [w if rng.random() < 0.9 else "y" for w in rng.choice([t for ts in templates.values() for t in ts]).split()] + rng.choices("abcwyz", k=rng.randrange(3))
            got = [(a, b, index.names[t], s) for t, a, b, s in sorted(index.runs(words), key=lambda r: r[1])]
            assert got == plain_runs(words, templates, threshold)


MIT_PARTS = re.split(r" (?=The above copyright|THE SOFTWARE IS PROVIDED)", licences.TEMPLATES["MIT"][2])


def test_licences_inside_texts(spark):
    bsd = re.sub(r" (?=[123]\. |THIS SOFTWARE IS)", "\n\n  * ", licences.TEMPLATES["BSD-3-Clause"][2])
    code = "def f(x):\n    return x + 1\n\n" * 300
    rows = [
        (1, code + "\n\n".join(MIT_PARTS) + "\n\n" + code),
        (2, "words before\n\n" + bsd + "\n\n" + code),
        (3, "\n\n".join("\n".join("# " + x for x in textwrap.wrap(p, 60)) for p in MIT_PARTS) + "\n" + code),
        (4, "Code here is licensed under the MIT License."),
        (5, "One sentence first. Code here is licensed under the MIT License. And one after it."),
        (6, "First.\nLicensed under the Apache License, Version 2.0. " * 30),
        (7, "Licensed.under.CC.BY-SA.4.0"),
        (8, "Copyright (c) 2020\n\nNo\nlicensed under the terms of nothing, released under the sky"),
        (9, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.lines) for r in licences.license_scan(df, inside=True).collect()}
    assert got[1] == (["MIT"], [900]) and got[2] == (["BSD-3-Clause"], [2]) and got[3] == (["MIT"], [0])
    assert got[4] == got[5] == (["MIT"], [0]) and got[6] == (["Apache-2.0"], [1]) and got[7] == (["CC-BY-SA-4.0"], [0])
    assert got[8] == got[9] == ([], [])


def test_near_relatives_and_full_texts():
    index = licences.Templates(licences.all_templates(), 0.8)

    def names(text):
        return {n for n, _, _ in licences.found_in(text, index, True)}

    notice = licences.TEMPLATES["GPL-3.0"][2]
    assert names(notice) == {"GPL-3.0"} and names(notice.replace("version 3", "version 2")) == {"GPL-2.0"}
    assert names(notice.replace("version 3", "version 7")) == set()
    assert names(notice.replace("GNU General", "GNU Affero General")) == {"AGPL-3.0"}
    assert names(notice.replace("GNU General", "GNU Lesser General")) == {"LGPL-3.0"}
    assert names(notice.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1").replace("program", "library")) == {"LGPL-2.1"}
    cc = "See: this work is licensed under a Creative Commons {} License. Thanks."
    assert names(cc.format("Attribution 3.0 Unported")) == {"CC-BY-3.0"} and names(cc.format("Attribution-NoDerivatives 4.0 International")) == {"CC-BY-ND-4.0"}
    assert names(cc.format("Attribution 9.0 International")) == set() and names("Licensed under CC BY-NC 9.0.") == set()
    assert names("Licensed under the BSD 2-Clause License, licensed under the ISC License.") == {"BSD-2-Clause", "ISC"}
    assert names("Licensed under the sky, released into the public domain under the law.") == set()
    for name, text in licences.FULL_TEXTS.items():
        words = text.split()
        assert names("Our file.\n" + " ".join(words[5:1500] + ["edited"] + words[1500:]) + "\nEnd of it.") == {name}
    for name, ts in licences.TEMPLATES.items():
        for t in ts:
            assert names("Some words, then: " + t + "\nAnd more words.") == {name}, t


# --- pages -------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice"><p>We use cookies</p></div><!-- <p>hidden</p> -->
<article><header><h2>Title &amp; more</h2></header><p><b>First   para&shy;graph
goes on.<br>Same block.<p>Second &lt;block&gt;.</p><div class="ad">Buy!</div><ul><li>item one</li><li>item two</li></ul>
<script>if (a < b) document.write("<p>no</p>")</script><form><input><label>Mail</label></form><p>x</p>
<section class="comments"><p>First!</p></section></article><aside>Related</aside><footer>&copy; Site</footer></body></html>"""


def test_marked_article():
    want = ["Title & more", "First para\xadgraph goes on. Same block.", "Second <block>.", "item one", "item two", "x"]
    assert html.main_text(PAGE) == "\n\n".join(want)


def test_unmarked_page_by_line_blocks():
    long = "This paragraph has enough characters to count as a surge of text on its own, and then some."
    page = f"<body><div><a href=x>Home</a> <a href=y>News</a></div><p>tiny</p><br><div>{long}</div><p>Short end.</p><p>{long}</p><div><a>More</a></div></body>"
    got = html.main_text(page)
    assert got.split("\n\n")[-3:] == [long, "Short end.", long] and "Home" not in got and "More" not in got


@pytest.mark.parametrize("name", ["site no-sidebar", "has-sidebar", "page--with-sidebar", "left-sidebar", "modal", "header"])
@pytest.mark.parametrize("tag", ["main", "article"])
def test_article_inside_a_wrapper(name, tag):
    aside = "<div class='sidebar'><p>Aside</p></div><div id='site-footer'>Foot</div><div class='comment-list'><p>First!</p></div>"
    page = f"<body><div class='{name}'><div>Lead</div><{tag}><header class='entry-header'><h1>Head</h1></header><p>Short.</p>{aside}</{tag}></div></body>"
    assert html.main_text(page) == "Head\n\nShort."
    assert html.main_text(page.replace("<div class=", "<form class=", 1).replace("</div></body>", "</form></body>")) == "Head\n\nShort."


def test_chrome_by_real_attributes():
    page = "<article><p data-id='footer' data-role='banner' title=\"x class='ad'\">One.</p><p id='ad'>No</p><div class='related-posts'><article>Other</article></div><p CLASS=promo>No</p></article>"
    assert html.main_text(page) == "One."
    teaser = "<div class='sidebar'><article><p>Teaser</p></article></div>"
    assert html.main_text(teaser + "<article><p>One.</p></article>" + teaser) == "One."


def test_short_articles_without_a_mark():
    menu = "<div><a href=x>Home</a> <a href=y>News</a></div>"
    assert html.main_text(f"<body>{menu}<div><h1>Title</h1><p>Short text.</p></div>{menu}</body>") == "Title\n\nShort text."
    long = "This paragraph has enough characters to count as a surge of text on its own, and then some. " * 4
    lead = "<h1>Title</h1><p>By me</p><p>Today</p><p>Summary</p>"
    page = f"<body>{menu}<div>{lead}<p>{long}</p><p>{long}</p>{menu * 4}<p>It ends here.</p></div>{menu}</body>"
    assert html.main_text(page).split("\n\n") == ["Title", "By me", "Today", "Summary", long.strip(), long.strip(), "It ends here."]


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text"), (4, "u", "<article>open"), (5, "u", "<nav>only"), (6, "u", "<article></article>"), (7, "u", "a < b & c &amp d"), (8, "u", "<article>" + "<p>y</p>" * 20000), (1, "u", PAGE), (None, "u", PAGE)]
    got = table(html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")))
    assert [r["page_id"] for r in got] == [r[0] for r in rows]
    texts = [r["text"] for r in got]
    assert texts[:2] == ["", ""] and texts[3] == "open" and texts[4] == "" and texts[5] == "" and texts[7] == "\n\n".join(["y"] * 20000)
    assert texts[8] == texts[9] == html.main_text(PAGE)
    assert html.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- vectors --------------------------------------------------------------------------------


def plain_links(rows, threshold=0.93):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not np.any(np.array(v, dtype=float)):
            return None
        v = np.array(v, dtype=np.float32).astype(float)
        return v / np.linalg.norm(v)

    units, n, group = [unit(r[1]) for r in rows], [0] * len(rows), list(range(len(rows)))
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                n[i] += 1
                x, y = group[i], group[j]
                group = [min(x, y) if g in (x, y) else g for g in group]
    ids = {}
    for r, g in zip(rows, group, strict=True):
        ids[g] = min(ids.get(g, r[0]), r[0])
    return [(r[0], k, ids[g], r[0] == ids[g]) for r, k, g in zip(rows, n, group, strict=True)]


def vector_rows(rng, n, dim=16):
    x = rng.normal(size=(n, dim))
    rows = [(i, x[i].tolist(), int(i % 2)) for i in range(n)]
    k = n
    for i in range(0, n, 5):  # copies near and equal, in and out of the threshold
        for noise in (0.0, 0.02, 0.08, 0.11):
            rows.append((k, (x[i] + rng.normal(size=dim) * noise * np.linalg.norm(x[i])).tolist(), int(i % 2)))
            k += 1
    return rows


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = vector_rows(rng, 150)
    k = len(rows)
    dense = rng.normal(size=16)
    rows += [(k + i, (dense + rng.normal(size=16) * 0.05).tolist(), 1) for i in range(120)]
    k = len(rows)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(k + i, v, 0) for i, v in enumerate(odd)] + [(k + 20, rows[0][1], None), (k + 21, rows[0][1], None), (k + 22, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS pid", "2 AS cell").repartition(4)
    want = Counter(plain_links(rows))
    # small shards: splits, dense groups in pieces and pairs of pieces are all used
    for shard in (32, 1024):
        monkeypatch.setattr(vectors, "SHARD", shard)
        got = Counter(tuple(r) for r in vectors.near_vectors(df).collect())
        missing = sum(w[1] for w in want) - sum(g[1] for g in got.elements() if True) if shard == 32 else 0
        if shard == 1024:
            assert got == want
        else:
            exact = sum(w[1] * c for w, c in want.items())
            found = sum(g[1] * c for g, c in got.items())
            assert 0.9 * exact <= found <= exact and missing is not None
    assert vectors.near_vectors(df.where("false")).count() == 0


def test_repeated_vector_rows(spark):
    rows = [(1, [1.0, 0.0], 0)] * 3 + [(2, [1.0, 0.1], 0), (3, [0.0, 1.0], 0)]
    got = Counter(tuple(r) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect())
    assert got == Counter({(1, 3, 1, True): 3, (2, 3, 1, False): 1, (3, 0, 3, True): 1})


def test_graph_is_connected_and_bounded():
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(size=(200, 12)), rng.normal(size=(60, 12)) * 0.01 + 5]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = vectors.build_graph(x, 3)
    reach, new = {vectors.medoid(x)}, [vectors.medoid(x)]
    near = {}
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        near.setdefault(i, []).append(j)
    while new:
        new = [j for i in new for j in near[i] if j not in reach and not reach.add(j)]
    assert len(reach) == len(x) and all(i != j for i, j in zip(a, b, strict=True))


def test_pairs_of_several_shards_are_counted(monkeypatch):
    """A pair that the search of its first shard misses counts there if another shard can find it."""
    monkeypatch.setattr(vectors, "range_search", lambda x, near, queries, *_: np.full((len(queries), len(x)), -np.inf))
    cells = [[1, 2], [1, 2], [1]]
    for cell, want in ((1, [1, 1, 0]), (2, [0, 0, 0])):
        rows = [(cell, 0, 0, i, 0, [1.0, 0.01 * i], 1, cells[i], []) for i in range(3) if cell in cells[i]]
        part = pa.RecordBatch.from_pylist([dict(zip(("cell", "low", "high", "pid", "piece", "vec", "times", "cells", "near"), r, strict=True)) for r in rows], BLOCK_SCHEMA)
        (out,) = vectors._search(0.93)([part])
        assert out.column("links").to_pylist() == want[: len(rows)]


BLOCK_SCHEMA = pa.schema([(n, pa.int64()) for n in ("cell", "low", "high", "pid", "piece")] + [("vec", pa.list_(pa.float64())), ("times", pa.int64()), ("cells", pa.list_(pa.int64())), ("near", pa.list_(pa.int64()))])


def test_audit_below_the_bound_ends_in_exact_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), 1) for i, v in enumerate((rng.normal(size=(6, 8)).repeat(20, axis=0) + 0.05 * rng.normal(size=(120, 8))).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    calls, real = [], vectors._found

    def losing(points, overlap, threshold, exact=False):
        calls.append(exact)
        found = real(points, overlap, threshold, exact)
        return found if exact else found.withColumn("links", found.links * 0).withColumn("centre", found.pid)

    monkeypatch.setattr(vectors, "_found", losing)
    got = Counter(tuple(r) for r in vectors.near_vectors(df, overlap=128).collect())
    assert calls == [False, True] and got == Counter(plain_links(rows))
