"""Stratified search, page extraction and whitening against brute force; odd rows."""
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import pages, strata, whitening
from tarmac.llm.base import Scratch

CLASHING = ("id", "n", "m", "terms", "shard", "cells", "q", "score", "rank", "x", "d", "item", "text_", "html_", "v")


def clash(df, but=()):
    for c in CLASHING:
        if c not in df.columns and c not in but:
            df = df.withColumn(c, F.lit("clash"))
    return df


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    words = [(i, terms_of(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total = len(words), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, w in words:
            m = 75 + (25 * len(w) * n_docs) // total
            s = 0
            for t in terms_of(text):
                tf = w.count(t) if t in df else 0
                if tf:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shards,query_bytes,cell_bytes", [(1, 1 << 20, 1 << 20), (5, 300, 2000)])
def test_search_is_brute_force(spark, monkeypatch, shards, query_bytes, cell_bytes):
    monkeypatch.setattr(strata, "CELL_BYTES", cell_bytes)
    rng = random.Random(4)
    vocab = [f"W{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 7, 7, 7, 40, 300])))) for i in range(500)]
    docs += [(7, "tie W1 tie"), (501, "tie w1 tie"), (502, "tie w1 tie"), (None, "tie w1 tie"), (503, None), (504, ""), (505, " .,-\x00"),
             (506, "naïve Ünïcode 漢字 w1_w2"), (507, "w1 " * 30_000), (508, "only here" + "x" * 50_000)]
    items = [(i, docs[i][1]) for i in range(0, 500, 25)] + [(900, "tie W1"), (900, "tie W1"), (None, "w1 unheard W2 w2"), (901, None),
                                                             (902, "NAÏVE Naïve 漢字"), (903, "..."), (904, "w1 " * 2000)]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string")).repartition(3)
    it = clash(spark.createDataFrame(items, "item_id long, text string"))
    scratch = Scratch(spark, "t")
    got = strata.search(strata.build(df, scratch, shards=shards), it, scratch, 20, query_bytes=query_bytes)
    assert got.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_search(docs, items, 20)


def test_search_of_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "quick fox")], "item_id long, text string")
    assert strata.ranked(no_docs, items).collect() == []
    assert strata.ranked(odd_docs, items.limit(0)).collect() == []
    assert strata.ranked(odd_docs.where("text is null"), items).collect() == []
    assert {r.doc_id for r in strata.ranked(odd_docs, items).collect()} == {5, 6, 7, 8}


def test_strata_below_the_threshold_stay_closed():
    """One long stratum of weak documents is never opened, and no result is lost by it."""
    def stratum(m, tfs):
        tf, n = np.unique(-np.array(tfs), return_counts=True)
        return strata.Stratum({"m": m, "ids": (np.arange(len(tfs), dtype=np.int64) + 1000 * m).tobytes(), "known": np.ones(len(tfs), np.uint8).tobytes(),
                               "terms": np.array([9], np.uint64).tobytes(), "first_run": np.array([0, len(tf)], np.int32).tobytes(),
                               "run_tf": (-tf).astype(np.uint32).tobytes(), "run_start": np.append(0, np.cumsum(n)).astype(np.int64).tobytes(),
                               "docs": np.argsort(-np.array(tfs), kind="stable").astype(np.int32).tobytes()})
    shard = strata.Shard([stratum(5000, [1] * 50), stratum(80, [3, 9, 5]), stratum(100, [8, 1])])
    score, ids, _ = shard.search(np.array([9], np.uint64), np.array([7]), 3)
    assert list(ids) == [80_001, 100_000, 80_002] and shard.opened == 2 and shard.seen == 3
    assert list(score) == [7 * strata.impact(9, 80), 7 * strata.impact(8, 100), 7 * strata.impact(5, 80)]


S = "The council voted on Tuesday to approve the new budget after a long debate about schools and roads."
MORE = "Many people had waited outside the hall for hours, and some of them cheered when the result was read out."
PAGES = {
    "article with everything around": (
        f"""<html><head><title>T</title><style>p{{}}</style><script>var x = "<p>no</p>";</script></head><body class="article main">
        <header><h1>The Paper</h1><nav><ul><li><a href="/">Home</a><li><a href="/n">News</a></ul></nav></header>
        <div class="cookie-notice"><p>{MORE}</p><button>OK</button></div><form action="/s"><label>Search all of it</label></form>
        <main><article><header class="entry-header"><h1>Budget &amp; roads</h1></header><p>{S}<br>{MORE}</p><p>Yes.</p>
        <div class="ad-slot"><p>{MORE}</p></div><ul><li>one<li>two <b>bold</b>er</ul><p>{S} <a href="x">A link</a>.</p>
        <section class="reader-comments"><article class="comment"><p>{S}</p></article></section></article></main>
        <aside><p>{S}</p></aside><div id="sidebar"><p>{MORE}</p></div><!-- <p>gone</p> --><footer>&copy; 2020 The Paper</footer></body></html>""",
        ["Budget & roads", f"{S} {MORE}", "Yes.", "one", "two bolder", f"{S} A link."]),
    "unclosed tags and no end": (f"<body><nav><a href=/>x</a></nav><div class=ad>{S}</div><article><h1>T<h2>U</h2><p><b>{S}<br><p>{MORE}<p>z",
                                 ["T", "U", S, MORE, "z"]),
    "layout by tables": (f"<table><tr><td><a href=1>Home</a> <a href=2>About</a> | <a href=3>Contact</a></td></tr><tr><td>{S}<br><br>{MORE}"
                         "<td><a href=x>foo bar</a></table><center>Copyright me</center>", [S, MORE]),
    "comments by their heading": (f"<h1>A title</h1><p>{S}</p><p>{MORE}</p><h3>3 Comments</h3><p>{S}</p><p>{MORE}</p>", ["A title", S, MORE]),
    "whole page is a form": (f"<form id=aspnetForm><article><h2>Head</h2><p>{S}</p></article><div class=login>Log in here</div></form>", ["Head", S]),
    "article too short for its length to tell": ("<nav><a href=x>a</a></nav><div class=ad>Buy this now.</div><article><h1>No.</h1><p>No.</p></article><footer>c</footer>",
                                                 ["No.", "No."]),
    "names written together": (
        f"""<body class="page has-sidebar"><div class="siteHeader"><p>{MORE}</p></div><div id="cookieBar">{S}</div><div class="content-with-sidebar">
        <div itemprop="articleBody"><p class="text-center">{S}</p><p>{MORE}</p><div class="adslot-top">{MORE}</div><p class="commentary">{S}</p></div>
        <ol class="commentlist"><li><p>{S}</p><li><p>{MORE}</p></ol><div class="page-footer">{S}</div></div>
        <section aria-label="Comments"><p>{MORE}</p></section><div class="sidebarRight"><p>{S}</p></div></body>""", [S, MORE, S]),
    "hidden parts": (f"<article><p>{S}</p><p hidden>{MORE}</p><div style='display: none'>{MORE}</div><p aria-hidden=true>{S}</p><p>{MORE}</p></article>", [S, MORE]),
    "references and spaces": ("<article><p>caf&eacute;&nbsp;&#8212;\n\t x &lt; y &amp;amp; z&#x41;</p><pre>a  b\n c</pre><p>1 < 2 <3</p></article>",
                              ["café — x < y &amp; zA", "a b c", "1 < 2 <3"]),
    "open script": (f"<article><p>{S}</p><script>var a = '<p>x</p>'", [S]),
    "nothing": ("", []), "white space": (" \n ", []), "only markup": ("<div><p></p></div>", []), "only a menu": ("<nav><a href=x>a b c</a></nav>", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, blocks = PAGES[name]
    assert pages.main_text(html, pages.grow()).split("\n") == (blocks or [""])


def test_extract_rows(spark):
    rows = [(i, f"u{i}", html) for i, (html, _) in enumerate(PAGES.values())] + [(0, "u0", PAGES["open script"][0]), (None, None, None)]
    df = clash(spark.createDataFrame(rows, "page_id long, url string, html string"), but=("text",)).withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = pages.extract(df)
    assert got.schema.simpleString() == "struct<page_id:bigint,url:string,text:string,n_chars:bigint>"
    want = [(i, f"u{i}", "\n".join(b), len("\n".join(b))) for i, (_, b) in enumerate(PAGES.values())] + [(0, "u0", S, len(S)), (None, None, "", 0)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert pages.extract(df.limit(0)).collect() == []


def test_very_long_and_hostile_pages_take_linear_time():
    import time
    tree = pages.grow()
    words = " ".join(f"w{i}" for i in range(500_000)) + "."
    assert pages.main_text(f"<article><p>{words}</p></article>", tree) == words
    began = time.time()
    for html in ("<a " * 200_000, "<p>x" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<svg>" * 20_000, '="<a ' * 100_000 + ">", "<a ='" * 100_000, "<!--" * 100_000):
        pages.main_text(html, tree)
    assert time.time() - began < 20


def test_tree_is_grown_from_the_table():
    x, y = pages.labelled()
    assert 100 < len(y) < 200 and (pages.grow().predict(x) == y).mean() > 0.97
    assert x.shape[1] == len(pages.FEATURES)
    # a plain check of the tree's first cut: no other cut of the table is purer
    best = min((sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[x[:, f] <= t], y[x[:, f] > t])))
               for f in range(x.shape[1]) for t in np.unique(x[:, f])[:-1]
               if pages.LEAF <= (x[:, f] <= t).sum() <= len(y) - pages.LEAF)
    tree = pages.grow()
    low = x[:, tree.feature[0]] <= tree.threshold[0]
    assert sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low])) == pytest.approx(best)


def test_given_pages_keep_their_articles(spark):
    """The test tables mark articles by their tag: their blocks are exactly the result."""
    from html import unescape

    from tarmac.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in QUERIES["op12_block_extraction"](spark, sf).collect()}
    assert set(got) == set(html)
    for i, h in html.items():
        parts = re.split(r"</?(?:p|h1|li)>", re.search(r"<article>(.*?)</article>", h, re.S)[1])
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        assert got[i] == "\n".join(b for b in blocks if b)


def whitened(spark, vectors, ids=None):
    rows = [(ids[i] if ids else i, v if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(3)
    return whitening.whiten(df).collect()


def check_whitening(rows, e, components):
    x = np.floor(1024 * np.array(e)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    y = (x * n - s) / n
    sigma, vt = np.linalg.svd(y, full_matrices=False)[1:]
    values = sigma ** 2 / n
    assert {r.component for r in rows} == set(range(1, components + 1)) and len(rows) == n * components
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-8
    for c in range(components):
        got = {r.vec_id: r for r in rows if r.component == c + 1}
        z = y @ vt[c] / math.sqrt(values[c])
        w = np.array([got[i].whitened for i in range(n)])
        assert min(abs(w - z).max(), abs(w + z).max()) < 1e-6
        assert got[0].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
    for i in range(n):
        exact = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        mine = {r.deviation for r in rows if r.vec_id == i}
        assert mine == {exact if exact < 1 << 63 else None}


RNG = np.random.default_rng(5)
BASE = RNG.normal(size=(200, 12)) * np.linspace(3, 1, 12)


def large(e, scale):
    e = e.copy()
    e[:, 0] *= scale
    return e


def dependent(e):
    e = e.copy()
    e[:, 3], e[:, 4] = 0.5, e[:, 5]
    return e


@pytest.mark.parametrize("name,e,components", [
    ("plain", BASE, 8), ("constant and repeated dimension", dependent(BASE), 8), ("fewer rows than dimensions", BASE[:5], 4),
    ("two dimensions", BASE[:, :2], 2), ("one large dimension", large(BASE, 1e6), 8), ("rank 3", (RNG.integers(-99, 99, (60, 3)) @ RNG.integers(-8, 9, (3, 12))) / 1024, 3),
    ("repeated rows", np.concatenate([BASE[:20], BASE[:20]]), 8), ("tiny entries", np.concatenate([BASE, np.full((1, 12), -1e-200)]), 8)])
def test_whitening_is_the_svd(spark, name, e, components):
    check_whitening(whitened(spark, e), e, components)


def test_whitening_drops_bad_vectors_and_keeps_lengths_apart(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [None] * 12, [1.0] * 11 + [nan], [1.0] * 11 + [-inf], []]
    short = [[1, 2], [2, 1], [5, 9]]
    rows = whitened(spark, [*BASE[:50], *odd, *short], [*range(50), 90, 91, 92, 93, 94, 70, 71, None])
    assert {r.vec_id for r in rows} == {*range(50), 70, 71, None}
    check_whitening([r for r in rows if r.n == 50], BASE[:50], 8)
    assert {(r.vec_id, r.component) for r in rows if r.n == 3} == {(i, c) for i in (70, 71, None) for c in (1, 2)}
    for none in ([], [BASE[0]], [BASE[0]] * 4, [[]], [None]):
        assert whitened(spark, none) == []


def test_shifted_cholesky_needs_its_passes(spark):
    """Columns so close that one Gram matrix loses them: the passes repair it."""
    e = BASE.copy()
    e[:, 1] = np.floor(e[:, 0] * 1024) / 1024 * 900 + RNG.integers(0, 2, 200) / 1024
    e[:, 2] = np.floor(e[:, 0] * 1024) / 1024 * 900
    x = np.floor(1024 * e).astype(np.int64) + 100_000
    df = spark.createDataFrame([(v.tobytes(),) for v in x], "x binary")
    w = whitening.fit(df, whitening.Centre(200, [int(c) for c in x.sum(0)]))
    assert w.passes >= 3
    check_whitening(whitened(spark, e), e, 8)
