"""Mixing, language model, toxicity and the pipeline."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import lm, mixing, toxicity
from tarmac.llm.base import Scratch

SMALL = "/root/testdata/sf0.001"


def sources(spark, sizes, words=10):
    rows = [(i, "w " * words, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_exponent_meets_entropy_and_repetition(spark):
    per = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "p double")
    a = mixing.exponent(per, 1.0, None)
    q = np.array([0.7, 0.2, 0.1]) ** a
    q /= q.sum()
    assert abs(-(q * np.log(q)).sum() - 1.0) < 1e-9
    a = mixing.exponent(per, None, 2.0)
    assert abs((0.7 / 0.1) ** (1 - a) - 2.0) < 1e-9
    assert mixing.exponent(per, None, 100.0) == 0.0
    assert abs(mixing.exponent(per, -1.0, None) - 1.0) < 1e-9  # out of reach: natural shares


def test_copies_realise_the_weights(spark):
    docs = sources(spark, {"big": 5000, "mid": 700, "small": 101})
    out = mixing.mix(docs, max_repeat=1.5)
    got = {r.source: r for r in out.groupBy("source").agg(F.sum("copies").alias("c"), F.min("copies").alias("a"), F.max("copies").alias("b")).collect()}
    assert got["big"].c == 5000 and got["small"].c in (151, 152) and (got["small"].a, got["small"].b) == (1, 2)
    a = 1 - math.log(1.5) / math.log(5000 / 101)
    assert abs(got["mid"].c - 5000 * (700 / 5000) ** a) <= 1
    half = {r.source: r.c for r in mixing.mix(docs, max_repeat=1.5, budget_tokens=10.0 * 2900).groupBy("source").agg(F.sum("copies").alias("c")).collect()}
    assert abs(sum(half.values()) - 2900) <= 3


def test_odd_rows_mix(spark, odd_docs, no_docs):
    out = mixing.draw(odd_docs, max_repeat=2.0)
    assert out.columns == odd_docs.columns
    drawn = Counter(r.doc_id for r in out.collect())
    assert set(drawn) == {r.doc_id for r in odd_docs.collect()} and drawn[6] >= 2
    assert mixing.draw(no_docs, max_repeat=2.0).collect() == [] and mixing.mix(no_docs).collect() == []


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def test_base_scores_and_gain(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    got = {r.doc_id: r for r in lm.score_texts(docs).collect()}
    tok = {r.doc_id: (r.text or "").encode().lower().split() + [b"\n"] for r in rows}
    c = Counter(w for i, ws in tok.items() if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tok.items():
        r = got[i]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(ws), sum(w in c for w in ws), n)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_frequent_words_in_many_partitions_change_little(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").repartition(4)
    plain = {r.doc_id: r for r in lm.score_texts(docs).collect()}
    monkeypatch.setattr(lm, "HOT_TOKENS", 300)
    monkeypatch.setattr(lm, "PART_BYTES", 60_000)
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    often = lm.Frequent(texts, 200, 80_000)
    assert len(often.words) > 10 and often.spread.max() > 3 and (np.diff(often.words.astype(object)) > 0).all()
    split = {r.doc_id: r for r in lm.score_texts(docs).collect()}
    for i, r in plain.items():
        s = split[i]
        assert (s.n_tokens, s.n_known, s.train_tokens, s.held_out) == (r.n_tokens, r.n_known, r.train_tokens, r.held_out)
        assert math.isclose(s.base_score, r.base_score, rel_tol=1e-9) and math.isclose(s.score, r.score, rel_tol=0.05)
    assert math.isclose(sum(r.score for r in split.values()), sum(r.score for r in plain.values()), rel_tol=0.005)


def test_many_short_texts_in_a_chunk(spark):
    """Two batches of 18,000 texts: text numbers of a chunk stay below the bit of held-out texts."""
    docs = spark.createDataFrame([(i, f"a{i % 7} b{i % 11}") for i in range(36_000)], "doc_id long, text string").coalesce(1)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "18000")
    try:
        got = lm.score_texts(docs).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    train = 3 * sum(not held(i) for i in range(36_000))
    assert len(got) == 36_000 and all((r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (3, 3, train, held(r.doc_id)) for r in got)
    assert all(r.score < 0 and r.base_score < 0 for r in got)
    with pytest.raises(ValueError, match="15 bits"):
        n = 32_769
        list(lm._chunk_rows(0, 1, None, [0] * n, [1] * n, [False] * n, [np.zeros(n, np.uint64)], [np.zeros(n, np.uint64)]))


def test_seating_is_the_restaurant_process():
    """Mean and spread of the numbers of tables against the exact distribution."""
    rng = np.random.default_rng(1)
    for c, new, disc in ((1, 0.3, 0.5), (2, 0.3, 0.5), (7, 2.0, 0.2), (40, 0.7, 0.8)):
        p = np.zeros(c + 2)
        p[1] = 1.0
        for i in range(1, c):
            open_ = np.array([new / (new + i - disc * t) for t in range(c + 2)])
            p = p * (1 - open_) + np.append(0, (p * open_)[:-1])
        t = np.arange(c + 2)
        got = lm.seat(np.full(40_000, c), np.full(40_000, new), disc, rng)
        assert got.min() >= 1 and got.max() <= c
        assert abs(got.mean() - p @ t) < 0.03 * max(1, p @ t) and abs(got.var() - (p @ t ** 2 - (p @ t) ** 2)) < 0.1 * max(1, got.var())
    big = lm.seat(np.array([10_000] * 50), np.array([5.0] * 50), 0.5, rng)
    assert (big >= 1).all() and (big <= 10_000).all()


class Bare:
    """Frequent words and numbered contexts of a hand-made partition."""
    words, spread = np.empty(0, np.uint64), np.empty(0, np.int64)

    def __init__(self, keys):
        self.known = np.sort(keys)
        self.known_end = (self.known & np.uint64(255)).astype(np.int64)

    hot_index = lm.Frequent.hot_index


def test_predictives_add_up_to_one():
    """Over all words, in every context, after every sweep: numbered contexts and others."""
    rng = np.random.default_rng(2)
    n_words, numbered, others = 50, 25, 15
    keys = (rng.integers(1, 1 << 40, numbered + others).astype(np.uint64) << np.uint64(8)) | rng.integers(0, 4, numbered + others).astype(np.uint64)
    often, rest = Bare(keys[:numbered]), np.sort(keys[numbered:])
    every = np.array([(w, x) for w in range(n_words) for x in [*range(numbered), *range(lm.KNOWN, lm.KNOWN + others)]])
    c = rng.integers(0, 9, len(every)) * (rng.random(len(every)) < 0.3)
    c[every[:, 0] < 5] = 0  # words that only held-out texts have
    row = {"part": 0, "words": lm._put(np.arange(n_words, dtype=np.uint64)), "entry_word": lm._put(every[:, 0].astype(np.uint32)),
           "entry_ctx": lm._put(every[:, 1].astype(np.uint32)), "counts": lm._put(c.astype(np.uint32)), "others": lm._put(rest)}
    d = lm.Dishes(row, often)
    types, n_ctx = int((d.c0 > 0).sum()), lm.KNOWN + others
    assert types < n_words
    disc, base, none = [0.5, 0.6, 0.7], 1 / (types + 1), np.zeros((0, 256), np.int64)
    c2 = np.bincount(d.ctx, d.c2, n_ctx)

    def totals():
        t2 = np.bincount(d.ctx, d.t2, n_ctx).astype(float)
        ends = (np.bincount(d.end2, d.t2, 256), np.bincount(d.end, d.t1, 256))
        return lm.Totals(c2[:lm.KNOWN], t2[:lm.KNOWN], ends[0], ends[1], d.t0.sum(), none, none, none.sum(1), disc, base), t2

    for k in range(4):
        tot, t2 = totals()
        if k:
            d.sweep(k, tot, t2)
            assert (d.t2 >= np.minimum(d.c2, 1)).all() and (d.t2 <= d.c2).all() and (d.t1 <= d.c1).all() and (d.t0 <= d.c0).all()
            tot, t2 = totals()
        p = d.predictive(tot, c2, t2)
        # a word without customers has the share of the one type beyond V; five of them share it
        for x in np.unique(every[:, 1]):
            mine = every[:, 1] == x
            assert abs(p[mine & (every[:, 0] >= 5)].sum() + p[mine & (every[:, 0] == 0)].sum() - 1) < 1e-9


def plain_model(texts, held, disc):
    """log10 probabilities of every text under the first seating, by dictionaries alone."""
    tok = [(t or "").encode().lower().split() for t in texts]
    end = lambda w: bytes(w[-2:]) if w else None
    c2, c2_of = Counter(), Counter()
    for ws, h in zip(tok, held):
        if not h:
            for a, b in zip([None, *ws], [*ws, b"\n"]):
                c2[a, b] += 1
                c2_of[a] += 1
    t2_of = Counter(a for a, _ in c2)
    c1 = Counter((end(a), b) for a, b in c2)
    c1_of, t1_of = Counter(), Counter(e for e, _ in c1)
    for (e, _), n in c1.items():
        c1_of[e] += n
    c0 = Counter(b for _, b in c1)
    n0, t0 = sum(c0.values()), len(c0)
    s, out = lm.STRENGTH, []
    for ws in tok:
        total = 0.0
        for a, b in zip([None, *ws], [*ws, b"\n"]):
            e = end(a)
            p = (c0[b] - disc[0] * (c0[b] > 0) + (s[0] + disc[0] * t0) / (t0 + 1)) / (s[0] + n0)
            p = (c1[e, b] - disc[1] * (c1[e, b] > 0) + (s[1] + disc[1] * t1_of[e]) * p) / (s[1] + c1_of[e])
            p = (c2[a, b] - disc[2] * (c2[a, b] > 0) + (s[2] + disc[2] * t2_of[a]) * p) / (s[2] + c2_of[a])
            total += math.log10(p)
        out.append(total)
    level = [Counter(c.values()) for c in (c0, c1, c2)]
    return out, [min(0.95, max(0.05, n[1] / max(1, n[1] + 2 * n[2]))) for n in level]


@pytest.mark.parametrize("numbered,part_bytes,hot_tokens", [(lm.KNOWN, 1 << 24, 1_000_000), (4, 3_000, 200), (1, 1 << 24, 1_000_000)])
def test_scores_are_those_of_exact_contexts(spark, monkeypatch, numbered, part_bytes, hot_tokens):
    """The whole way, contexts with and without numbers, many partitions, frequent words apart:
    the scores of the first seating are those of a plain model with a restaurant per context."""
    monkeypatch.setattr(lm, "PART_BYTES", part_bytes)
    monkeypatch.setattr(lm, "HOT_TOKENS", hot_tokens)
    rng = random.Random(5)
    vocab = [f"w{int(rng.paretovariate(0.8))}{x}" for x in ("ab", "cd", "ef", "gh") for _ in range(60)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 5, 40, 200]))) for _ in range(150)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm.score_texts(df, burn_in=0, samples=0, numbered=numbered).collect()}
    held = [got[i].held_out for i in range(len(texts))]
    _, disc = plain_model(texts, held, [0.5] * 3)
    want, _ = plain_model(texts, held, disc)
    assert len(got) == len(texts) and 10 < sum(held) < 60
    for i, w in enumerate(want):
        assert math.isclose(got[i].score, w, rel_tol=1e-9), i


def test_sweeps_agree_whatever_the_way(spark, monkeypatch):
    """Contexts without numbers take another way and other random draws: the sampled scores
    stay close."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    a = {r.doc_id: r for r in lm.score_texts(docs).collect()}
    monkeypatch.setattr(lm, "PART_BYTES", 100_000)
    b = {r.doc_id: r for r in lm.score_texts(docs, numbered=50).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[i].score, b[i].score, rel_tol=0.05, abs_tol=0.6) for i in a)
    held = [i for i in a if a[i].held_out]
    assert math.isclose(sum(a[i].score for i in held), sum(b[i].score for i in held), rel_tol=0.005)
    again = {r.doc_id: r.score for r in lm.score_texts(docs, numbered=50).collect()}
    assert again == {i: r.score for i, r in b.items()}  # seeded


def test_odd_rows_score(spark, odd_docs, no_docs):
    got = lm.score_texts(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert lm.score_texts(no_docs).collect() == []
    nothing = lm.score_texts(odd_docs, held_out="true").collect()
    assert all(abs(r.score) < 1e-6 and abs(r.base_score) < 1e-6 for r in nothing)


@pytest.fixture(scope="module")
def tainted(spark):
    rng = random.Random(8)
    bad = ["grobix", "snarfel", "vilezu", "hatlok", "cursim"]
    rows, lab = [], []
    for i in range(1500):
        words = [f"c{int(rng.paretovariate(0.7)) % 3000}" for _ in range(rng.randrange(5, 200))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randrange(1, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "", "x", "."]))
        rows.append((i, " ".join(words), "en", "s", 1))
        if i % 3:
            lab.append((i, 1, int(toxic)))
        rows[-1] = (*rows[-1], int(toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, truth int")
    return docs, spark.createDataFrame(lab, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(tainted):
    docs, labels = tainted
    got = {r.doc_id: r for r in toxicity.toxicity(docs.drop("truth"), labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    truth = {r.doc_id: r.truth for r in docs.collect()}
    unseen = [i for i in got if got[i].held_out or i % 3 == 0]
    assert sum(got[i].predicted == truth[i] for i in unseen) / len(unseen) > 0.97


def test_held_out_labels_change_nothing(tainted):
    docs, labels = tainted
    flipped = labels.withColumn("toxic", F.when(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_only_copies_are_left_out_of_the_sample(spark):
    """Unrelated texts that share a long word all count, copies and near copies once per label."""
    rng = random.Random(3)
    rows = [(i, " ".join(["thintion", *(f"u{rng.randrange(10**6)}" for _ in range(60))]), i % 2) for i in range(40)]
    near = rows[0][1]
    rows += [(100, near, 0), (101, near + " more", 0), (102, near, 1), (103, "", 0), (104, None, 0), (104, " ", 0)]
    df = spark.createDataFrame(rows, "doc long, text string, toxic int").select("doc", F.col("text").cast("binary").alias("text"), "toxic")
    got = Counter((bytes(r.text or b"").decode(), r.toxic) for r in toxicity.without_copies(df, Scratch(spark, "test-copies")).collect())
    want = Counter((t, y) for _, t, y in rows[:40]) + Counter([(near, 1), ("", 0)])
    assert got == want
    # a word of every toxic text is learned, though they share the long word of the smallest hash
    bad = [(i, t + (" grobix" if y else ""), y) for i, t, y in rows[:40]]
    df = spark.createDataFrame(bad, "doc long, text string, toxic int").select("doc", F.col("text").cast("binary").alias("text"), "toxic")
    assert b"wgrobix" in toxicity.learn_features(df, Scratch(spark, "test-copies"))


def test_odd_rows_toxicity(spark, odd_docs, no_docs, tainted):
    _, labels = tainted
    got = toxicity.toxicity(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(no_docs, labels).collect() == []
    assert all(r.score == 0 for r in toxicity.toxicity(odd_docs, labels.limit(0)).collect())


def test_pipeline(spark):
    import corpus_pipeline as cp
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    from tarmac.llm.near import near_duplicates
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    scratch, ids = Scratch(spark, "test-pipeline"), []
    for name, stage in cp.STAGES:
        before, docs = docs, scratch.put(stage(spark, docs, SMALL), name)
        if name != "packing":
            assert docs.schema == before.schema
            ids.append(Counter(r.doc_id for r in docs.select("doc_id").collect()))
    every = {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    assert set(ids[0]) == every - bad
    kept = {r.doc_id for r in near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet").where(F.col("doc_id").isin(sorted(ids[0])))).where("kept").collect()}
    assert set(ids[1]) == kept == set(ids[2]) and max(ids[2].values()) <= 2
    pieces = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r.doc_id: r.n for r in pieces} == {r.doc_id: r.t * ids[2][r.doc_id] for r in pieces} and {r.doc_id for r in pieces} == kept
    # where pieces are cut hangs on the rows' order; documents and tokens don't
    per = lambda df: Counter({r.doc_id: r.n for r in df.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()})
    assert per(cp.run(spark, SMALL)) == per(docs)


def test_pipeline_takes_an_empty_table(spark, no_docs):
    import corpus_pipeline as cp
    scratch, docs = Scratch(spark, "test-empty"), no_docs
    for name, stage in cp.STAGES:
        docs = scratch.put(stage(spark, docs, SMALL), name)
    assert docs.count() == 0


def test_pipeline_judges_rows_not_ids(spark):
    """Rows without an id are judged; rows that share an id stand for themselves alone."""
    import corpus_pipeline as cp
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    bad = toxicity.toxicity(given, labels).orderBy(F.desc("score"), "doc_id").limit(1).join(given, "doc_id").first()
    fine = "a quiet walk along the river with many old friends and a long talk about nothing much at all"
    other = "the museum opens at nine on most days and closes early when the weather turns bad in winter"
    a, b, c, d = (10 ** 6 + k for k in range(4))  # ids of the rows, none of which has a label
    rows = [(a, bad.text), (a, fine), (None, bad.text), (None, other), (b, fine + " indeed"), (b, "quite another story without any copies in this little table"),
            (c, None), (c, ""), (None, None), (d, other), (None, other)]
    extra = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], given.schema).withColumn("_row", F.lit("own")).withColumn("score", F.lit(1))
    docs = given.withColumn("_row", F.lit("own")).withColumn("score", F.lit(1)).unionByName(extra)
    kept = Scratch(spark, "t").put(cp.toxicity_filter(spark, docs, SMALL), "clean")
    assert kept.dtypes == docs.dtypes
    mine = Counter((r.doc_id, r.text) for r in kept.where("source = 's'").collect())
    assert mine == Counter((i, t) for i, t in rows if t != bad.text)
    left = cp.near_dedup(spark, kept.where("source = 's'"), SMALL)
    assert left.dtypes == docs.dtypes
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(
        [(a, fine), (b, rows[5][1]), (c, None), (c, ""), (None, None), (d, other)])


def test_label_model_finds_the_voters_rates():
    """From exact joint votes of independent voters: the log ratios of their hit and miss rates,
    and the posterior by Bayes' rule over all vote patterns; a copied voter shares its weight."""
    prior, n = 0.1, 10 ** 6
    hit, miss = np.zeros(toxicity.N_VOTERS), np.zeros(toxicity.N_VOTERS)
    hit[:6], miss[:6] = [0.9, 0.6, 0.4, 0.8, 0.3, 0.5], [0.05, 0.01, 0.1, 0.2, 0.02, 0.3]

    def joint(same=()):
        out = n * (prior * np.outer(hit, hit) + (1 - prior) * np.outer(miss, miss))
        np.fill_diagonal(out, n * (prior * hit + (1 - prior) * miss))
        for a, b in same:
            out[a, b] = out[b, a] = out[a, a]
        return out

    w, base = toxicity.label_model(n, joint(), prior)
    assert np.allclose(w[:6], np.log(hit[:6] / miss[:6]), rtol=1e-3) and (w[6:] == 0).all()
    masks = np.arange(64)
    on = (masks[:, None] >> np.arange(6)) & 1
    got = toxicity.posterior(masks, w, base)
    # an abstention says nothing: Bayes' rule over the votes that were cast
    odds = prior / (1 - prior) * np.prod(np.where(on, hit[:6] / miss[:6], 1.0), 1)
    assert np.allclose(got, odds / (1 + odds), atol=1e-3)
    hit[6], miss[6] = hit[0], miss[0]
    both, _ = toxicity.label_model(n, joint(same=[(0, 6)]), prior)
    assert np.isclose(both[0], both[6]) and 0.5 < both[0] / np.log(hit[0] / miss[0]) < 0.75
    assert np.allclose(both[1:6], np.log(hit[1:6] / miss[1:6]), rtol=0.05)


def test_a_run_leaves_its_result_alone(spark, tmp_path):
    """What the stages have written for themselves goes; the result can be read again and again."""
    import os

    import corpus_pipeline as cp
    from tarmac.session import scratch_path
    root = scratch_path(spark, "").removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = cp.run(spark, SMALL)
    left = {d for d in set(os.listdir(root)) - before if any(f for _, _, f in os.walk(os.path.join(root, d)))}
    assert len(left) == 1 and [t.split("-", 1)[1] for t in os.listdir(os.path.join(root, *left)) if not t.startswith(".")] == ["packing"]
    assert out.count() == out.count() > 0
