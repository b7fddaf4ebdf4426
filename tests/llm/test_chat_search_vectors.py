"""Chat trees, exact search and vector links against brute force; odd rows."""
import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tarmac.llm import chat, search, vectors
from tarmac.session import ensure_checkpoint_dir


def read_back(df):
    return df.withColumn("turns", chat.parsed(F.col("formatted"))).withColumn(
        "lost", chat.loss_text(F.col("formatted"), F.col("loss"))).collect()


def test_branches_are_ranked_and_formatted(spark):
    #     1 -> 2 -> 4 (mean 1)      1 -> 3 -> 5 -> 6 (mean 2), 3 -> 7 (mean 5/3)
    rows = [("t", 1, None, "user", "q", 1.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 4, 2, "user", "b", 1.0),
            ("t", 3, 1, "assistant", "c", 1.0), ("t", 5, 3, "user", "d", 4.0), ("t", 6, 5, "assistant", "e", 2.0),
            ("t", 7, 3, "user", "f", 3.0), ("u", 1, 99, "user", None, None), ("loop", 1, 2, "user", "x", 1.0),
            ("loop", 2, 1, "user", "y", 1.0), (None, 1, None, None, "z", 1.0)]
    msgs = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r.tree, r["rank"]): (r.leaf, [(t.role, t.text) for t in r.turns], r.lost) for r in read_back(chat.formatted(msgs, 2))}
    assert got == {("t", 1): (6, [("user", "q"), ("assistant", "c"), ("user", "d"), ("assistant", "e")], "ce"),
                   ("t", 2): (7, [("user", "q"), ("assistant", "c"), ("user", "f")], "c"),
                   ("u", 1): (1, [("user", "")], ""), (None, 1): (1, [("", "z")], "")}
    assert chat.formatted(msgs.limit(0)).collect() == []


def test_control_strings_survive_and_do_not_act(spark):
    rng = random.Random(3)
    bits = chat.CONTROL + ["\\", "[", "<", "|", "a", "\n", "[\\INST]", "<\\|im_end|>", "</", "☃", "", "im_end|>\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(8))) for _ in range(300)] + ["x" * 100_000]
    rows = [(i // 3, i % 3, rng.choice(["user", "assistant", "sys\ntem\\n", "<|im_start|>"]), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = read_back(chat.formatted(chat.chain(df, "conv_id", "turn")))
    assert len(out) == 101
    for r in out:
        mine = [x for x in rows if x[0] == r.tree]
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in mine]
        assert r.lost == "".join(x[3] for x in mine if x[2] == "assistant")
        assert r.formatted.count(chat.START) == len(mine)


def test_roles_of_any_characters_repeated_rows_and_clashing_columns(spark):
    roles = ["a\x00b", "\x00", "a\\nb", "a\nb", "\\", "\\\\n", "s\\s", "<|im_end|>\n", "[\\INST]", "user", "user"]
    rows = [(1, 3, r, "same text") for r in roles] + [(1, 3, "user", "same text")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("tree", "node", "parent", "score", "t", "leaf", "rank", "p", "d"):
        df = df.withColumn(c, F.lit("clash"))
    (got,) = read_back(chat.formatted(chat.chain(df, "conv_id", "turn")))
    assert [t.role for t in got.turns] == sorted(roles + ["user"], key=lambda r: r.encode()) and got.n_turns == 12
    assert {t.text for t in got.turns} == {"same text"}


def test_top_k_matches_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(2)
    vocab = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 120)))) for i in range(700)] + [(3, "tie tie"), (9, "tie tie")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = [(k, docs[k][1]) for k in range(0, 700, 50)] + [(10_000, "tie w1 w2 unheard"), (10_001, " "), (10_002, None)]
    got = {}
    for r in search.top_k(df, spark.createDataFrame(asked, "query_id long, text string"), 7, shards=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    words = [x.split() for _, x in docs]
    mean = sum(map(len, words)) / len(words)
    df_of = {}
    for w in words:
        for t in set(w):
            df_of[t] = df_of.get(t, 0) + 1
    for q, text in asked:
        terms = set((text or "").split())
        s = []
        for (i, _), w in zip(docs, words):
            v = sum(math.log(1 + (len(docs) - df_of[t] + 0.5) / (df_of[t] + 0.5)) * w.count(t) * 2.2
                    / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in terms if t in w)
            if v:
                s.append((-round(v, 6), i))
        want = [(n + 1, i, -v) for n, (v, i) in enumerate(sorted(s)[:7])]
        assert sorted(got.get(q, [])) == want, q
    assert search.top_k(no_docs, spark.createDataFrame(asked, "query_id long, text string")).collect() == []
    odd = search.top_k(odd_docs, odd_docs.select(F.col("doc_id").alias("query_id"), "text")).collect()
    assert {r.query_id for r in odd} == {4, 5, 6, 7, 8, 9, 10, 11, 12, 13}
    assert None in {r.doc_id for r in odd} or all(r.doc_id is not None for r in odd)


def test_queries_take_no_disk_per_shard(spark, monkeypatch):
    """Forty shards leave about as many bytes behind as two: no copy of a query for every shard."""
    rng = random.Random(12)
    docs = [(i, " ".join(f"w{rng.randrange(1 << 40)}" for _ in range(600))) for i in range(240)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = df.select(F.col("doc_id").alias("query_id"), "text")

    def kept():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        at = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
        store = at.getFileSystem(spark._jsc.hadoopConfiguration())
        return sum(files.apply(i).length() for i in range(files.size())) + store.getContentSummary(at).getLength()

    left = {}
    for shards in (2, 40):
        before = kept()
        assert search.top_k(df, asked, 1, shards=shards).count() == 240
        left[shards] = kept() - before
    assert left[40] < 2 * left[2], left


def test_top_k_by_stages_and_groups_is_the_same(spark, monkeypatch):
    """First shards before the others, chunks in several groups: the rows of one shard."""
    rng = random.Random(13)
    vocab = [f"w{int(rng.paretovariate(0.5))}" for _ in range(3000)]
    docs = [(i // 2 if i % 50 == 0 else i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 90)))) for i in range(900)]
    docs += [(None, docs[4][1]), (2000, docs[4][1]), (2001, docs[4][1]), (2001, docs[4][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    asked = df.where("doc_id % 3 = 0").select(F.col("doc_id").alias("query_id"), "text")
    rows = lambda **c: sorted((tuple(r) for r in search.top_k(df, asked, 5, **c).collect()), key=str)
    one = rows(shards=1)
    assert {q for q, *_ in one} == {i for i, t in docs if i is not None and i % 3 == 0 and t}
    monkeypatch.setattr(search, "GROUP_BYTES", 4096)
    assert rows(shards=5) == one
    monkeypatch.setattr(search, "EARLY_TASKS", 2)
    assert rows(shards=7) == one


def test_shards_and_chunks_are_cut_by_size(monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 800)
    monkeypatch.setattr(search, "PIECE", 300)
    monkeypatch.setattr(search, "CHUNK_TERMS", 30)
    monkeypatch.setattr(search, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 3})())}))
    terms = [np.sort(np.random.default_rng(i).choice(500, i % 40, replace=False)).astype("<u8") for i in range(100)]
    packed = pa.RecordBatch.from_arrays([
        pa.array([None if i == 7 else i for i in range(100)], pa.int64()), pa.array(list(map(len, terms)), pa.int64()),
        pa.array([t.tobytes() for t in terms]), pa.array([np.ones(len(t), "<u4").tobytes() for t in terms])], ["id", "words", "terms", "tfs"])
    shards, pieces = [], []
    for r in search._index([packed.slice(0, 33), packed.slice(33)]):
        assert r.num_rows == 1 and r.column("task")[0].as_py() == 3
        if r.column("mark")[0].as_py():
            shards.append(search.Shard.of(pieces, 20.0))
            pieces = []
        else:
            pieces.append(r.column("data")[0].as_py())
            assert len(pieces[-1]) <= 300
    sizes = [8 * len(s.doc) for s in shards]
    assert not pieces and sum(sizes) == 8 * sum(map(len, terms)) and all(400 <= s <= 1200 + 8 * 40 for s in sizes) and len(sizes) > 10
    found = {}
    for shard in shards:
        for t, a, e in zip(shard.terms.tolist(), shard.start[:-1], shard.start[1:]):
            for i in shard.ids[shard.doc[a:e]].tolist():
                found.setdefault(i, []).append(t)
    assert found == {search._NULL if i == 7 else i: t.tolist() for i, t in enumerate(terms) if len(t)}
    asks = pa.RecordBatch.from_arrays([pa.array(range(100), pa.int64()), packed.column("terms"), pa.array([(t * 0.5).astype("<f8").tobytes() for t in terms]),
                                       pa.array([None if i % 2 else float(i) for i in range(100)], pa.float64())], ["id", "terms", "idf", "least"])
    seen = 0
    pieces = []
    for r in search._chunks([asks.slice(0, 41), asks.slice(41)]):
        pieces.append(r.column("data")[0].as_py())
        assert len(pieces[-1]) <= 300
        if not r.column("last")[0].as_py():
            continue
        q, cuts, least, names, idf, at = search._chunk(pieces)
        pieces = []
        assert (idf == names * 0.5).all() and len(at) < 30 + 40
        for n, i in enumerate(q.tolist()):
            assert i == seen and names[at[cuts[n]:cuts[n + 1]]].tolist() == terms[i].tolist()
            assert least[n] == (-np.inf if i % 2 else i)
            seen += 1
    assert seen == 100


def test_a_threshold_opens_few_documents_and_misses_none(monkeypatch):
    """Open blocks only, or the whole table in short numbers: the best documents and scores of a full sum."""
    rng = np.random.default_rng(5)
    common = np.arange(60, dtype=np.uint64)
    terms = [np.unique(np.append(rng.choice(common, 20), rng.integers(60, 4000, 15).astype(np.uint64))) for _ in range(3000)]
    terms[2900:] = [np.unique(np.append(common[:40], np.arange(5000, 5010, dtype=np.uint64))) for _ in range(100)]
    tfs = [rng.integers(1, 5, len(t)).astype("<u4") for t in terms]
    words = [int(n.sum()) for n in tfs]
    names = np.arange(5010, dtype=np.uint64)
    idf = rng.uniform(0.01, 9, len(names))
    asks = [terms[i] for i in (0, 5, 2950, 2999)] + [np.array([77], np.uint64), np.array([9999], np.uint64)]
    sums = []
    for t in asks:
        sums.append(np.array([sum(idf[int(x)] * m * 2.2 / (m + 1.2 * (0.25 + 0.75 * w / 90.0)) for x, m in zip(d.tolist(), n.tolist()) if x in set(t.tolist()))
                              for d, n, w in zip(terms, tfs, words)]))
    shard = search.Shard(range(3000), words, list(terms), list(tfs), 90.0)
    assert shard.table.shape[1] >= 40 and shard.blocks == 24
    asked = np.append(names, np.uint64(9999))
    at, cuts = np.searchsorted(asked, np.concatenate(asks)), np.append(0, np.cumsum([len(t) for t in asks]))
    for share in (1, 1000):  # any number of blocks may be pruned, none may
        monkeypatch.setattr(search, "OPEN", share)
        for known in (False, True):
            least = np.array([np.round(np.sort(s)[-10], 6) if known and s.max() > 0 else -np.inf for s in sums])
            got = {i: (ids, score) for i, ids, score in shard.search_all(asked, np.append(idf, 1.0), at, cuts, least, 10)}
            for i, s in enumerate(sums):
                best = [d for d in np.lexsort((np.arange(3000), -np.round(s, 6)))[:10] if s[d] > 0]
                ids, score = got[i]
                assert set(best) <= set(ids.tolist())
                assert np.allclose(score, s[ids], rtol=1e-12)
                if known or share == 1000:
                    assert len(ids) < 40 or i == 4


def test_a_shard_takes_little_more_than_its_postings():
    rng = np.random.default_rng(8)
    terms = [np.unique(rng.integers(0, 1 << 20, 400).astype(np.uint64)) for _ in range(2500)]
    tfs = [rng.integers(1, 4, len(t)).astype("<u4") for t in terms]
    words, postings = [int(n.sum()) for n in tfs], sum(map(len, terms))
    tracemalloc.start()
    held = tracemalloc.get_traced_memory()[0]
    shard = search.Shard(range(2500), words, list(terms), list(tfs), 800.0)
    now, peak = (x - held for x in tracemalloc.get_traced_memory())
    tracemalloc.stop()
    assert peak < 60 * postings, (peak / postings, now / postings)  # 104 with every step at 64 bits
    t = terms[7][:30]
    ids, score = shard.search(t, np.ones(30), 5)
    want = {}
    for i in range(2500):
        n = tfs[i][np.isin(terms[i], t)].astype(float)
        want[i] = (n * 2.2 / (n + 1.2 * (0.25 + 0.75 * words[i] / 800.0))).sum()
    best = sorted(want, key=lambda i: -want[i])[:5]
    assert [i for i, _ in sorted(zip(ids.tolist(), score), key=lambda x: -x[1])[:5]] == best


def test_vector_links_match_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(30):
        c = rng.normal(size=24)
        rows += [(len(rows) + k, (c + rng.normal(size=24) * s).astype("f4").tolist(), int(g % 3))
                 for k, s in enumerate([0.0, 0.0, 0.1, 0.2, 0.3, 0.38, 0.4, 0.5] * 3)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 24, 1), (n + 2, [float("nan")] * 24, 1), (n + 3, [1.0, None], 1), (n + 4, rows[0][1], None),
             (n + 5, [float("inf")] * 24, 1), (n + 6, [], 1), (n + 7, [2 * x for x in rows[0][1]], rows[0][2]), (n + 8, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for c in ("id", "v", "cls", "key"):
        df = df.withColumn(c, F.lit(1))
    good = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    links = {r[0]: set() for r in rows}
    for i, a in enumerate(good):
        for b in good[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], "f4").astype(float), np.array(b[1], "f4").astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= vectors.THRESHOLD:
                    links[a[0]].add(b[0])
                    links[b[0]].add(a[0])
    comp = {i: i for i in links}
    moved = True
    while moved:
        moved = False
        for i, others in links.items():
            low = min([comp[i], *(comp[j] for j in others)])
            moved, comp[i] = moved or low != comp[i], low
    for lists in (1, 9):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df, lists=lists).collect()}
        assert got == {i: (len(links[i]), comp[i], comp[i] == i) for i in links}
    assert vectors.near_vectors(df.limit(0)).collect() == []


def linked(spark, rows, kind="string"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()), key=str)


def test_tiny_and_huge_vectors_link_by_direction(spark):
    """A vector's length says nothing: 1e-200 and 1e200 times a vector link with it, and one
    odd vector takes no other's links."""
    base = [1.0, 2.0, -3.0, 0.5]
    rows = [(i, [c * s for c in base], "a") for i, s in enumerate([1.0, 2.0, 1e-200, 1e200, 1e-310, 3.0])]
    rows += [(6, [1e-200, 0.0, 0.0, 0.0], "a"), (7, [0.0, 5e-324, 0.0, 0.0], "a"), (8, [0.0, 1e308, 0.0, 0.0], "a"), (9, [0.0] * 4, "a")]
    want = [(i, 5, 0) for i in range(6)] + [(6, 0, 6), (7, 1, 7), (8, 1, 7), (9, 0, 9)]
    assert linked(spark, rows) == want


def test_labels_are_compared_in_their_own_type(spark):
    v, far = [1.0, 2.0], [2.0, -1.0]
    assert linked(spark, [(1, v, 1.2), (2, v, 1.7), (3, v, 1.2), (4, v, 0.0), (5, v, -0.0), (6, v, None)], "double") == [
        (1, 1, 1), (2, 0, 2), (3, 1, 1), (4, 1, 4), (5, 1, 4), (6, 0, 6)]
    assert linked(spark, [(1, v, "x"), (2, v, "X"), (3, v, "x"), (4, v, "1"), (5, v, "1.0"), (6, v, ""), (7, v, "")]) == [
        (1, 1, 1), (2, 0, 2), (3, 1, 1), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6)]
    assert linked(spark, [(1, v, [1]), (2, v, [1]), (3, v, [2])], "array<int>") == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]
    # a repeated id: every row has its own count, the ids share a component where they link
    assert linked(spark, [(1, v, "x"), (1, v, "x"), (1, far, "x"), (2, v, "x")]) == [(1, 0, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_a_list_of_many_blocks_keeps_every_link(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 8)
    rng = np.random.default_rng(6)
    e = rng.normal(size=(90, 6))
    e[30:] = e[:60] + rng.normal(size=(60, 6)) * 0.1
    rows = [(i, v.tolist(), "hot") for i, v in enumerate(e)]
    u = e / np.linalg.norm(e, axis=1)[:, None]
    want = ((u @ u.T) >= 0.93).sum(1) - 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for lists in (1, 5):
        assert {r.vec_id: r.n_links for r in vectors.near_vectors(df, lists=lists).collect()} == dict(enumerate(want.tolist()))
