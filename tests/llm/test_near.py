"""Near-duplicates against brute force, sketch guarantees, odd rows."""
import random

import numpy as np
import pyarrow as pa

from tarmac.llm import near, textops


def brute(docs):
    sets = {}
    for i, x in docs:
        w = (x or "").encode().lower().split()
        sets.setdefault(i, set()).update([tuple(w[k:k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])
    ids = sorted(sets)
    comp = {i: i for i in ids}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                comp[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edits(rng, words, share):
    return [rng.choice(["aa", "bb", "cc"]) + str(rng.random()) if rng.random() < share else w for w in words]


def test_matches_brute_force(spark):
    rng = random.Random(5)
    docs, i = [], 0
    for group in range(12):
        base = [f"v{rng.randrange(4000)}" for _ in range(rng.randrange(3, 260))]
        for _ in range(12):
            docs.append((i, " ".join(edits(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04])))))
            i += 1
    got = {r.doc_id: r for r in near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute(docs)
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_odd_rows(odd_docs, no_docs):
    rows = near.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    comp = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert comp[1] == (0, 1, True) and comp[2] == (0, 2, True) and comp[3] == (0, 3, True)
    assert comp[5][1] == comp[6][1] == comp[7][1] == comp[8][1] == 5
    assert comp[9][1] == comp[10][1] == 9 and comp[9][0] == 1 and comp[11] == (1, 11, True)
    assert comp[None][1] is None and comp[4][0] == 59_996
    assert near.near_duplicates(no_docs).collect() == []


def test_every_coordinate_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 60, 3000):
        s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        c = near.sketch(s)
        assert len(c) == near.T and (c != np.iinfo(np.uint64).max).all()
    a = np.unique(rng.integers(0, 2**63, 700).astype(np.uint64))
    b = np.concatenate([a[:600], rng.integers(0, 2**63, 100).astype(np.uint64)])
    assert abs((near.sketch(a) == near.sketch(b)).mean() - 600 / 800) < 0.1


def test_components_of_paths_and_stars(spark):
    from tarmac.llm.base import Scratch, components
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(205, 201), (201, 207), (300, 300)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 201: 201, 205: 201, 207: 201}


def test_words_are_ascii_space_runs():
    texts = ["A b\tC", "", None, "  x y \n", "a b c"]
    arr = pa.array(texts)
    hashes = []
    for _, _, data, offs in textops.slices(arr):
        h, rows = textops.word_hashes(data, offs)
        hashes += [h[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])]
        assert len(textops.word_endings(data, offs)) == len(h)
    assert [len(h) for h in hashes] == [3, 0, 0, 1, 3] and hashes[0] == hashes[4]
    assert list(map(len, textops.shingle_sets(arr.slice(1)))) == [0, 0, 1, 1]


def test_block_step_confirms_every_text_of_a_repeated_id():
    """Ids 1 and 2 have two texts each; only the earlier text of both links."""
    same = " ".join(f"w{i}" for i in range(40))
    rows = [(1, 1, [2], same), (1, 1, [2], "quite another text of the id one here"),
            (2, 2, [], same), (2, 2, [], "yet other words that stand under id two")]
    b = pa.RecordBatch.from_pylist([dict(bucket=9, bi=0, bj=0, _id=i, comp=c, partners=p, _text=t) for i, c, p, t in rows])
    got = [tuple(r.values()) for out in near._confirm_partners([b]) for r in out.to_pylist()]
    assert got == [(1, 2)]


def test_only_texts_that_share_a_bucket_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(5)
    text = [" ".join(f"w{k}" for k in rng.integers(0, 10**9, 200)) for _ in range(40)]
    docs = [(k, t) for k, t in enumerate(text)] + [(100, text[3] + " more"), (101, text[3])]
    held, real = [], near._verified
    monkeypatch.setattr(near, "_verified", lambda pairs, texts: (held.append({r._id for r in texts.select("_id").collect()}), real(pairs, texts))[1])
    got = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {**{k: k for k in range(40)}, 100: 3, 101: 3}
    assert held and all(ids == {3, 100} for ids in held)
