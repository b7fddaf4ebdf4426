"""Tokens, packing, shards and counts: exact round trips, brute force, odd rows."""
import functools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import counts, packing, shards, tokens
from tarmac.llm.base import Scratch

SMALL = "/root/testdata/sf0.001"


@functools.cache
def _library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


def library_ids(texts):
    t = _library()
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [tokens.EOS], "<u4") for x in texts]


def test_ids_equal_the_library(spark, odd_docs):
    texts = [r.text for r in odd_docs.select("text").collect()] + ["  a\n\n b's 12345 !!", "　é́ ☃☃", "\r\n\t x"]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    enc = tokens.encoder()
    for x, want in zip(texts, library_ids(texts)):
        assert (tokens.token_ids(x, enc) == want).all()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\u00a0", "\u2003",
                                 "\u3000", "\u200b", ".", "!!", "'s", "'", "12", "é", "漢", "☃", "<|endoftext|>", "word", "_"]), max_size=14))
def test_random_strings_have_the_library_s_ids(bits):
    enc, x = tokens.encoder(), "".join(bits)
    assert (tokens.token_ids(x, enc) == library_ids([x])[0]).all()
    assert (tokens.token_ids(x + " " + x, enc) == library_ids([x + " " + x])[0]).all()


def check_pieces(docs, out, window):
    ids = {}
    for r, x in zip(docs, library_ids([r.text for r in docs])):
        ids.setdefault(r.doc_id, []).append(x)
    got = {}
    for p in out:
        got.setdefault(p.doc_id, []).append(p)
    assert set(got) == set(ids)
    for k, ps in got.items():
        n = len(ids[k])
        assert sum(p.length for p in ps) == sum(map(len, ids[k]))
        for p in ps:
            assert any(p.doc_tokens == len(x) and x[p.start:p.start + p.length].tobytes() == bytes(p.ids) for x in ids[k])
        if n == 1:
            ps = sorted(ps, key=lambda p: p.start)
            assert [p.start for p in ps] == [0, *np.cumsum([p.length for p in ps])[:-1]]
    seqs = {}
    for p in out:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(seqs) == list(range(len(seqs)))
    full = 0
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [0, *np.cumsum([n for _, n in s])[:-1]] and sum(n for _, n in s) <= window
        full += sum(n for _, n in s) == window
    assert full >= len(seqs) - 1


def test_packing_is_whole_and_mixed(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = packing.pack(docs).collect()
    check_pieces(docs.select("doc_id", "text").collect(), out, packing.WINDOW)
    # long-run shares: in the first half of the windows every source has its share up to a few packets
    src = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    total, half = {}, {}
    cut = max(p.sequence_id for p in out) // 2
    for p in out:
        total[src[p.doc_id]] = total.get(src[p.doc_id], 0) + p.length
        if p.sequence_id < cut:
            half[src[p.doc_id]] = half.get(src[p.doc_id], 0) + p.length
    n = sum(total.values())
    for s, t in total.items():
        assert abs(half[s] - cut * packing.WINDOW * t / n) <= 3 * packing.PACKET + packing.WINDOW * t / n


def test_given_weights(spark):
    rows = [(i, "word " * 400, "ab"[i % 2], "en", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    out = packing.pack(docs, weights={"a": 3.0, "b": 1.0}).collect()
    check_pieces(docs.collect(), out, packing.WINDOW)
    first = [p for p in out if p.sequence_id < 3]
    a = sum(p.length for p in first if p.doc_id % 2 == 0)
    assert abs(a / sum(p.length for p in first) - 0.75) < 0.05


def test_odd_rows_pack(spark, odd_docs, no_docs):
    out = packing.pack(odd_docs).collect()
    check_pieces(odd_docs.select("doc_id", "text").collect(), out, packing.WINDOW)
    assert packing.pack(no_docs).collect() == []
    seqs = packing.sequences(packing.pack(odd_docs)).collect()
    assert sum(len(s.ids) // 4 for s in seqs) == sum(p.length for p in out)


def test_feistel_is_a_keyed_permutation():
    for n in (1, 2, 3, 17, 1000, 4096, 5001):
        a, b = shards.feistel(np.arange(n), n, 5), shards.feistel(np.arange(n), n, 6)
        assert sorted(a.tolist()) == sorted(b.tolist()) == list(range(n))
    assert (a != b).mean() > 0.9 and abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.1


def test_shards_round_trip_and_resume(spark, odd_docs, no_docs, tmp_path):
    out = shards.write_shards(odd_docs, str(tmp_path / "s"), seq_len=64, rows=100).collect()
    rows = odd_docs.select("doc_id", "text").collect()
    n = len(out)
    assert sorted(r.slot for r in out) == list(range(n)) and all(r.shard == r.slot // 100 and len(r.ids) == 128 for r in out)
    want = sorted((zlib.crc32(x[k:k + 64].tobytes()), len(x[k:k + 64])) for x in library_ids([r.text for r in rows])
                  for k in range(0, len(x), 64))
    assert sorted((zlib.crc32(np.frombuffer(r.ids, "<u2")[:r.n_tokens].astype("<u4").tobytes()), r.n_tokens) for r in out) == want
    late = shards.read_shards(spark, str(tmp_path / "s"), first_slot=250, rows=100)
    assert sorted(r.slot for r in late.collect()) == list(range(250, n))
    again = {r.slot: bytes(r.ids) for r in shards.write_shards(odd_docs, str(tmp_path / "t"), seq_len=64, rows=100).collect()}
    assert again == {r.slot: bytes(r.ids) for r in out}
    assert shards.write_shards(no_docs, str(tmp_path / "e")).collect() == []


def test_slots_depend_on_the_rows_alone(spark, odd_docs, tmp_path, monkeypatch):
    """Two and five partitions, other chunks and ranges: the same document at the same slot, byte for byte."""
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    seen = []
    for k, (parts, cut, ranges) in enumerate(((2, 1000, 500_000), (5, 3, 40))):
        monkeypatch.setattr(shards, "CUT_ROWS", cut)
        monkeypatch.setattr(shards, "RANGE_DOCS", ranges)
        out = shards.write_shards(given.repartition(parts), str(tmp_path / f"p{k}"), seq_len=64, rows=500)
        seen.append({r.slot: (r.doc_id, r.seq_no, r.n_tokens, bytes(r.ids)) for r in out.collect()})
    assert seen[0] == seen[1] and sorted(seen[0]) == list(range(len(seen[0])))


def test_binary_shards_resume_from_their_byte(spark, odd_docs, no_docs, tmp_path):
    out = shards.write_shards(odd_docs, str(tmp_path / "s"), seq_len=64, rows=100)
    want = {r.slot: bytes(r.ids) for r in out.collect()}
    n = len(want)
    files = shards.write_binary(out, str(tmp_path / "bin")).collect()
    assert sum(f.rows for f in files) == n and {f.stride for f in files} == {128} and sorted(f.shard for f in files) == list(range(-(-n // 100)))
    for f in files:
        raw = (tmp_path / "bin" / f"shard-{f.shard:06d}.bin").read_bytes()
        assert f.first_slot == f.shard * 100 and len(raw) == f.bytes == f.rows * 128 and zlib.crc32(raw) == f.crc32
        assert raw == b"".join(want[f.first_slot + k] for k in range(f.rows))
    assert not list((tmp_path / "bin").glob("_part*"))
    for first in (0, 99, 100, 257, n - 1, n):
        assert list(shards.read_binary(str(tmp_path / "bin"), first, 128, rows=100)) == [want[s] for s in range(first, n)]
    again = shards.write_binary(out, str(tmp_path / "bin")).collect()  # a rerun replaces whole files
    assert sorted(again) == sorted(files)
    assert shards.write_binary(shards.write_shards(no_docs, str(tmp_path / "e")), str(tmp_path / "none")).collect() == []


def test_counts_match_plain_dynamic_programming(spark, odd_docs, no_docs, monkeypatch):
    pieces = counts.vocabulary()
    low, longest = min(pieces.values()) - 10.0, max(map(len, pieces))

    def plain(word):
        best = [(0.0, 0, 0)]
        for e in range(1, len(word) + 1):
            w = len(word[e - 1].encode())
            s, t, b = best[e - 1]
            c = [(s + w * low, t - w, b - w)]
            c += [(best[j][0] + pieces[word[j:e]], best[j][1] - 1, best[j][2]) for j in range(max(0, e - longest), e) if word[j:e] in pieces]
            best.append(max(c))
        return -best[-1][1], -best[-1][2]

    known = {}

    def plain_text(text):
        words = (text or "").encode().split()
        for w in set(words) - known.keys():
            known[w] = plain(counts.MARK + w.decode())
        return len(words), sum(known[w][0] for w in words), sum(known[w][1] for w in words)

    # whole texts, 60,000 words and a word of 30,000 letters among them, repeated rows, a null id
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    monkeypatch.setattr(counts, "SLICE_ROWS", 50)
    got = Counter((r.doc_id, r.n_words, r.n_tokens, r.n_byte_tokens) for r in counts.token_counts(rows).collect())
    assert got == Counter((r.doc_id, *plain_text(r.text)) for r in rows.collect())
    clash = odd_docs.withColumn("n_words", F.lit("x")).withColumn("words", F.lit("x"))
    assert counts.token_counts(clash).count() == odd_docs.count()
    assert counts.token_counts(no_docs).collect() == []
    trie = counts.Trie(pieces)
    words = ["▁share", "▁shared", "▁sharing", "▁shy"]
    assert trie.solve(words) == [plain(w) for w in words]
    assert trie.nodes == len({w[:k] for w in words for k in range(1, len(w) + 1)})  # each prefix once


def test_schedule_is_a_round_by_round_deficit_round_robin(spark):
    """Packets in the order that a plain deficit round-robin sends them, one round a window."""
    rng = np.random.default_rng(8)
    window, packet = 96, 16
    rows, pos = [], {}
    for part in range(3):
        for k in range(25):
            src, n = "n" if k % 9 == 8 else f"s:{'abc'[k % 3]}", int(rng.integers(1, 60))
            rows.append((part << 33 | k, part, src, n, pos.get((part, src), 0)))
            pos[part, src] = pos.get((part, src), 0) + n
    weights = {"a": 3.0, "b": 1.5, "c": 1.0, None: 0.5}
    meta = spark.createDataFrame(rows, "uid long, part long, src string, n long, pos long")
    got = sorted((r.g, r.uid, r.start, r.length) for r in packing.schedule(meta, window, packet, weights, Scratch(spark, "t")).collect())
    queues = {}
    for uid, part, src, n, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        queues.setdefault(src, []).extend((uid, s, min(packet, n - s)) for s in range(0, n, packet))
    share = {"n" if k is None else f"s:{k}": v / sum(weights.values()) for k, v in weights.items()}
    deficit, want, g = dict.fromkeys(queues, 0.0), [], 0
    while any(queues.values()):
        for src in sorted(queues):
            deficit[src] += window * share[src]
            while queues[src] and queues[src][0][2] <= deficit[src] + 1e-9:
                uid, s, n = queues[src].pop(0)
                deficit[src] -= n
                want.append((g, uid, s, n))
                g += n
    assert got == want
