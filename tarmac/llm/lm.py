"""Language-model scores by a hierarchical Pitman-Yor model.

A token is predicted in the restaurant of its context, the token before it. A
restaurant's parent is that of the context's ending (its last two letters, 256 classes),
whose parent is the root; below the root all V + 1 types are alike. Every context has a
restaurant of its own, known by 64 bits, and every token of the training texts is a
customer: what is kept grows with the corpus.

Customers of one dish (predicted word) meet in one partition, so the seating of a dish,
from its context restaurants up to the root, is sampled there. A Gibbs sweep takes
the customers of every dish out of their restaurants and seats them again one by one: at
a new table with probability proportional to (strength + discount x tables) x parent's
predictive, else at an occupied one; each new table is a customer of the parent.
Customers beyond the 64th come in blocks of i/32 that share one probability. After a
sweep the totals of all restaurants (customers, tables) are added up and the next sweep
starts from them, so a sweep is synchronous over dishes. Scores take the mean of the
kept sweeps' predictives, each under its own totals, so that a restaurant's probabilities
add up to one.

Totals of restaurants travel in two ways. The ``KNOWN`` most frequent contexts of a sample
have numbers; theirs are a vector of that size. All other contexts' totals are a
table: each partition sends its contexts' parts to hashed buckets, a bucket adds them up and
sends every partition the totals of the contexts it holds, joined to its rows. Which
contexts have numbers changes the way, no result.

Steps: scan tasks cut texts into chunks and send every partition one block of a chunk's
words, contexts and text numbers; partitions answer with one sum per chunk and text. A
frequent word's occurrences in numbered contexts are dealt out by chunk over partitions of
their own, which share its counts (at most ``KNOWN`` contexts); those in other contexts
go to the partition of the context. Its upper levels, one number per ending, are seated
once a sweep from the sums of all partitions. The sweeps are seeded and replayed by
later passes instead of being stored. Discounts are n1 / (n1 + 2 n2) of each level's first
customers.

Edge cases: a null or empty text is its end token alone; repeated rows are texts
of their own; a null id counts as the empty text for the split; without training
texts all scores are 0; very long texts are chunks of their own; an empty table gives an
empty result; other columns are ignored, whatever their names. Words are compared by
64-bit hashes, contexts by 56 bits of them and their ending."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import textops
from tarmac.llm.base import Scratch

CHUNK_WORDS = 700_000
CHUNK_DOCS = 30_000  # text numbers have 15 bits, the 16th marks held-out texts
PART_BYTES = 8 << 20
#: words of at least this share of a sample of about so many texts get partitions of their own
HOT_SHARE, SAMPLE_TEXTS, HOT_TOKENS = 0.001, 8_000, 1_000_000
#: contexts that have numbers, and the number that stands for any other
KNOWN, OTHER = (1 << 16) - 1, (1 << 16) - 1
ENDINGS = 256
STRENGTH = (10.0, 5.0, 2.0)  # root, endings, contexts
BURN_IN, SAMPLES = 1, 2
_END = np.uint64(0xD6E8FEB86659FD93)
_START = np.uint64(0)  # the context of a text's first token
_HELD = np.uint16(1 << 15)
_ANSWER = 1  # marks rows of sums; heads have parts below 0
_zip = pa.Codec("zstd")


def _put(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + (_zip.compress(raw, asbytes=True) if raw else b"")


def _get(b: bytes, kind) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(_zip.decompress(b[8:], n, asbytes=True) if n else b"", kind)


def context_keys(words: np.ndarray, endings: np.ndarray) -> np.ndarray:
    """56 bits of a word's hash and the class of its ending."""
    return (words & ~np.uint64(255)) | (endings & np.uint64(255))


class Frequent:
    """Frequent words (hashes, sorted) with their numbers of partitions, and the numbered
    contexts (keys, sorted). A sample tells them; they steer ways, not results."""

    def __init__(self, texts: DataFrame, n_texts: int, tokens: float, numbered: int = KNOWN):
        def work(batches):
            for b in batches:
                for _, _, data, offs in textops.slices(b.column(0)):
                    words, rows = textops.word_hashes(data, offs)
                    key, n = np.unique(context_keys(words, textops.word_endings(data, offs)), return_counts=True)
                    w, m = np.unique(np.append(words, np.full(len(rows) - 1, _END)), return_counts=True)
                    some = m >= HOT_SHARE * m.sum() / 8  # a frequent word is not far below its share in any slice
                    for kind, x, c in ((0, key, n), (1, w[some], m[some]), (2, np.zeros(1, np.uint64), m.sum(keepdims=True))):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x.view(np.int64)), pa.array(c)], ["kind", "w", "n"])

        share = max(1, n_texts // SAMPLE_TEXTS)
        seen = texts.where(F.pmod(F.xxhash64("id", "text"), F.lit(share)) == 0).select("text").mapInArrow(work, "kind int, w long, n long")
        count = Scratch(texts.sparkSession, "lm-sample").put(seen.groupBy("kind", "w").agg(F.sum("n").alias("n")), "counts")
        keys = [r.w for r in count.where("kind = 0").orderBy(F.desc("n"), "w").limit(max(0, numbered - 1)).select("w").collect()]
        total = (count.where("kind = 2").first() or {"n": 0})["n"]
        hot = count.where((F.col("kind") == 1) & (F.col("n") >= HOT_SHARE * total)).collect()  # at most 1 / HOT_SHARE
        hot.sort(key=lambda r: r.w & (2**64 - 1))
        self.words = np.array([r.w for r in hot], np.int64).view(np.uint64)
        self.spread = np.array([max(1, -(-r.n / total * tokens // HOT_TOKENS)) for r in hot], np.int64)
        self.known = np.unique(np.append(np.array(keys, np.int64).view(np.uint64), _START))
        self.known_end = (self.known & np.uint64(255)).astype(np.int64)

    def hot_index(self, words: np.ndarray) -> np.ndarray:
        """Place among the frequent words, -1 for others."""
        return _find(self.words, words)


def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[at] == x, at, -1)


def _spread(h: np.ndarray, parts: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _chunk_rows(chunk: int, parts: int, often: Frequent, ids: list, sizes: list, held: list, hashes: list, contexts: list):
    """Blocks of one chunk, and its texts as a part of their own."""
    h, key = np.concatenate(hashes), np.concatenate(contexts)
    n = np.array(sizes, np.int64)
    if len(n) > _HELD:
        raise ValueError(f"{len(n)} texts in a chunk, their numbers have 15 bits")
    yield (-1 - chunk, chunk, _put(np.array([-1 if i is None else i for i in ids], np.int64)), _put(n),
           _put(np.array(held, bool)), _put(np.array([i is None for i in ids], bool)), _put(np.empty(0)))
    doc = np.repeat(np.arange(len(n), dtype=np.uint16) | np.where(held, _HELD, np.uint16(0)).astype(np.uint16), n)
    ctx, hot = _find(often.known, key), often.hot_index(h)
    part = _spread(h, parts)
    apart = (hot >= 0) & (ctx < 0)  # a frequent word in a context without a number
    part[apart] = _spread(textops.mix64(key[apart]), parts)
    shared = (hot >= 0) & (ctx >= 0)
    place = int(textops.mix64(np.array([chunk], np.uint64))[0] >> np.uint64(1))
    first = np.cumsum(often.spread) - often.spread
    part[shared] = parts + first[hot[shared]] + place % often.spread[hot[shared]]
    by = np.argsort(h, kind="stable")
    by = by[np.argsort(part[by].astype(np.int16) if part.max(initial=0) < 1 << 15 else part[by], kind="stable")]
    h, part, ctx, key, doc = h[by], part[by], ctx[by], key[by], doc[by]
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        some, count = np.unique(h[a:b], return_counts=True)
        mine = ctx[a:b]
        yield (int(part[a]), chunk, _put(some), _put(count.astype(np.uint32)), _put(np.where(mine < 0, OTHER, mine).astype(np.uint16)),
               _put(doc[a:b]), _put(key[a:b][mine < 0]))


_BLOCK = ["part", "chunk", "a", "b", "c", "d", "e"]
_BLOCK_KINDS = (pa.int64(), pa.int64(), *[pa.binary()] * 5)
_BLOCK_SCHEMA = "part long, chunk long, a binary, b binary, c binary, d binary, e binary"


def _batch(rows: list, names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)],
                                      list(names))


def _blocks(parts: int, often: Frequent):
    def work(batches):
        task, seq = TaskContext.get().partitionId(), 0
        held = [[], [], [], [], []]
        size = 0
        for b in batches:
            ids, out = b.column(0).to_pylist(), b.column(2).to_pylist()
            for lo, hi, data, offs in textops.slices(b.column(1)):
                words, rows = textops.word_hashes(data, offs)
                keys = context_keys(words, textops.word_endings(data, offs))
                for i in range(lo, hi):
                    x, y = rows[i - lo], rows[i - lo + 1]
                    held[0].append(ids[i])
                    held[1].append(y - x + 1)
                    held[2].append(out[i])
                    held[3] += [words[x:y], [_END]]
                    held[4] += [[_START], keys[x:y]]
                    size += y - x + 1
                    if len(held[0]) == CHUNK_DOCS:  # in the middle of a slice: a slice may hold any number of short texts
                        yield _batch(list(_chunk_rows(task << 24 | seq, parts, often, *held)), _BLOCK, _BLOCK_KINDS)
                        held, size, seq = [[], [], [], [], []], 0, seq + 1
                if size >= CHUNK_WORDS:
                    yield _batch(list(_chunk_rows(task << 24 | seq, parts, often, *held)), _BLOCK, _BLOCK_KINDS)
                    held, size, seq = [[], [], [], [], []], 0, seq + 1
        if held[0]:
            yield _batch(list(_chunk_rows(task << 24 | seq, parts, often, *held)), _BLOCK, _BLOCK_KINDS)

    return work


_STATE = ("part long, words binary, entry_word binary, entry_ctx binary, counts binary, others binary, chunks binary, cuts binary, "
          "entry binary, doc binary")
_STATE_NAMES = [x.split()[0] for x in _STATE.split(", ")]
_STATE_KINDS = (pa.int64(), *[pa.binary()] * 9)


def _merge(key, table):
    """One partition's dishes: distinct (word, context) entries with training
    counts, and where each occurrence belongs. Contexts without a number follow the
    numbered ones, in the order of their keys."""
    chunks = np.array(table.column("chunk").to_pylist(), np.int64)
    words, count, ctx, doc, other = ([_get(x.as_py(), k) for x in table.column(c)]
                                     for c, k in zip("abcde", (np.uint64, np.uint32, np.uint16, np.uint16, np.uint64)))
    every, at = np.unique(np.concatenate(words), return_inverse=True)
    cuts = np.append(0, np.cumsum([len(x) for x in ctx]))
    where = np.concatenate(ctx).astype(np.int64)
    others, place = np.unique(np.concatenate(other), return_inverse=True)
    where[where == OTHER] = KNOWN + place
    occ = np.repeat(at, np.concatenate(count)).astype(np.int64) << 32 | where
    del at, where, place
    entries, entry = np.unique(occ, return_inverse=True)
    doc = np.concatenate(doc)
    counts = np.bincount(entry[(doc & _HELD) == 0], minlength=len(entries)).astype(np.uint32)
    row = (key[0].as_py(), _put(every), _put((entries >> 32).astype(np.uint32)), _put((entries & 0xFFFFFFFF).astype(np.uint32)),
           _put(counts), _put(others), _put(chunks), _put(cuts), _put(entry.astype(np.uint32)), _put(doc & ~_HELD))
    return pa.Table.from_batches([_batch([row], _STATE_NAMES, _STATE_KINDS)])


class Totals:
    """Totals of all restaurants after a sweep, but for the contexts without a number:
    ``c2, t2`` by numbered context, ``c1, t1`` by ending, ``c0, t0`` of the root, and the
    predictives of the frequent words by ending (``hot``) with their customers."""

    def __init__(self, c2, t2, c1, t1, t0, hot_c1, hot_t1, hot_t0, disc, base):
        self.c2, self.t2, self.c1 = c2, t2, c1
        hot_c0 = hot_t1.sum(1)
        self.t1 = t1 + hot_t1.sum(0)
        self.c0, self.t0 = float(self.t1.sum()), float(t0 + hot_t0.sum())
        s, self.disc, self.base = STRENGTH, disc, base
        self.hot_p0 = (hot_c0 - disc[0] * hot_t0 + (s[0] + disc[0] * self.t0) * base) / (s[0] + self.c0)
        self.hot_p1 = (hot_c1 - disc[1] * hot_t1 + (s[1] + disc[1] * self.t1)[None] * self.hot_p0[:, None]) / (s[1] + self.c1)[None]


class Dishes:
    """The three levels of one partition: words, (word, ending), (word, context).
    A partition of a frequent word takes the word's counts from all its partitions.
    Frequent words' upper levels are not local: they come with the totals."""

    def __init__(self, row: dict, often: Frequent):
        self.part, self.counted, self.seed = row["part"], True, [7, 0, row["part"] & (2**63 - 1)]
        self.at = None  # where the partition's own entries stand
        self.words = _get(row["words"], np.uint64)
        self.word = _get(row["entry_word"], np.uint32).astype(np.int32)
        self.ctx = _get(row["entry_ctx"], np.uint32).astype(np.int32)
        self.c2 = _get(row["counts"], np.uint32).astype(np.int64)
        self.others = _get(row["others"], np.uint64)
        if row.get("owner") is not None:
            every = sorted(row["everywhere"], key=lambda x: x["ctx"])
            own, self.ctx = self.ctx, np.array([x["ctx"] for x in every], np.int32)
            self.c2, self.word = np.array([x["c"] for x in every], np.int64), np.zeros(len(every), np.int32)
            self.at = np.searchsorted(self.ctx, own)
            self.seed, self.counted = [7, 1, int(self.words[0])], row["owner"] == row["part"]
        end = np.zeros(KNOWN + len(self.others), np.uint8)
        end[:len(often.known)] = often.known_end
        end[KNOWN:] = self.others & np.uint64(255)
        self.end2 = end[self.ctx]
        hot = often.hot_index(self.words)
        self.hot_word = hot
        self.hot = np.flatnonzero(hot[self.word] >= 0)  # entries of frequent words
        self.hot_of = hot[self.word[self.hot]]
        self.own = np.flatnonzero(hot[self.word] < 0).astype(np.int32)
        pair, up = np.unique(self.word[self.own].astype(np.int64) << 8 | self.end2[self.own], return_inverse=True)
        self.up = up.astype(np.int32)
        self.pair_word, self.end = pair >> 8, pair & 255
        self.t2 = np.minimum(self.c2, 1)
        self._raise()
        self.t1 = np.minimum(self.c1, 1)
        self._raise()
        self.t0 = np.minimum(self.c0, 1)

    def _raise(self):
        self.c1 = np.bincount(self.up, self.t2[self.own], len(self.pair_word)).astype(np.int64)
        t1 = getattr(self, "t1", np.minimum(self.c1, 1))
        self.c0 = np.bincount(self.pair_word, t1, len(self.words)).astype(np.int64)

    def parents(self, tot: Totals):
        """Root predictive of the words, and the endings' predictive of every entry."""
        s, disc = STRENGTH, tot.disc
        p0 = (self.c0 - disc[0] * self.t0 + (s[0] + disc[0] * tot.t0) * tot.base) / (s[0] + tot.c0)
        p1 = (self.c1 - disc[1] * self.t1 + (s[1] + disc[1] * tot.t1)[self.end] * p0[self.pair_word]) / (s[1] + tot.c1)[self.end]
        out = np.empty(len(self.word))
        out[self.own] = p1[self.up]
        out[self.hot] = tot.hot_p1[self.hot_of, self.end2[self.hot]]
        return p0, out

    def predictive(self, tot: Totals, c2: np.ndarray, t2: np.ndarray) -> np.ndarray:
        """Context predictives of all entries; ``c2, t2``: totals of this partition's contexts."""
        s, d = STRENGTH[2], tot.disc[2]
        p = self.parents(tot)[1]
        p *= (s + d * t2)[self.ctx]
        p += self.c2
        p -= d * self.t2
        p /= (s + c2)[self.ctx]
        return p

    def sweep(self, number: int, tot: Totals, t2: np.ndarray) -> None:
        """Seats all customers anew, contexts first; their tables sit above."""
        rng = np.random.default_rng([*self.seed, number])
        s, disc = STRENGTH, tot.disc
        p0, p1 = self.parents(tot)
        self.t2 = seat(self.c2, (s[2] + disc[2] * t2)[self.ctx] * p1, disc[2], rng)
        self.c1 = np.bincount(self.up, self.t2[self.own], len(self.pair_word)).astype(np.int64)
        self.t1 = seat(self.c1, (s[1] + disc[1] * tot.t1)[self.end] * p0[self.pair_word], disc[1], rng)
        self.c0 = np.bincount(self.pair_word, self.t1, len(self.words)).astype(np.int64)
        self.t0 = seat(self.c0, np.full(len(self.words), (s[0] + disc[0] * tot.t0) * tot.base), disc[0], rng)


def seat(c: np.ndarray, new: np.ndarray, disc: float, rng) -> np.ndarray:
    """Numbers of tables after seating c customers each; ``new`` is the weight of a new table."""
    t = np.minimum(c, 1)
    live, i = np.flatnonzero(c > 1), 1
    while len(live):
        step = 1 if i < 64 else i // 32
        p = new[live] / (new[live] + i - disc * t[live])
        t[live] += (rng.random(len(live)) < p) if step == 1 else rng.binomial(np.minimum(step, c[live] - i), p)
        i += step
        live = live[c[live] > i]
    return t


_SUMS = "kind int, at long, c long, t long, n1 long, n2 long, part long, bucket long, a binary, b binary, d binary"
_SUM_NAMES = [x.split()[0] for x in _SUMS.split(", ")]
_SUM_KINDS = (pa.int32(), *[pa.int64()] * 7, *[pa.binary()] * 3)
#: kinds of sums: root, endings, numbered contexts, (frequent word, ending), counts of frequent words, other contexts
ROOT, ENDING, CONTEXT, HOT_PAIR, HOT_WORD, OTHERS = range(6)


def _local(row: dict, d: Dishes, tots: list[Totals]):
    """Totals of the partition's contexts, numbered ones first: customers, and tables after
    every sweep so far."""
    c2 = np.zeros(KNOWN + len(d.others))
    c2[:KNOWN] = tots[0].c2
    t2 = []
    for k, tot in enumerate(tots):
        x = np.zeros(len(c2))
        x[:KNOWN] = tot.t2
        got = sorted(row.get(f"r{k}") or [], key=lambda v: v["bucket"])
        if got:
            if k == 0:
                c2[KNOWN:] = np.concatenate([_get(v["a"], np.uint32) for v in got])
            x[KNOWN:] = np.concatenate([_get(v["b"], np.uint32) for v in got])
        t2.append(x)
    return c2, t2


def _replay(d: Dishes, tots: list[Totals], t2: list[np.ndarray], sweeps: int):
    """Takes the partition through the first sweeps, one a turn."""
    for k in range(sweeps):
        d.sweep(k + 1, tots[k], t2[k])
        yield k + 1


def _rows(batches):
    """Rows one by one: a partition's row is large, a batch may hold several."""
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(k)[i].as_py() for k, c in enumerate(b.schema.names)}


def _sums(often: Frequent, tots: list[Totals], buckets: int):
    """Sums of one partition after sweep ``len(tots)`` (0: the first seating)."""
    def work(batches):
        for row in _rows(batches):
            d = Dishes(row, often)
            if tots:
                t2 = _local(row, d, tots)[1]
                for _ in _replay(d, tots, t2, len(tots)):
                    pass
                del t2
            if d.counted:
                yield from _sum_rows(d, often, not tots, buckets)
    return work


def _sum_rows(d: Dishes, often: Frequent, first: bool, buckets: int):
    """One batch of sums per level, and the rows of the contexts without a number."""
    def batch(kind, at, n, *values):
        cols = [np.bincount(at, v, n).astype(np.int64) for v in values]
        cols += [np.zeros(n, np.int64)] * (4 - len(cols))
        some = np.flatnonzero(np.any(cols, 0))
        m = len(some)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, kind, np.int32)), pa.array(some), *(pa.array(c[some]) for c in cols), pa.array(np.full(m, d.part)),
             pa.array(np.zeros(m, np.int64)), *[pa.nulls(m, pa.binary())] * 3], _SUM_NAMES)

    low = d.ctx < KNOWN
    yield batch(CONTEXT, d.ctx[low], KNOWN, d.c2[low], d.t2[low], *((d.c2[low] == k) for k in (1, 2) if first))
    yield batch(ENDING, d.end2, ENDINGS, d.t2)
    yield batch(ENDING, d.end, ENDINGS, np.zeros(len(d.end)), d.t1, *((d.c1 == k) for k in (1, 2) if first))
    yield batch(ROOT, np.zeros(len(d.words), np.int64), 1, d.c0, d.t0, *((d.c0 == k) for k in (1, 2) if first))
    yield batch(HOT_PAIR, d.hot_of << 8 | d.end2[d.hot], len(often.words) << 8, d.t2[d.hot])
    if first:
        yield batch(HOT_WORD, d.hot_of, len(often.words), d.c2[d.hot])
    if not len(d.others):
        return
    at = d.ctx[~low] - KNOWN
    c, t = (np.bincount(at, v[~low], len(d.others)).astype(np.uint32) for v in (d.c2, d.t2))
    cut = np.searchsorted(_spread(d.others, buckets), np.arange(buckets + 1))
    n1, n2 = (int((d.c2[~low] == k).sum()) if first else 0 for k in (1, 2))
    rows = []
    for k in np.flatnonzero(np.diff(cut)).tolist():
        x = slice(cut[k], cut[k + 1])
        keys, c_of = (_put(d.others[x]), _put(c[x])) if first else (None, None)
        rows.append((OTHERS, 0, int(c[x].sum()), 0, n1, n2, d.part, k, keys, c_of, _put(t[x])))
        n1 = n2 = 0  # told once
    yield _batch(rows, _SUM_NAMES, _SUM_KINDS)


_BACK = "part long, bucket long, a binary, b binary"


def _exchanged(key, table):
    """Totals of one bucket's contexts, for every partition that holds some of them: rows
    with keys tell which, rows with tables bring this sweep's."""
    keys, c, t = {}, {}, {}
    for r in table.to_pylist():
        if r["a"] is not None:
            keys[r["part"]] = _get(r["a"], np.uint64)
            c[r["part"]] = _get(r["b"], np.uint32)
        if r["d"] is not None:
            t[r["part"]] = _get(r["d"], np.uint32)
    every, at = np.unique(np.concatenate(list(keys.values())), return_inverse=True)
    cuts = np.append(0, np.cumsum([len(v) for v in keys.values()]))
    total = [np.bincount(at, np.concatenate([v[p] for p in keys]), len(every)).astype(np.uint32) for v in (c, t)]
    rows = [(p, key[0].as_py(), _put(total[0][at[x:y]]), _put(total[1][at[x:y]])) for p, x, y in zip(keys, cuts[:-1], cuts[1:])]
    return pa.Table.from_batches([_batch(rows, ["part", "bucket", "a", "b"], (pa.int64(), pa.int64(), pa.binary(), pa.binary()))])


def _answer(often: Frequent, tots: list[Totals], hot_counts: np.ndarray, burn_in: int):
    """Per chunk and text: sums of log10 predictives and of log10 (c + 0.5), known tokens."""
    def entries(row):
        """Of every entry: log10 of the mean predictive, log10 (c + 0.5), whether its word is known."""
        d = Dishes(row, often)
        c2, t2 = _local(row, d, tots)
        p, kept = 0.0, 0
        if len(tots) == 1:  # the first seating alone
            p, kept = d.predictive(tots[0], c2, t2[0]), 1
        for k in _replay(d, tots, t2, len(tots) - 1):
            if k > burn_in:
                p, kept = p + d.predictive(tots[k], c2, t2[k]), kept + 1
        del c2, t2
        p /= kept
        score = np.log10(p, out=p)
        c = np.bincount(d.word, d.c2, len(d.words))
        c = np.where(d.hot_word >= 0, hot_counts[d.hot_word] if len(hot_counts) else 0, c)
        at = slice(None) if d.at is None else d.at
        return score[at], np.log10(c + 0.5)[d.word][at], (c > 0)[d.word][at]

    def work(batches):
        for row in _rows(batches):
            values = entries({k: row.pop(k) for k in list(row) if k not in ("chunks", "cuts", "entry", "doc")})
            chunks, cuts, entry, doc = (_get(row.pop(x), k) for x, k in (("chunks", np.int64), ("cuts", np.int64), ("entry", np.uint32), ("doc", np.uint16)))
            out = []
            for chunk, x, y in zip(chunks.tolist(), cuts[:-1], cuts[1:]):
                e, t = entry[x:y], doc[x:y]
                n = int(t.max()) + 1
                has = np.flatnonzero(np.bincount(t, minlength=n))
                sums = [np.bincount(t, v[e], n)[has] for v in values]
                out.append((_ANSWER, chunk, _put(has.astype(np.uint16)), _put(sums[0]), _put(sums[1]), _put(sums[2].astype(np.uint32)), None))
                if len(out) == 32:
                    yield _batch(out, _BLOCK, _BLOCK_KINDS)
                    out = []
            if out:
                yield _batch(out, _BLOCK, _BLOCK_KINDS)
    return work


def _finish(train_tokens: int, types: int):
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def work(key, table):
        rows = table.to_pylist()
        head = next(r for r in rows if r["part"] != _ANSWER)
        ids, n = _get(head["a"], np.int64), _get(head["b"], np.int64)
        held, null = _get(head["c"], bool), _get(head["d"], bool)
        score, plain, known = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), np.int64)
        for r in rows:
            if r["part"] == _ANSWER:
                at = _get(r["a"], np.uint16)
                score[at] += _get(r["b"], np.float64)
                plain[at] += _get(r["c"], np.float64)
                known[at] += _get(r["d"], np.uint32)
        plain -= n * np.log10(train_tokens + 0.5 * (types + 1))
        cols = [pa.array(ids, mask=null), pa.array(held), pa.array(n), pa.array(known), pa.array(np.full(len(n), train_tokens)),
                pa.array(plain), pa.array(score)]
        return pa.Table.from_arrays([c.cast(k) for c, k in zip(cols, kinds)], names)

    return work


def _bucketed(df: DataFrame, scratch: Scratch, buckets: int) -> DataFrame:
    """``df`` as a table in buckets of ``part``: joins by part move the other side only."""
    name = f"lm_state_{uuid.uuid4().hex[:12]}"
    (df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "part").option("path", f"{scratch.root}/{name}")
     .saveAsTable(name))
    return df.sparkSession.table(name)


def _totals(sums, often: Frequent, before: Totals | None, number: int, disc=None, base: float = 1.0) -> Totals:
    """Totals of a sweep from its added-up sums. Seats the frequent words' upper levels."""
    def vec(kind, col, n):
        x = np.zeros(n)
        r = sums[sums.kind == kind]
        x[r["at"].to_numpy(np.int64)] = r[col].to_numpy(float)
        return x

    hot_c1 = vec(HOT_PAIR, "c", len(often.words) << 8).reshape(-1, ENDINGS).astype(np.int64)
    if before is None:
        hot_t1 = np.minimum(hot_c1, 1)
        hot_t0 = np.minimum(hot_t1.sum(1), 1)
    else:
        rng, s = np.random.default_rng([7, 2, number]), STRENGTH
        new = (s[1] + disc[1] * before.t1)[None] * before.hot_p0[:, None]
        hot_t1 = seat(hot_c1.ravel(), new.ravel(), disc[1], rng).reshape(hot_c1.shape)
        hot_t0 = seat(hot_t1.sum(1), np.full(len(hot_t1), (s[0] + disc[0] * before.t0) * base), disc[0], rng)
    c2 = vec(CONTEXT, "c", KNOWN) if before is None else before.c2
    return Totals(c2, vec(CONTEXT, "t", KNOWN), vec(ENDING, "c", ENDINGS), vec(ENDING, "t", ENDINGS), vec(ROOT, "t", 1)[0],
                  hot_c1, hot_t1, hot_t0, disc, base)


def _discounts(sums, hot_c1: np.ndarray) -> list[float]:
    """Discounts of root, endings and contexts from the numbers of single and double customers."""
    n = {k: np.zeros(2) for k in (ROOT, ENDING, CONTEXT)}
    for kind, n1, n2 in sums[["kind", "n1", "n2"]].itertuples(index=False):
        if kind in (ROOT, ENDING, CONTEXT, OTHERS):
            n[CONTEXT if kind == OTHERS else kind] += (n1, n2)
    for level, c in ((ENDING, hot_c1.ravel()), (ROOT, np.minimum(hot_c1, 1).sum(1))):
        n[level] += ((c == 1).sum(), (c == 2).sum())
    return [float(min(0.95, max(0.05, a / max(1, a + 2 * b)))) for a, b in (n[ROOT], n[ENDING], n[CONTEXT])]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: str | None = None,
                burn_in: int = BURN_IN, samples: int = SAMPLES, numbered: int = KNOWN) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    ``held_out``: SQL condition on ``id`` of texts that the model does not learn from.
    ``burn_in, samples``: sweeps before the kept ones and kept ones; both 0: the first
    seating, one table a dish, is the model."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lm")
    cond = held_out or "crc32(cast(coalesce(cast(id as string), '') as binary)) % 5 = 1"
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("out", F.expr(cond))
    size = texts.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    parts = int((size.b or 0) // PART_BYTES) + 1
    often = Frequent(texts, size.n, (size.b or 0) / 4, numbered)
    blocks = texts.mapInArrow(_blocks(parts, often), _BLOCK_SCHEMA)
    # one pass over the texts: all blocks travel to their partitions; a chunk's head is a part below 0
    merged = blocks.groupBy("part").applyInArrow(
        lambda key, t: _heads(t) if key[0].as_py() < 0 else _merge(key, t), _STATE)
    state = _bucketed(merged, scratch, parts)
    heads = state.where("part < 0")
    own = state.where(F.col("part").between(0, parts - 1)).withColumns(
        {"owner": F.lit(None).cast("long"), "everywhere": F.lit(None).cast("array<struct<ctx:int,c:long>>")})
    frequent = None
    if len(often.words):
        frequent = scratch.put(_shared_counts(state.where(F.col("part") >= parts)), "frequent")
    core = ["part", "words", "entry_word", "entry_ctx", "counts", "others", "owner", "everywhere"]
    back: list[DataFrame] = []  # totals of the contexts without a number, by partition, after every sweep

    def dishes(cols: list[str]) -> DataFrame:
        out, other = own.select(*cols), frequent.select(*cols) if frequent is not None else None
        for k, totals in enumerate(back):
            out = out.join(totals.withColumnRenamed("r", f"r{k}").hint("shuffle_hash"), "part", "left")
        if other is None:
            return out
        empty = F.lit(None).cast("array<struct<bucket:long,a:binary,b:binary>>")
        return out.unionByName(other.withColumns({f"r{k}": empty for k in range(len(back))}))

    tots: list[Totals] = []
    places = None
    for number in range(burn_in + samples + 1):
        sums = scratch.put(dishes(core).mapInArrow(_sums(often, tots, parts), _SUMS), f"sums{number}")
        small = (sums.groupBy("kind", "at").agg(*[F.sum(c).alias(c) for c in ("c", "t", "n1", "n2")])
                 .toPandas())  # at most KNOWN contexts, 256 endings and (frequent words x 257) rows
        others = sums.where(F.col("kind") == OTHERS).select("part", "bucket", "a", "b", "d")
        if number == 0:
            places = others.select("part", "bucket", "a", "b", F.lit(None).cast("binary").alias("d"))
            hot_counts = np.zeros(len(often.words))
            r = small[small.kind == HOT_WORD]
            hot_counts[r["at"].to_numpy(np.int64)] = r["c"].to_numpy(float)
            hot_c1 = np.zeros(len(often.words) << 8, np.int64)
            r = small[small.kind == HOT_PAIR]
            hot_c1[r["at"].to_numpy(np.int64)] = r["c"].to_numpy(np.int64)
            disc = _discounts(small, hot_c1.reshape(-1, ENDINGS))
            train_tokens = int(small[small.kind.isin([CONTEXT, OTHERS])]["c"].sum())
            types = int(small[small.kind == ROOT]["t"].sum() + (hot_counts > 0).sum())
            base = 1.0 / (types + 1)
        tots.append(_totals(small, often, tots[-1] if tots else None, number, disc, base))
        moved = others if number == 0 else others.unionByName(places)
        totals = moved.groupBy("bucket").applyInArrow(_exchanged, _BACK)
        back.append(scratch.put(totals.groupBy("part").agg(F.collect_list(F.struct("bucket", "a", "b")).alias("r")), f"totals{number}"))
    answers = dishes([*core, "chunks", "cuts", "entry", "doc"]).mapInArrow(_answer(often, tots, hot_counts, burn_in), _BLOCK_SCHEMA)
    texts_of = heads.select("part", (-1 - F.col("part")).alias("chunk"), F.col("words").alias("a"), F.col("entry_word").alias("b"),
                            F.col("entry_ctx").alias("c"), F.col("counts").alias("d"), F.col("others").alias("e"))
    out = answers.unionByName(texts_of).groupBy("chunk").applyInArrow(
        _finish(train_tokens, types), "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def _shared_counts(frequent: DataFrame) -> DataFrame:
    """Partitions of frequent words, each with the word's counts from all of them."""
    def work(batches):
        for b in batches:
            for row in b.to_pylist():
                ctx, c = _get(row["entry_ctx"], np.uint32), _get(row["counts"], np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ctx), row["part"])), pa.array([row["words"]] * len(ctx)),
                                                  pa.array(ctx.astype(np.int32)), pa.array(c.astype(np.int64))], ["part", "words", "ctx", "c"])

    each = frequent.select("part", "words", "entry_ctx", "counts").mapInArrow(work, "part long, words binary, ctx int, c long")
    counts = each.groupBy("words", "ctx").agg(F.sum("c").alias("c"), F.min("part").alias("p"))
    per = counts.groupBy("words").agg(F.min("p").alias("owner"), F.collect_list(F.struct("ctx", "c")).alias("everywhere"))
    # by word only the partitions' numbers travel; their occurrences are joined by partition
    shared = frequent.select("part", "words").join(per, "words").select("part", "owner", "everywhere")
    return frequent.join(shared, "part")


def _heads(table):
    """A chunk's texts as they came, in the columns of the state."""
    r = table.to_pylist()[0]
    row = (r["part"], r["a"], r["b"], r["c"], r["d"], r["e"], *[None] * 4)
    return pa.Table.from_batches([_batch([row], _STATE_NAMES, _STATE_KINDS)])
