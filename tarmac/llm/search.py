"""Exact BM25 top-k by an inverted index with block-max pruning, per shard.

A shard is the inverted index of some documents, built where they are read and written
in pieces. It orders its documents by their most frequent word and length (so that a
block holds texts of one kind), cuts them into blocks of ``BLOCK`` and keeps, for every
term, postings with their exact BM25 contribution. The shard's most frequent terms lie
in a table (document x term) with the largest contribution in each block. Contributions
use global statistics (document count, mean length, document frequencies), so scores of
different shards compare and the merge of the shards' top k is the global top k.

A query adds up the lists of its rarer terms; a document's bound is that sum and its
block's maxima of the query's frequent terms. A block without a bound that reaches the
threshold is not opened (a bound equal to it is, so ties are exact). A query that opens
many blocks is scored on the whole table in short numbers, and what may reach the
threshold, by a bound of their rounding, is scored again. No document above it is missed.

Queries go to the shards by a nested loop over the two written tables, which writes
nothing: no row is kept for a (query, shard). The first shards, about the root of their
number, are searched before the others, whose answers begin at the k-th best score found
there, so their rows do not grow with shards x queries either.

A query is the set of its distinct words. Rank: score rounded to 6 digits, larger
first, then smaller id. Edge cases: a null or empty text, or one without words,
matches nothing and as a query gives no rows; a null id is found under null and,
as a query, ignored; two rows of one query id are one query; repeated rows are documents
of their own; fewer than k matches give fewer rows; empty tables give an empty result;
other columns are ignored. Terms are compared by 64-bit hashes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm import textops
from tarmac.llm.base import Scratch

K1, B = 1.2, 0.75
BLOCK = 128
#: bytes of terms in a shard
SHARD_BYTES = 28 << 20
#: the table of a shard holds terms of at least this share of its documents, so many at most
OFTEN, COLUMNS = 0.1, 1024
#: queries, and about terms, of a chunk; bytes of chunks that a task passes by its shards
CHUNK_QUERIES, CHUNK_TERMS, GROUP_BYTES = 1024, 1 << 20, 32 << 20
#: tasks of shards from which the first ones are searched before the others
EARLY_TASKS = 9
#: scores that differ by less may be equal when rounded
TIE = 2e-6
#: a query of whose blocks more than one in so many are open is scored on the whole table, so many queries at a time
OPEN, WHOLE = 8, 128
_NULL = -(1 << 63)  # stands for a null id inside a shard


def _pack(batches):
    """Distinct word hashes (sorted) and their counts of every text."""
    for b in batches:
        ids = b.column(0).to_pylist()
        for lo, hi, data, offs in textops.slices(b.column(1)):
            words, rows = textops.word_hashes(data, offs)
            out = []
            for i, a, e in zip(ids[lo:hi], rows[:-1].tolist(), rows[1:].tolist()):
                t, n = np.unique(words[a:e], return_counts=True)
                out.append((i, e - a, t.tobytes(), n.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["id", "words", "terms", "tfs"])


PACKED = "id long, words long, terms binary, tfs binary"


def _terms(batches):
    """(term, number of texts) of a task's texts, summed as far as memory allows."""
    held: list[np.ndarray] = []

    def flush():
        t, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])

    size = 0
    for b in batches:
        for raw in b.column(0):
            held.append(np.frombuffer(raw.as_py(), np.uint64))
            size += len(held[-1])
        if size > 4_000_000:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


#: postings that a shard turns into contributions at a time
PART = 1 << 18


def _inverted(ids, words, terms: list, tfs: list) -> tuple[np.ndarray, ...]:
    """(ids, words, terms, start, doc, tf) of an inverted index over packed documents. ``terms``
    and ``tfs`` (an array per document) are emptied once they are copied, and positions are
    32-bit, so that little more than the postings is held."""
    top = [t[n.argmax()] if len(t) else 0 for t, n in zip(terms, tfs)]
    words = np.asarray(words, np.int64)
    order = np.lexsort((words, np.array(top, np.uint64)))
    sizes = np.array([len(terms[i]) for i in order], np.int64)
    t = np.concatenate([terms[i] for i in order] or [np.empty(0, np.uint64)])
    tf = np.concatenate([tfs[i] for i in order] or [np.empty(0, np.uint32)])
    tf = tf.astype(np.min_scalar_type(tf.max(initial=0)))
    terms.clear()
    tfs.clear()
    by = np.argsort(t, kind="stable").astype(np.int32)
    t = t[by]
    tf = tf[by]
    doc = np.repeat(np.arange(len(order), dtype=np.int32), sizes)[by]
    del by
    first = np.ones(len(t), bool)
    if len(t):
        np.not_equal(t[1:], t[:-1], out=first[1:])
    start = np.flatnonzero(first).astype(np.int32)
    return np.asarray(ids, np.int64)[order], words[order], t[start], np.append(start, np.int32(len(t))), doc, tf


class Shard:
    """Inverted index over packed documents; contributions lack the idf factor."""

    def __init__(self, ids, words, terms: list, tfs: list, mean_words: float):
        self._open(*_inverted(ids, words, terms, tfs), mean_words)

    @classmethod
    def of(cls, pieces: list, mean_words: float) -> Shard:
        """The shard of its rows in the written index."""
        arrays = _arrays_of(pieces, lambda docs, terms, postings, width: (
            (docs, "<i8"), (docs, "<i8"), (terms, "<u8"), (terms + 1, "<i4"), (postings, "<i4"), (postings, f"<u{width}")))
        shard = cls.__new__(cls)
        shard._open(*arrays, mean_words)
        return shard

    def _open(self, ids, words, terms, start, doc, tf, mean_words: float):
        self.ids, self.terms, self.start, self.doc = ids, terms, start.astype(np.int64), doc
        self.blocks = int(-(-len(ids) // BLOCK))
        length, mean = words.astype(np.float64), max(mean_words, 1e-12)
        self.gain = np.empty(len(tf))
        for a in range(0, len(tf), PART):
            n = tf[a:a + PART].astype(np.float64)
            self.gain[a:a + PART] = n * (K1 + 1) / (n + K1 * (1 - B + B * length[doc[a:a + PART]] / mean))
        # the table takes two numbers per posting at most
        count = np.diff(self.start)
        often = np.flatnonzero(count >= max(1, OFTEN * len(ids)))
        width = min(COLUMNS, 2 * len(doc) // max(1, self.blocks * BLOCK))
        often = often[np.argsort(-count[often], kind="stable")[:width]]
        self.column = np.full(len(terms), -1, np.int32)
        self.column[often] = np.arange(len(often))
        self.table = np.zeros((self.blocks * BLOCK, len(often)))
        for c, t in enumerate(often.tolist()):
            of = slice(self.start[t], self.start[t + 1])
            self.table[doc[of], c] = self.gain[of]
        self.most = self.table.reshape(self.blocks, BLOCK, len(often)).max(1)
        self.narrow = self.table.astype(np.float32)

    def search_all(self, terms: np.ndarray, idf: np.ndarray, at: np.ndarray, cuts: np.ndarray, least: np.ndarray, k: int):
        """(query, documents, scores) with the top k of this shard for every query. Query ``i``
        has the terms ``terms[at[cuts[i]:cuts[i + 1]]]``, and no score under ``least[i]`` is needed."""
        if not len(self.terms):
            return
        place = np.searchsorted(self.terms, terms)
        place[place == len(self.terms)] = 0
        known = self.terms[place] == terms
        column = np.where(known, self.column[place], -1)
        weight = np.zeros((len(cuts) - 1, self.table.shape[1]))
        number, c = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), column[at]
        hit = np.flatnonzero(c >= 0)
        weight[number[hit], c[hit]] = idf[at[hit]]
        bounds = weight @ self.most.T
        hit = np.flatnonzero((known & (column < 0))[at])  # the lists of the rarer terms
        ends = np.searchsorted(hit, cuts).tolist()
        at = at[hit]
        start, idf = self.start[place[at]], idf[at]
        size = self.start[place[at] + 1] - start
        whole: list[tuple[int, np.ndarray, float]] = []
        for i, (a, e) in enumerate(zip(ends[:-1], ends[1:])):
            n = size[a:e]
            post = np.repeat(start[a:e] - np.cumsum(n) + n, n)
            post += np.arange(len(post))
            gain = self.gain.take(post)
            gain *= np.repeat(idf[a:e], n)
            some = np.bincount(self.doc.take(post), gain, len(self.table)).reshape(-1, BLOCK)
            low = max(float(least[i]) - TIE, 1e-300)
            block = np.flatnonzero(some.max(1) + bounds[i] >= low)
            if OPEN * len(block) <= self.blocks:
                chosen = np.flatnonzero(some[block] + bounds[i][block, None] >= low)
                chosen += (block[chosen // BLOCK] - chosen // BLOCK) * BLOCK
                yield i, *self._scored(some.ravel(), weight[i], chosen, low)
                continue
            whole.append((i, some.ravel(), low))
            if len(whole) == WHOLE:
                yield from self._whole(whole, weight, k)
                whole = []
        yield from self._whole(whole, weight, k)

    def _whole(self, queries, weight: np.ndarray, k: int):
        """Scores of all documents, in short numbers; those that may reach the threshold are scored again."""
        dense = weight[[i for i, _, _ in queries]].astype(np.float32) @ self.narrow.T
        for (i, some, low), short in zip(queries, dense):
            # a sum of positive products errs by a share of itself
            slack = 1.1 * (weight.shape[1] + 8) * 2.0 ** -24 * float(short.max(initial=0))
            score = short + some
            if low == 1e-300 and len(score) > k:
                low = max(low, np.partition(score, len(score) - k)[len(score) - k] - slack - TIE)
            yield i, *self._scored(some, weight[i], np.flatnonzero(score >= max(low - slack, 1e-300)), low)

    def _scored(self, some, weight, chosen, low):
        score = some[chosen] + self.table[chosen] @ weight
        keep = np.flatnonzero(score >= low)
        return self.ids[chosen[keep]], score[keep]

    def search(self, terms: np.ndarray, idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that contain the top k of this shard for one query."""
        for _, ids, scores in self.search_all(terms, idf, np.arange(len(terms)), np.array([0, len(terms)]), np.array([-np.inf]), k):
            return ids, scores
        return np.empty(0, np.int64), np.empty(0)


def _pieces(column: pa.Array, dtype: str) -> list[np.ndarray]:
    """Every value of a binary column as numbers, in the batch's own memory."""
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    wide = np.dtype(np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    at = np.frombuffer(offsets, wide, len(column) + 1, wide.itemsize * column.offset).tolist()
    whole = memoryview(data) if data is not None else memoryview(b"")
    return [np.frombuffer(whole[a:e], dtype) for a, e in zip(at[:-1], at[1:])]


#: written bytes go in rows of pieces, so that no row is large
PIECE = 256 << 10


def _pieces_of(arrays: list, sizes: list[int]) -> list[bytes]:
    """The bytes of ``sizes`` and some arrays, cut into pieces."""
    whole = memoryview(b"".join([np.array(sizes, np.int64), *(memoryview(np.ascontiguousarray(a)).cast("B") for a in arrays if a.nbytes)]))
    return [bytes(whole[a:a + PIECE]) for a in range(0, len(whole), PIECE)]


def _arrays_of(pieces: list[bytes], kinds) -> list[np.ndarray]:
    """The arrays of some pieces; ``kinds`` says their lengths and types by the first four numbers."""
    whole, at, out = b"".join(pieces), 4 * 8, []
    for n, kind in kinds(*np.frombuffer(whole, np.int64, 4).tolist()):
        out.append(np.frombuffer(whole, kind, n, at))
        at += out[-1].nbytes
    return out


#: rows of an index: a shard's pieces, then its mark
INDEX = "task long, mark boolean, data binary"


def _index(batches):
    """The shards of a task's packed documents: of ``SHARD_BYTES`` of terms, the last of half to one and a half."""
    task = TaskContext.get().partitionId()
    held: list[tuple] = []  # (id, words, terms, tfs)

    def rows(docs):
        ids, words, terms, tfs = (list(c) for c in zip(*docs))
        docs.clear()
        arrays = _inverted(ids, words, terms, tfs)
        pieces = _pieces_of(arrays, [len(arrays[0]), len(arrays[2]), len(arrays[4]), arrays[5].itemsize])
        del arrays
        for value in [*pieces, None]:
            yield pa.RecordBatch.from_arrays([pa.array([task]), pa.array([value is None]), pa.array([value], pa.binary())], ["task", "mark", "data"])

    size = 0
    for b in batches:
        for d in zip(b.column("id").fill_null(_NULL).to_pylist(), b.column("words").to_pylist(),
                     _pieces(b.column("terms"), "<u8"), _pieces(b.column("tfs"), "<u4")):
            held.append(d)
            size += d[2].nbytes
            if 2 * size >= 3 * SHARD_BYTES:
                n, size = 0, 0
                while n < len(held) and size < SHARD_BYTES:
                    size += held[n][2].nbytes
                    n += 1
                first, held = held[:n], held[n:]
                yield from rows(first)
                size = sum(x[2].nbytes for x in held)
    if held:
        yield from rows(held)


#: rows of chunks of queries: their pieces, the last one marked
CHUNKS = "last boolean, data binary"


def _chunk(pieces: list[bytes]) -> list[np.ndarray]:
    """(queries, cuts, least, terms, idf, at) of a chunk, as ``Shard.search_all`` takes them."""
    return _arrays_of(pieces, lambda queries, terms, places, _: (
        (queries, "<i8"), (queries + 1, "<i8"), (queries, "<f8"), (terms, "<u8"), (terms, "<f8"), (places, "<i4")))


def _chunks(batches):
    """Queries in chunks: distinct terms with their idf, and the places of each query's terms in them."""
    held: list[tuple] = []

    def rows():
        i, terms, idf, least = zip(*held)
        names, first, at = np.unique(np.concatenate(terms), return_index=True, return_inverse=True)
        cuts = np.append(0, np.cumsum([len(t) for t in terms])).astype("<i8")
        pieces = _pieces_of([np.array(i, "<i8"), cuts, np.array(least, "<f8"), names, np.concatenate(idf)[first], at.astype("<i4")],
                            [len(i), len(names), len(at), 0])
        for n, value in enumerate(pieces, 1):
            yield pa.RecordBatch.from_arrays([pa.array([n == len(pieces)]), pa.array([value], pa.binary())], ["last", "data"])

    size = 0
    for b in batches:
        for q in zip(b.column("id").to_pylist(), _pieces(b.column("terms"), "<u8"), _pieces(b.column("idf"), "<f8"),
                     b.column("least").fill_null(-np.inf).to_pylist()):
            held.append(q)
            size += len(q[1])
            if len(held) == CHUNK_QUERIES or size >= CHUNK_TERMS:
                yield from rows()
                held, size = [], 0
    if held:
        yield from rows()


def _search(mean_words: float, k: int):
    def work(batches):
        """Rows are a shard's pieces, then the chunks of queries that it answers, then the next shard."""
        pieces, asked, shard = [], [], None
        for b in batches:
            for n in range(b.num_rows):
                if b.column("data")[n].is_valid:
                    if shard is not None:
                        pieces, shard = [], None
                    pieces.append(b.column("data")[n].as_py())
                    continue
                if shard is None:
                    shard, pieces = Shard.of(pieces, mean_words), []
                asked.append(b.column("asked")[n].as_py())
                if not b.column("last")[n].as_py():
                    continue
                q, cuts, least, names, idf, at = _chunk(asked)
                asked = []
                out = []
                for i, found, score in shard.search_all(names, idf, at, cuts, least, k):
                    score = np.round(score, 6)
                    best = np.lexsort((found, -score))[:k]
                    out.append((np.full(len(best), q[i]), found[best], score[best]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "id", "score"])
    return work


#: for tables whose files are read whole, one after the other, and go to Python in small batches
READ_WHOLE = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
              "spark.sql.files.maxRecordsPerFile": "0", "spark.sql.parquet.columnarReaderBatchSize": "16",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def _scan(index: DataFrame, chunks: DataFrame, groups: int, mean_words: float, k: int) -> DataFrame:
    """``query_id, id, score``: k rows at most for every shard and query. A nested loop over the two
    written tables: a shard's pieces meet the first of a task's chunks only, its mark meets them all."""
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # of a row in its partition
    right = chunks.coalesce(groups).select((number == 0).alias("first"), "last", F.col("data").alias("asked"))
    both = index.select("mark", "data").hint("shuffle_replicate_nl").join(right, F.col("mark") | F.col("first"))
    return both.select("data", "last", F.when(F.col("mark"), F.col("asked")).alias("asked")).mapInArrow(
        _search(mean_words, k), "query_id long, id long, score double")


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
          shards: int | None = None) -> DataFrame:
    """``query_id, rank, id_col, score``: the k best documents of every query
    ``queries (query_id, text)``. ``shards``: tasks that documents are dealt to, else by their size."""
    spark = docs.sparkSession
    scratch, whole = Scratch(spark, "search"), spark.newSession()
    for name, value in READ_WHOLE.items():
        whole.conf.set(name, value)
    again = lambda df, session: session.read.schema(df.schema).parquet(df._scratch)
    cols = lambda df, i, t: df.select(F.col(i).cast("long").alias("id"), F.col(t).cast("string").alias("text"))
    packed = scratch.put(cols(docs, id_col, text_col).mapInArrow(_pack, PACKED), "packed")
    stat = packed.agg(F.count("*").alias("n"), F.avg("words").alias("mean"), F.sum(F.length("terms")).alias("b")).first()
    n, mean = int(stat.n), float(stat.mean or 0)
    asked = scratch.put(cols(queries, "query_id", text_col).where("id is not null").mapInArrow(_pack, PACKED).where("words > 0"), "asked")

    def each(batches):
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), i, np.int64)), pa.array(t)], ["id", "term"])

    want = asked.select("id", "terms").mapInArrow(each, "id long, term long")
    df = packed.select("terms").mapInArrow(_terms, "term long, n long").join(
        want.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = (want.distinct().join(df, "term").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", idf.alias("idf")))).alias("t")))

    def bits(batches):
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                term = np.array([x["term"] for x in t], np.int64).view(np.uint64)
                w = np.array([x["idf"] for x in t], np.float64)
                out.append((i, term.tobytes(), w.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, (
                pa.int64(), pa.binary(), pa.binary()))], ["id", "terms", "idf"])

    ask = scratch.put(weighted.mapInArrow(bits, "id long, terms binary, idf binary"), "queries")
    docs = again(packed, whole)
    dealt = docs.repartition(shards) if shards else docs.coalesce(int((stat.b or 0) // SHARD_BYTES) + 1)
    index = again(scratch.put(dealt.mapInArrow(_index, INDEX), "index"), whole)
    scratch.drop(packed, asked)

    def scan(some: DataFrame, asking: DataFrame, name: str) -> DataFrame:
        chunks = scratch.put(asking.mapInArrow(_chunks, CHUNKS), "chunks")
        size = chunks.agg(F.sum(F.length("data"))).first()[0] or 0
        return again(scratch.put(_scan(some, again(chunks, whole), int(size // GROUP_BYTES) + 1, mean, k), name), spark)

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    tasks = (index.agg(F.max("task")).first()[0] or 0) + 1
    early = math.isqrt(tasks) if tasks >= EARLY_TASKS else tasks
    found = scan(index.where(F.col("task") < early), ask.withColumn("least", F.lit(None).cast("double")), "early")
    if early < tasks:
        least = found.withColumn("rank", rank).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
        found = found.unionByName(scan(index.where(F.col("task") >= early), ask.join(least, "id", "left"), "others"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("long").alias("rank"), F.when(F.col("id") != _NULL, F.col("id")).alias(id_col), "score"))
