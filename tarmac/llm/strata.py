"""Exact ranked lexical search by a length-stratified index.

A term is a run of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
With N documents that hold a term, L terms in all, n terms in a document, document
frequency df and tf occurrences in the document,

    w     = floor(1000 * ln((2 N + 2) / (2 df + 1)))           of a term, in doubles
    m     = 75 + (25 n N) div L                                of a document
    score = sum over the query's terms, repeats included, of
            w * ((1000000000 tf) div (1000 tf + 12 m))         64-bit integers

m takes few values, so documents of equal m form a stratum. ``build`` writes the index
as a table with one row per stratum and shard: the stratum's documents, its terms, for
every term the runs of equal tf, largest tf first, and each run's documents. Within a
stratum an impact hangs on tf alone; it is computed once for a run.

``search`` adds up, per query and stratum, the impacts of its terms' largest tf: no
document of the stratum scores more. Strata are visited by that bound in falling order;
one whose bound is below the k-th best score so far is never opened (an equal one is,
so ties are exact). Every task returns its k best documents of each query, and the k
best of those are the result: m and w are global, so scores of different shards compare.

On Spark: strata are cut by a hash of the documents into cells of about ``CELL_BYTES``,
and cells are dealt over shards of about ``SHARD_BYTES``, so a stratum that holds a
third of all documents is many cells. Queries travel to the tasks in batches of about
``QUERY_BYTES``; more queries take more passes over the index. No document is sampled,
cut or left out.

Edge cases: documents without terms (null, empty, only separators) count neither in N
nor as results; an item without known terms gives no rows; a null document id is
returned as null and loses ties; repeated rows are documents (and items) of their own;
very long texts make strata of their own; empty tables give an empty result; other
columns are ignored, whatever their names. Terms are compared by 64-bit hashes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm import textops
from tarmac.llm.base import Scratch, runs
from tarmac.operators.sizing import broadcast_if_bounded

K = 20
#: bytes of packed terms in a shard, and in a cell of a stratum
SHARD_BYTES = 32 << 20
CELL_BYTES = 1 << 20
#: bytes of packed queries that one pass carries
QUERY_BYTES = 16 << 20
#: bytes of index rows that a task searches at a time
SEARCH_BYTES = 24 << 20

PACKED = "id long, n long, terms binary, tfs binary"
INDEX = "m long, ids binary, known binary, terms binary, first_run binary, run_tf binary, run_start binary, docs binary"


def _pack(batches):
    """Number of terms, distinct term hashes (sorted) and their counts of every text."""
    for b in batches:
        ids = b.column(0).to_pylist()
        for lo, hi, data, offs in textops.slices(b.column(1)):
            words, rows = textops.word_hashes(data, offs, textops.TERMS)
            out = []
            for i, a, e in zip(ids[lo:hi], rows[:-1].tolist(), rows[1:].tolist()):
                t, n = np.unique(words[a:e], return_counts=True)
                out.append((i, e - a, t.tobytes(), n.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["id", "n", "terms", "tfs"])


def _stratum(batches):
    """Rows sorted by m -> one index row per m of the task."""
    for t in runs(batches, ["m"]):
        t = t.combine_chunks()
        terms = [np.frombuffer(x, np.uint64) for x in t["terms"].to_pylist()]
        term = np.concatenate(terms)
        tf = np.frombuffer(b"".join(t["tfs"].to_pylist()), "<u4")
        doc = np.repeat(np.arange(len(terms), dtype=np.int32), [len(x) for x in terms])
        by = np.lexsort((-tf.astype(np.int64), term))
        term, tf, doc = term[by], tf[by], doc[by]
        new = np.ones(len(term), bool)
        new[1:] = term[1:] != term[:-1]
        run = new.copy()
        run[1:] |= tf[1:] != tf[:-1]
        start = np.flatnonzero(run)
        first = np.append(np.flatnonzero(new[start]), len(start))
        ids = t["id"].to_pylist()
        row = (t["m"][0].as_py(), np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids], np.uint8),
               term[new], first.astype(np.int32), tf[start], np.append(start, len(term)).astype(np.int64), doc)
        yield pa.RecordBatch.from_arrays([pa.array([row[0]]), *(pa.array([x.tobytes()], pa.binary()) for x in row[1:])],
                                         [c.split()[0] for c in INDEX.split(", ")])


def impact(tf, m):
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Stratum:
    """One row of the index; impacts of its runs are computed here, once."""

    def __init__(self, row: dict):
        read = lambda c, t: np.frombuffer(row[c], t)
        self.ids, self.known, self.terms = read("ids", np.int64), read("known", np.uint8), read("terms", np.uint64)
        self.first, self.start, self.docs = read("first_run", np.int32), read("run_start", np.int64), read("docs", np.int32)
        self.impact = impact(read("run_tf", np.uint32).astype(np.int64), row["m"])

    def score(self, term_at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of all documents for the terms at these places of ``terms``."""
        out = np.zeros(len(self.ids), np.int64)
        for t, w in zip(term_at.tolist(), weight.tolist()):
            a, b = self.first[t], self.first[t + 1]
            begin, end = self.start[a], self.start[b]
            # a document holds a term once, so no place is added to twice
            out[self.docs[begin:end]] += np.repeat(self.impact[a:b] * w, np.diff(self.start[a:b + 1]))
        return out


#: (scores, ids, known) of no document
NOTHING = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint8))


class Shard:
    """Some strata of a task, with the largest impact of every (term, stratum)."""

    def __init__(self, strata: list[Stratum]):
        self.strata = strata
        term = np.concatenate([s.terms for s in strata])
        place = np.concatenate([np.arange(len(s.terms)) for s in strata])
        best = np.concatenate([s.impact[s.first[:-1]] for s in strata])
        number = np.repeat(np.arange(len(strata)), [len(s.terms) for s in strata])
        by = np.argsort(term, kind="stable")
        self.term, self.place, self.best, self.number = term[by], place[by], best[by], number[by]
        self.opened = self.seen = 0

    def search(self, terms: np.ndarray, weight: np.ndarray, k: int, best=NOTHING):
        """(scores, ids, known) of the k best documents of these strata and of ``best``."""
        a, b = np.searchsorted(self.term, terms, "left"), np.searchsorted(self.term, terms, "right")
        n = b - a
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        w, number = np.repeat(weight, n), self.number[at]
        bound = np.zeros(len(self.strata), np.int64)
        np.add.at(bound, number, w * self.best[at])
        by = np.argsort(number, kind="stable")
        w, number, place = w[by], number[by], self.place[at][by]
        cut = np.searchsorted(number, np.arange(len(self.strata) + 1))
        least = int(best[0].min()) if len(best[0]) >= k else 1
        for s in np.argsort(-bound, kind="stable").tolist():
            if bound[s] < least:
                break
            mine = slice(cut[s], cut[s + 1])
            st = self.strata[s]
            score = st.score(place[mine], w[mine])
            hit = np.flatnonzero(score >= least)
            best = tuple(np.concatenate(x) for x in zip(best, (score[hit], st.ids[hit], st.known[hit])))
            self.opened += 1
            if len(best[0]) > k:
                order = np.lexsort((best[1], 1 - best[2], -best[0]))[:k]
                best = tuple(x[order] for x in best)
            if len(best[0]) >= k:
                least = int(best[0].min())
        self.seen += int((bound > 0).sum())
        return best


def _search(queries: list[tuple[int, bytes, bytes]], k: int):
    def work(batches):
        best = [NOTHING] * len(queries)
        held, size = [], 0

        def visit():
            shard = Shard([Stratum(r) for r in held])
            for n, (_, terms, weight) in enumerate(queries):
                best[n] = shard.search(np.frombuffer(terms, np.uint64), np.frombuffer(weight, np.int64), k, best[n])

        for b in batches:
            for i in range(b.num_rows):
                held.append({c: b.column(c)[i].as_py() for c in b.schema.names})
                size += sum(len(v) for v in held[-1].values() if isinstance(v, bytes))
                if size > SEARCH_BYTES:
                    visit()
                    held, size = [], 0
        if held:
            visit()
        for (q, _, _), (score, ids, known) in zip(queries, best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), q)), pa.array(ids, mask=known == 0), pa.array(score)], ["q", "id", "score"])
    return work


def _frequencies(asked: np.ndarray):
    """(term, documents) of the asked terms, one row per task and term."""
    def work(batches):
        count = np.zeros(len(asked), np.int64)
        for b in batches:
            for row in b.to_pylist():
                terms, first, start = (np.frombuffer(row[c], t) for c, t in (
                    ("terms", np.uint64), ("first_run", np.int32), ("run_start", np.int64)))
                at = np.searchsorted(terms, asked)
                hit = np.flatnonzero(at < len(terms))
                hit = hit[terms[at[hit]] == asked[hit]]
                at = at[hit]
                count[hit] += start[first[at + 1]] - start[first[at]]
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(asked[some].view(np.int64)), pa.array(count[some])], ["term", "n"])
    return work


class Index:
    """A built index: its table, N and L."""

    def __init__(self, table: DataFrame, n_docs: int):
        self.table, self.n_docs = table, n_docs

    def weights(self, terms: np.ndarray) -> dict[int, int]:
        """w of every one of these (distinct, sorted) terms that some document holds."""
        rows = (self.table.select("terms", "first_run", "run_start").mapInArrow(_frequencies(terms), "term long, n long")
                .groupBy("term").agg(F.sum("n").alias("n")).collect())  # at most as many rows as terms
        return {r.term: math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * r.n + 1))) for r in rows}


def build(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> Index:
    """The length-stratified index of all documents, as a table in the shared folder."""
    packed = scratch.put(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
                         .mapInArrow(_pack, PACKED).where("n > 0"), "packed")
    stat = packed.agg(F.count("*").alias("n"), F.sum("n").alias("l"), F.sum(F.length("terms")).alias("b")).first()
    shards = shards or int((stat.b or 0) // SHARD_BYTES) + 1
    big = "decimal(20,0)"
    m = F.lit(75).cast("long") + F.expr(f"(25 * cast(n as {big}) * cast({stat.n}L as decimal(16,0))) div cast({stat.l or 1}L as {big})")
    strata = packed.withColumn("m", m)
    cells = strata.groupBy("m").agg(F.ceil(F.sum(F.length("terms")) / CELL_BYTES).alias("cells"))
    # one row per value of m; broadcast if that is few (a plain join would shuffle the packed texts once more)
    dealt = strata.join(broadcast_if_bounded(scratch.put(cells, "cells")), "m").withColumn(
        "shard", F.pmod(F.xxhash64("m", F.pmod(F.xxhash64("id", "terms"), F.col("cells"))), F.lit(shards)))
    table = scratch.put(dealt.repartitionById(shards, F.col("shard").cast("int")).select("m", "id", "terms", "tfs")
                        .sortWithinPartitions("m").mapInArrow(_stratum, INDEX), "index")
    scratch.drop(packed)
    return Index(table, stat.n)


def search(index: Index, items: DataFrame, scratch: Scratch, k: int = K, item_col: str = "item_id", text_col: str = "text",
           id_col: str = "doc_id", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_col, rank, id_col, score``: the k best documents of every item."""
    spark = items.sparkSession
    asked = scratch.put(items.select(F.monotonically_increasing_id().alias("q"), F.col(item_col).alias("item"),
                                     F.col(text_col).cast("string").alias("text")), "items")
    packed = scratch.put(asked.select("q", "text").mapInArrow(_pack, PACKED).where("n > 0"), "asked")
    size = packed.agg(F.sum(F.length("terms"))).first()[0] or 0
    passes = int(size // query_bytes) + 1
    found = spark.createDataFrame([], "q long, id long, score long")
    for p in range(passes):
        part = packed.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p).select("id", "terms", "tfs").collect()  # about query_bytes
        if not part or not index.n_docs:
            continue
        terms = np.unique(np.concatenate([np.frombuffer(r.terms, np.uint64) for r in part]))
        weight = index.weights(terms)
        w = np.array([weight.get(t, 0) for t in terms.view(np.int64).tolist()], np.int64)
        queries = []
        for r in part:
            mine = np.frombuffer(r.terms, np.uint64)
            v = w[np.searchsorted(terms, mine)] * np.frombuffer(r.tfs, "<u4")
            queries.append((r.id, mine[v > 0].tobytes(), v[v > 0].tobytes()))
        found = found.unionByName(scratch.put(index.table.mapInArrow(_search(queries, k), "q long, id long, score long"), "found"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k).join(asked.select("q", "item"), "q")
            .select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))


def ranked(docs: DataFrame, items: DataFrame, k: int = K, **cols) -> DataFrame:
    """Index ``docs`` and search it for every row of ``items``."""
    scratch = Scratch(docs.sparkSession, "strata")
    return search(build(docs, scratch), items, scratch, k, **cols)
