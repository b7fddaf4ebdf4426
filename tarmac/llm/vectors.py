"""Embedding near-duplicates by product quantisation.

Equal vectors of a label form one class; classes are scaled to unit length and
compared inside their label only:

* coarse centroids (k-means on a bounded sample, ``SAMPLE`` vectors) give inverted
  lists; what is left after the centroid is cut into ``SUBSPACES`` parts, each coded
  by one of 256 codewords (fitted on the same sample); every vector is indexed;
* probes: a vector within distance r of q lies beyond the bisecting plane between
  q's own centroid and its own, so q probes every list whose plane is at most r
  away. r is the distance that the cosine threshold allows, hence no link is
  missed by probing;
* in a probed list, table look-ups give asymmetric distances d(q, code of x). The
  stored coding error e of x bounds the true distance from below by d - e; only
  pairs with d - e <= r are reranked by their exact cosine in double precision.

So recall does not depend on how well the sample fits; a poor fit only probes and
reranks more. Vectors of a list are dealt into blocks of about ``BLOCK`` (a hot
label or list is many blocks), probing vectors likewise; a task compares two
blocks and returns one row per linked class: its link count and the smallest class
it reaches in that task. Pairs themselves are never emitted, and components come
from those rows.

Labels are compared in their own type (numbers by value, texts as they are). Vectors are
scaled by a power of two before any product, so very small and very large ones neither
vanish nor overflow.

Edge cases: null, zero, empty or non-finite vectors and null labels link with
nothing; vectors of different lengths never link; repeated rows are vectors of
their own; an empty table gives an empty result; other columns are ignored, whatever
their names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.base import Scratch, components

THRESHOLD = 0.93
SAMPLE = 20_000
SUBSPACES = 16
CODES = 256
#: sample vectors per coarse list at least; up to that the lists grow with the largest label
PER_LIST = 8
BLOCK = 1024
#: distances computed at a time
CELLS = 4_000_000
EPS = 1e-6


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from k distinct sample rows; empty centroids keep their place."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].astype(np.float64)
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    step, own = max(1, CELLS // len(c)), (c * c).sum(1)[None]
    return np.concatenate([(own - 2 * x[k:k + step] @ c.T).argmin(1) for k in range(0, len(x), step)] or [np.empty(0, np.int64)])


class Index:
    """Coarse centroids and codebooks of one vector length."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.coarse = kmeans(sample, min(lists, len(sample)), 1)
        square = (self.coarse ** 2).sum(1)
        self.wide = np.sqrt(np.maximum(square[:, None] + square[None] - 2 * self.coarse @ self.coarse.T, 0))
        rest = sample - self.coarse[nearest(sample, self.coarse)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [kmeans(rest[:, c], min(CODES, len(rest)), 2, 4) for c in self.cuts]

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and coding errors of unit vectors in their own lists."""
        rest = x - self.coarse[own]
        codes = np.stack([nearest(rest[:, c], b) for c, b in zip(self.cuts, self.books)], 1)
        back = np.concatenate([b[codes[:, s]] for s, b in enumerate(self.books)], 1)
        order = np.concatenate(self.cuts)
        return codes.astype(np.uint8), np.sqrt(((rest[:, order] - back) ** 2).sum(1))

    def probes(self, x: np.ndarray, own: np.ndarray, r: float) -> np.ndarray:
        """Mask (vector, list): lists at or after the own one that can hold a vector within r."""
        d = (x * x).sum(1)[:, None] + (self.coarse ** 2).sum(1)[None] - 2 * x @ self.coarse.T
        wide = self.wide[own]
        plane = (d - d[np.arange(len(x)), own][:, None]) / (2 * np.maximum(wide, 1e-12))
        # the distance of close centroids is the difference of large numbers: such lists are probed
        return ((plane <= r + EPS) | (wide < 1e-4)) & (np.arange(len(self.coarse))[None] >= own[:, None])

    def distances(self, q: np.ndarray, list_id: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the codes of one list, by table look-up."""
        rest = q - self.coarse[list_id]
        out = np.zeros((len(q), len(codes)), np.float32)
        for s, (c, b) in enumerate(zip(self.cuts, self.books)):
            part = rest[:, c]
            table = ((part ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None] - 2 * part @ b.T).astype(np.float32)
            out += table[:, codes[:, s]]
        return out


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two: the same directions, the largest entry near one."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1))[1][:, None])


def _unit(v: np.ndarray) -> np.ndarray:
    v = _scaled(v)
    return v / np.sqrt((v * v).sum(1))[:, None]


def _index_rows(index: dict[int, Index], r: float):
    """Each vector once as a member of its list and once per probed list."""
    def work(batches):
        for b in batches:
            ids, labels, vecs = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            copies = b.column(3).to_pylist()
            out = []
            for d in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == d]
                ix, raw = index[d], np.array([vecs[i] for i in at], np.float64)
                for lo in range(0, len(at), 2000):
                    x = _unit(raw[lo:lo + 2000])
                    own = nearest(x, ix.coarse)
                    codes, err = ix.encode(x, own)
                    probe = ix.probes(x, own, r)
                    for k, i in enumerate(at[lo:lo + 2000]):
                        v = raw[lo + k].tobytes()
                        key = (ids[i], labels[i], d, copies[i])
                        out.append((*key, int(own[k]), True, v, codes[k].tobytes(), float(err[k])))
                        out += [(*key, c, False, v, None, None) for c in np.flatnonzero(probe[k]).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 9, (
                    pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.float64()))],
                ["cls", "label", "dim", "copies", "list", "member", "v", "codes", "err"])
    return work


def _compare(index: dict[int, Index], threshold: float, r: float):
    def work(batches):
        for b in batches:
            for row in b.to_pylist():
                d, ix = row["dim"], index[row["dim"]]
                q, x = (np.frombuffer(b"".join(row[k]), np.float64).reshape(-1, d) for k in ("qv", "xv"))
                qid, xid = np.array(row["qid"]), np.array(row["xid"])
                codes = np.frombuffer(b"".join(row["xcodes"]), np.uint8).reshape(len(x), -1)
                err = np.array(row["xerr"])
                q, x = _scaled(q), _scaled(x)
                dist = ix.distances(_unit(q), row["list"], codes)
                near = np.sqrt(np.maximum(dist, 0)) - err[None] <= r + 1e-4  # float32 tables
                # inside the own list every pair shows up twice: once is enough
                near &= (np.array(row["qown"])[:, None] != row["list"]) | (qid[:, None] < xid[None])
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                cos = np.concatenate([(q[i[k:k + 50000]] * x[j[k:k + 50000]]).sum(1) for k in range(0, len(i), 50000)])
                cos /= np.sqrt((q * q).sum(1))[i] * np.sqrt((x * x).sum(1))[j]
                i, j = i[cos >= threshold], j[cos >= threshold]
                if not len(i):
                    continue
                ids, at = np.unique(np.concatenate([qid[i], xid[j]]), return_inverse=True)
                a, c = at[:len(i)], at[len(i):]
                links = (np.bincount(a, np.array(row["xcopies"])[j], len(ids))
                         + np.bincount(c, np.array(row["qcopies"])[i], len(ids))).astype(np.int64)
                low = np.arange(len(ids))
                while True:  # ids are sorted, so the smallest index is the smallest class
                    new = low.copy()
                    np.minimum.at(new, a, low[c])
                    np.minimum.at(new, c, low[a])
                    new = new[new]
                    if (new == low).all():
                        break
                    low = new
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[low])], ["cls", "links", "low"])
    return work


def label_text(df: DataFrame, col: str) -> F.Column:
    """A label as a text that is equal exactly where the labels are."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # one zero
    elif isinstance(kind, T.BinaryType):
        return F.hex(c)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c.cast("string")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, lists: int | None = None) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "vectors")
    v = F.col("v")
    fine = (F.col("label").isNotNull() & F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = scratch.put(vectors.select(F.col(id_col).cast("long").alias("id"), label_text(vectors, label_col).alias("label"),
                                      F.col(vec_col).cast("array<double>").alias("v"))
                       .withColumn("ok", F.coalesce(fine, F.lit(False)))
                       .withColumn("key", F.when(F.col("ok"), F.sha2(F.concat_ws(",", F.col("label"), F.transform(
                           "v", lambda x: (x + F.lit(0.0)).cast("string"))), 256))), "rows")
    good = rows.where("ok")
    classes = scratch.put(good.groupBy("key").agg(F.min("id").alias("cls"), F.first("label").alias("label"),
                                                  F.first("v").alias("v"), F.count("*").alias("copies")), "classes")
    r = float(np.sqrt(2 - 2 * threshold))
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    k = lists or max(1, min(SAMPLE // PER_LIST, round(largest ** 0.5 / 8)))
    index: dict[int, Index] = {}
    for row in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect():  # vector lengths: one or a few
        # a hashed share of a little less than SAMPLE vectors (all, if there are fewer): no task sends more than its part
        share = min(1.0, (SAMPLE - 4 * SAMPLE**0.5) / row.n) if row.n > SAMPLE else 1.0
        part = classes.where((F.size("v") == row.d) & (F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))))
        # the centroids depend on the order of the sample
        part = part.select("key", "v").toPandas().sort_values("key")
        index[row.d] = Index(_unit(np.array(part.v.tolist(), np.float64)), k)
    placed = scratch.put(classes.select("cls", "label", "v", "copies").mapInArrow(
        _index_rows(index, r), "cls long, label string, dim int, copies long, list int, member boolean, v binary, codes binary, err double"),
        "placed")
    at = ["label", "dim", "list"]
    blocks = placed.groupBy(*at, "member").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    packed = (placed.join(blocks, [*at, "member"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks"))))
    x = packed.where("member").groupBy(*at, "block").agg(*[F.collect_list(c).alias(n) for c, n in (
        ("cls", "xid"), ("v", "xv"), ("codes", "xcodes"), ("err", "xerr"), ("copies", "xcopies"))])
    own = placed.where("member").select("cls", F.col("list").alias("own"))
    q = (packed.where(~F.col("member")).join(own, "cls").groupBy(*at, F.col("block").alias("qblock")).agg(
        *[F.collect_list(c).alias(n) for c, n in (("cls", "qid"), ("v", "qv"), ("own", "qown"), ("copies", "qcopies"))]))
    # every block of probing vectors meets every block of the list, as rows of their own key: a
    # list that holds a third of all vectors is spread over its blocks
    of = blocks.where("member").select(*at, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    found = scratch.put(x.join(q.join(of, at), [*at, "block"]).drop("label", "block", "qblock").mapInArrow(
        _compare(index, threshold, r), "cls long, links long, low long"), "found")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("cls").alias("a"), F.col("low").alias("b")), scratch)
    of = (classes.select("key", "cls", "copies").join(links, "cls", "left")
          .join(comp.select(F.col("id").alias("cls"), "comp"), "cls", "left")
          .select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("comp", "cls").alias("comp")))
    out = good.join(of, "key").select("id", "links", "comp").unionByName(
        rows.where("not ok").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("comp")))
    return out.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("comp").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("comp")).alias("kept"))
