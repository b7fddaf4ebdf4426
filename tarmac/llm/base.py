"""Shared plumbing: scratch tables in the cluster's shared folder, null-safe
sources, and distributed connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import drop_path, scratch_path


_open: list[list["Scratch"]] = []  # scratch folders that the open ``spent`` blocks have seen


@contextmanager
def spent(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end of a block that went well, every scratch folder that was begun in
    it. For a block that ends with its result written: nothing lazy may read them after."""
    mine: list[Scratch] = []
    _open.append(mine)
    try:
        yield
    finally:
        _open.remove(mine)
    for s in mine:
        drop_path(spark, s.root)


class Scratch:
    """Intermediate tables written under ``spark.checkpoint.dir``; cuts the
    lineage (a lost executor re-reads files instead of re-running the past).
    ``drop`` removes a table that nothing will read again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_path(spark, name)}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        for seen in _open:
            seen.append(self)

    def put(self, df: DataFrame, name: str = "t") -> DataFrame:
        path = f"{self.root}/{self._n}-{name}"
        self._n += 1
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t._scratch)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def bucketed(df: DataFrame, scratch: Scratch, name: str, col: str, buckets: int) -> DataFrame:
    """``df`` as a table in ``buckets`` buckets of ``col`` in the shared folder. A later join on
    ``col`` moves the other side only."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, col).option("path", f"{scratch.root}/{table}")
     .saveAsTable(table))
    return df.sparkSession.table(table)


def source_key(col: str = "source") -> F.Column:
    """A non-null text key per source; a null source is a queue of its own."""
    c = F.col(col).cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s:"), c))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of an edge list ``(a long, b long)``.

    Returns ``(id, comp)`` for every id on an edge between different ids;
    ``comp`` is the smallest id that can be reached. Each round maps a vertex to
    its smallest neighbour (or itself), doubles that map until it ends in local
    minima and contracts the edges, so stars and sorted paths vanish in one
    round. All steps are joins and partial aggregates over written tables;
    nothing is collected. An empty edge list gives an empty result."""
    e = scratch.put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "edges")
    maps: list[DataFrame] = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        p = scratch.put(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m"))
                        .select("id", F.least("id", "m").alias("p")), "low")
        while True:  # pointer jumping: every vertex ends at a local minimum
            nxt = scratch.put(_follow(p, "p", p).withColumn("moved", F.col("q") != F.col("p"))
                              .select("id", F.col("q").alias("p"), "moved"), "jump")
            moved = not nxt.where("moved").isEmpty()
            p = nxt.select("id", "p")
            if not moved:
                break
        maps.append(p)
        ends = (e.join(p.select(F.col("id").alias("u"), F.col("p").alias("pu")), "u")
                .join(p.select(F.col("id").alias("v"), F.col("p").alias("pv")), "v"))
        e = scratch.put(ends.where("pu <> pv").select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v"))
                        .distinct(), "edges")
    if not maps:
        return scratch.spark.createDataFrame([], "id long, comp long")
    out = maps[0].select("id", F.col("p").alias("comp"))
    for m in maps[1:]:
        out = _follow(out, "comp", m).select("id", F.col("q").alias("comp"))
    return scratch.put(out, "components")


def _follow(df: DataFrame, col: str, to: DataFrame) -> DataFrame:
    """``df`` with ``q``: where the map ``to`` sends ``df[col]``, itself if nowhere."""
    m = to.select(F.col("id").alias("_k"), F.col("p").alias("_p"))
    return df.join(m, F.col(col) == F.col("_k"), "left").withColumn("q", F.coalesce("_p", col)).drop("_k", "_p")


def runs(batches, keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``keys`` (integers) of sorted Arrow batches, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in keys])
        cuts = np.append(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(0)) + 1, b.num_rows).tolist()
        at = 0
        for end in cuts:
            key = tuple(cols[:, at].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(at, end - at))
            last, at = key, end
    if held:
        yield pa.Table.from_batches(held)
