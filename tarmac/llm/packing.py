"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of packets (at most ``packet`` tokens of one document).
In each round, one per window, a source's deficit grows by its quantum, window x
target share, and the source sends packets while the deficit covers them. As no
queue waits empty, the packet that ends at token E of its queue leaves in round
``ceil(E / quantum)``; a deficit is what the rounds so far have granted but not
sent, so it is carried over windows and partitions by arithmetic instead of by a
task that walks through all windows. A source that runs dry leaves its share of
later windows to the others. The packets in order of (round, source, place in
the queue) form one stream, cut at every ``window`` tokens; only the last
sequence is short.

Stream positions come from prefix sums over written totals: per (task, source)
for the queues, per group of rounds for the stream. A hot source is spread over
all tasks and round groups like any other.

Edge cases: a null or empty text is its end id alone; a null source is a queue
of its own; repeated rows are packed each; sources without a given weight get
their natural share; an empty table gives no pieces; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.base import Scratch
from tarmac.llm.textops import slices
from tarmac.llm.tokens import tokenise

WINDOW = 2048
PACKET = 128
#: packets per group of rounds, the unit of the stream's prefix sums
GROUP_PACKETS = 200_000


def prefix(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Running total of ``value`` before each row (small tables of totals only)."""
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    w = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def schedule(meta: DataFrame, window: int, packet: int, weights: dict[str, float] | None, scratch: Scratch) -> DataFrame:
    """Packets with their place in the stream: ``uid, start, length, g``.
    ``meta``: (uid, part, src, n, pos)."""
    tot = meta.groupBy("part", "src").agg(F.sum("n").alias("tokens"))
    tot = scratch.put(prefix(tot, ["src"], "part", "tokens", "base"), "totals")
    per = tot.groupBy("src").agg(F.sum("tokens").alias("src_tokens"))
    row = per.agg(F.sum("src_tokens").alias("t"), F.max("src_tokens").alias("m"), F.count("*").alias("k")).first()
    total = int(row.t or 0)
    natural = F.col("src_tokens") / F.lit(float(total or 1))
    weight = natural
    if weights:
        named = F.create_map(*[F.lit(x) for k, v in weights.items() for x in ("n" if k is None else f"s:{k}", float(v))])
        weight = F.coalesce(named[F.col("src")], natural)
    per = per.withColumn("weight", weight)
    share = per.agg(F.sum("weight")).first()[0] or 1.0
    per = scratch.put(per.select("src", (F.col("weight") / F.lit(share) * window).alias("quantum"), F.ceil(
        F.col("src_tokens") / (F.col("weight") / F.lit(share) * window)).alias("rounds")), "quanta")
    rounds = int(per.agg(F.max("rounds")).first()[0] or 0) + 1
    groups = min(4096, max(1, total // packet // GROUP_PACKETS + 1))
    base = tot.join(per, "src").select("part", "src", "base", "quantum")
    p = (meta.join(base, ["part", "src"])
         .select("uid", "src", "n", "quantum", (F.col("base") + F.col("pos")).alias("at"),
                 F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(packet).cast("long"))).alias("start"))
         .withColumn("length", F.least(F.lit(packet), F.col("n") - F.col("start")))
         .withColumn("end", F.col("at") + F.col("start") + F.col("length"))
         .withColumn("round", F.ceil(F.col("end") / F.col("quantum")))
         .select("uid", "src", "start", "length", "end", "round",
                 F.least(F.lit(groups - 1), F.floor(F.col("round") * (groups / rounds))).cast("int").alias("grp")))
    p = scratch.put(p, "packets")
    sums = prefix(p.groupBy("grp").agg(F.sum("length").alias("tokens")), [], "grp", "tokens", "base")
    w = Window.partitionBy("grp").orderBy("round", "src", "end").rowsBetween(Window.unboundedPreceding, -1)
    return (p.withColumn("before", F.coalesce(F.sum("length").over(w), F.lit(0)))
            .join(F.broadcast(sums.select("grp", "base")), "grp")  # at most 4096 rows
            .select("uid", "start", "length", (F.col("base") + F.col("before")).alias("g")))


def _cut(window: int):
    """Cuts every document's packets at window ends and joins neighbours that stay
    side by side. A document's pieces follow each other without gaps, so the pieces
    of a batch are consecutive ranges of its ids and no id is touched one by one."""
    def work(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n = b.column("n").to_numpy()
            _, _, raw, offs = next(slices(b.column("ids"), None))
            ids = np.frombuffer(raw, "<u2" if offs[-1] == 2 * n.sum() else "<u4").astype("<u4")
            packets = b.column("packets")
            row = np.repeat(np.arange(len(n)), packets.value_lengths().to_numpy())
            start, length, g = (x.to_numpy() for x in packets.flatten().flatten())
            by = np.lexsort((start, row))
            row, start, length, g = row[by], start[by], length[by], g[by]
            k = (g % window + length - 1) // window + 1  # windows that a packet touches
            at = np.repeat(np.arange(len(g)), k)
            w = g[at] // window + np.arange(len(at)) - np.repeat(np.cumsum(k) - k, k)
            lo, hi = np.maximum(g[at], w * window), np.minimum((g + length)[at], (w + 1) * window)
            row, start, size = row[at], start[at] + lo - g[at], hi - lo
            new = np.ones(len(at), bool)
            new[1:] = (row[1:] != row[:-1]) | (lo[1:] != hi[:-1]) | (lo[1:] % window == 0)
            head = np.flatnonzero(new)
            size = np.add.reduceat(size, head)
            ends = np.append(0, np.cumsum(size)) * 4
            data = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])
            lo, row = lo[head], row[head]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").take(pa.array(row)), pa.array(start[head]), pa.array(size), data, pa.array(n[row]),
                 pa.array(lo // window), pa.array(lo % window)],
                ["doc", "start", "length", "ids", "n", "sequence_id", "offset"])
    return work


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         window: int = WINDOW, packet: int = PACKET, weights: dict[str, float] | None = None,
         vocabulary: str | None = None) -> DataFrame:
    """Pieces: ``id_col, start, length, ids (binary, uint32), doc_tokens, sequence_id,
    offset``. ``weights``: target token share per source (natural shares if None)."""
    scratch = Scratch(docs.sparkSession, "pack")
    tok = scratch.put(tokenise(docs, id_col, text_col, source_col, vocabulary), "tokens")
    packets = schedule(tok.select("uid", "part", "src", "n", "pos"), window, packet, weights, scratch)
    by_doc = packets.groupBy("uid").agg(F.collect_list(F.struct("start", "length", "g")).alias("packets"))
    return (tok.select("uid", "doc", "n", "ids").join(by_doc, "uid").select("doc", "n", "ids", "packets")
            .mapInArrow(_cut(window), "doc long, start long, length long, ids binary, n long, sequence_id long, offset long")
            .select(F.col("doc").alias(id_col), "start", "length", "ids", F.col("n").alias("doc_tokens"), "sequence_id",
                    "offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed windows themselves: ``sequence_id, ids`` (uint32), pieces in place."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")))
