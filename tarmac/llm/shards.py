"""Training-order materialisation: a keyed Feistel permutation gives every
sequence a global slot; shards hold consecutive slots in fixed strides.

A document's ids are cut into sequences of ``seq_len``. Sequences are numbered in the order
of a hash of their document's id and text, so a number depends on the rows alone, not on
how the input is split or on the cluster. Sequence i of N gets slot ``P(i)``, where P is a
balanced Feistel network over the smallest even number of bits that covers N, walked
until the value falls below N (the cycle walk; at most four steps on average). Slot s is
row ``s % rows`` of shard ``s // rows``; a shard's rows are sorted and each holds exactly
``stride`` bytes (the last sequence of a document is padded), so row k starts at byte k x
stride of the shard's record stream and a reader resumes at any slot. ``write_binary``
writes these streams as plain files.

On Spark: scan tasks tokenise once and write rows of about a thousand documents, in
buckets of the task's number. Only (hash, place, number of sequences) of every document is
sorted: ranges of the hash are numbered apart, a small table of range totals gives the
rest. The numbers go back to the tasks' buckets; the ids move once, to their shards.

Edge cases: a null or empty text is one sequence with the end id alone; repeated
rows get sequences each, equal in bytes; a null id is kept; very long texts are many
sequences; an empty table gives no shards; columns other than id and text are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.base import Scratch, bucketed
from tarmac.llm.packing import prefix
from tarmac.llm.textops import mix64
from tarmac.llm.tokens import encoder, token_ids

SEQ_LEN = 1024
ROWS_PER_SHARD = 1 << 14
ROUNDS = 8


def feistel(index: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of ``index`` under the keyed permutation of range(n)."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask, h = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix64(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (2**63 - 1)))
    out = np.asarray(index, np.uint64).copy()
    walk = np.arange(len(out))
    while len(walk):
        x = out[walk]
        left, right = x >> h, x & mask
        for k in keys:
            left, right = right, left ^ (mix64(right + k) & mask)
        x = (left << h) | right
        out[walk] = x
        walk = walk[x >= np.uint64(n)]
    return out.astype(np.int64)


#: documents, and ids, of a row of tokens at most (a longer document is a row of its own)
CUT_ROWS, CUT_IDS = 1000, 1 << 20
#: documents that are numbered in one range
RANGE_DOCS = 500_000


def _tokens(vocabulary: str | None):
    """Rows of documents: (part, chunk, docs, hashes, numbers of ids, ids in one piece)."""
    def work(batches):
        enc = encoder(vocabulary)
        kind = "<u4" if enc.max_token_value >= 1 << 16 else "<u2"
        part, chunk = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def flush():
            doc, h, h2, ids = zip(*held)
            cols = [[part], [chunk], [list(doc)], [list(h)], [list(h2)], [[len(x) for x in ids]], [b"".join(x.astype(kind).tobytes() for x in ids)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary()))], ["part", "chunk", "doc", "h", "h2", "n", "ids"])

        for b in batches:
            for doc, text, h, h2 in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                held.append((doc, h, h2, token_ids(text.as_py(), enc)))
                size += len(held[-1][3])
                if len(held) == CUT_ROWS or size >= CUT_IDS:
                    yield flush()
                    held, size, chunk = [], 0, chunk + 1
        if held:
            yield flush()

    return work


def _numbers(tok: DataFrame, seq_len: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """(part, chunk, first): the number of the first sequence of each document of a row of
    tokens; and the number of all sequences."""
    each = tok.select("part", "chunk", F.posexplode(F.arrays_zip("doc", "h", "h2", "n")).alias("pos", "d")).select(
        "part", "chunk", "pos", F.col("d.doc").alias("doc"), F.col("d.h").alias("h"), F.col("d.h2").alias("h2"),
        F.ceil(F.col("d.n") / F.lit(seq_len)).cast("long").alias("k"))
    ranges = each.count() // RANGE_DOCS + 1
    spot = (F.col("h").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64) * F.lit(ranges)
    each = each.withColumn("range", F.least(F.floor(spot), F.lit(ranges - 1)))
    totals = scratch.put(prefix(each.groupBy("range").agg(F.sum("k").alias("k")), [], "range", "k", "base"), "totals")
    n = int(totals.agg(F.sum("k")).first()[0] or 0)
    w = Window.partitionBy("range").orderBy("h", "doc", "h2").rowsBetween(Window.unboundedPreceding, -1)
    first = each.withColumn("before", F.coalesce(F.sum("k").over(w), F.lit(0))).join(totals.select("range", "base"), "range")
    return (first.groupBy("part", "chunk").agg(F.transform(F.sort_array(F.collect_list(F.struct(
        "pos", (F.col("base") + F.col("before")).alias("first")))), lambda x: x.first).alias("first"))), n


def _sequences(n_total: int, key: int, seq_len: int, rows: int):
    """A document's sequences are consecutive rows of a matrix, so its ids are copied
    in one piece and the rest of its last row stays zero."""
    def work(batches):
        for whole in batches:
            for i in range(whole.num_rows):
                docs, n, first = (whole.column(c)[i] for c in ("doc", "n", "first"))
                raw = whole.column("ids")[i].as_py()
                n, first = np.array(n.as_py(), np.int64), np.array(first.as_py(), np.int64)
                kind = "<u2" if len(raw) == 2 * n.sum() else "<u4"
                k = -(-n // seq_len)
                head = np.cumsum(k) - k
                out = np.zeros(int(k.sum()) * seq_len, kind)
                out[np.arange(n.sum()) + np.repeat(head * seq_len - (np.cumsum(n) - n), n)] = np.frombuffer(raw, kind)
                doc = np.repeat(np.arange(len(n)), k)
                seq = np.arange(len(doc)) - head[doc]
                slot = feistel(first[doc] + seq, n_total, key)
                ends = np.arange(len(doc) + 1, dtype=np.int64) * (seq_len * out.itemsize)
                ids = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(out)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(slot // rows), docs.values.take(pa.array(doc)), pa.array(seq),
                     pa.array(np.minimum(seq_len, n[doc] - seq * seq_len)), ids],
                    ["slot", "shard", "doc", "seq_no", "n_tokens", "ids"])
    return work


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", key: int = 17,
                 seq_len: int = SEQ_LEN, rows: int = ROWS_PER_SHARD, vocabulary: str | None = None) -> DataFrame:
    """Write ``path/shard=K/*.parquet`` (slot, id, seq_no, n_tokens, ids) and return
    what was written. The same rows and key give the same bytes per slot, however the rows
    are split."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    hashed = texts.select("doc", "text", F.xxhash64("doc", "text").alias("h"), F.xxhash64("text", "doc", F.lit(1)).alias("h2"))
    buckets = max(1, hashed.rdd.getNumPartitions())  # of the plan; nothing runs
    tok = bucketed(hashed.mapInArrow(_tokens(vocabulary), "part long, chunk long, doc array<long>, h array<long>, h2 array<long>, "
                                     "n array<long>, ids binary"), scratch, "tokens", "part", buckets)
    numbers, n_total = _numbers(tok.select("part", "chunk", "doc", "h", "h2", "n"), seq_len, scratch)
    numbers = bucketed(numbers.repartition(buckets, "part"), scratch, "numbers", "part", buckets)
    a, b = tok.select("part", "chunk", "doc", "n", "ids").alias("a"), numbers.hint("shuffle_hash").alias("b")
    # equal buckets meet by part; the row is told by a condition that asks for no other partitioning
    met = a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.chunk") - F.col("b.chunk") == 0))
    seqs = met.select("a.doc", "a.n", "a.ids", "b.first").mapInArrow(
        _sequences(n_total, key, seq_len, rows), "slot long, shard long, doc long, seq_no long, n_tokens long, ids binary")
    shards = max(1, -(-n_total // rows))
    (seqs.withColumnRenamed("doc", id_col).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
     .write.partitionBy("shard").option("compression", "zstd").parquet(path))
    return read_shards(spark, path, id_col=id_col)


def write_binary(shards: DataFrame, path: str) -> DataFrame:
    """Each shard of ``shards`` (as ``read_shards`` gives them) as one plain file
    ``path/shard-K.bin`` of its rows in slot order; (shard, first_slot, rows, stride, bytes,
    crc32) per file. Tasks write under a name of their own and rename at the end, so a
    repeated task leaves one whole file. ``path``: a folder that all tasks reach through
    Arrow's file systems (a shared folder, hdfs, s3)."""
    def work(batches):
        import uuid
        import zlib

        from pyarrow import fs
        system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        system.create_dir(root, recursive=True)
        out, now, told = None, None, []

        def close():
            out[0].close()
            system.move(out[1], f"{root}/shard-{now:06d}.bin")
            told.append((now, *out[2:]))

        for b in batches:
            for shard, slot, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if shard != now:
                    if out:
                        close()
                    name = f"{root}/_part-{uuid.uuid4().hex}"
                    out, now = [system.open_output_stream(name), name, slot, 0, 0, 0, 0], shard
                raw = ids.as_buffer()
                out[0].write(raw)
                out[3], out[4], out[5], out[6] = out[3] + 1, len(raw), out[5] + len(raw), zlib.crc32(raw, out[6])
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*told) if told else [[]] * 6)],
                                         ["shard", "first_slot", "rows", "stride", "bytes", "crc32"])

    n = max(1, shards.select("shard").distinct().count())
    return (shards.select("shard", "slot", "ids").repartitionById(n, F.pmod(F.col("shard"), F.lit(n)).cast("int"))
            .sortWithinPartitions("shard", "slot")
            .mapInArrow(work, "shard long, first_slot long, rows long, stride long, bytes long, crc32 long"))


def read_binary(path: str, first_slot: int, stride: int, rows: int = ROWS_PER_SHARD) -> Iterator[bytes]:
    """Sequences from ``first_slot`` on, in order, read from the byte where they start."""
    from pyarrow import fs
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    shard, at = divmod(first_slot, rows)
    while system.get_file_info(f"{root}/shard-{shard:06d}.bin").type == fs.FileType.File:
        with system.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            f.seek(at * stride)
            while raw := f.read(stride):
                yield raw
        shard, at = shard + 1, 0


def read_shards(spark: SparkSession, path: str, first_slot: int = 0, rows: int = ROWS_PER_SHARD,
                id_col: str = "doc_id") -> DataFrame:
    """The written sequences from ``first_slot`` on; whole shards before it are not
    opened and row groups before it are skipped."""
    df = spark.read.schema(f"slot long, {id_col} long, seq_no long, n_tokens long, ids binary, shard long").parquet(path)
    return df.where((F.col("shard") >= first_slot // rows) & (F.col("slot") >= first_slot))
