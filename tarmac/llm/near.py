"""MinHash near-duplicates by fast similarity sketching.

A sketch has ``T`` coordinates. In round i < T every shingle throws itself into
one hashed bin with the value ``i + u`` (u uniform in [0, 1)); in round T + i all
shingles throw into bin i. The rounds end as soon as every bin is filled, which
the last T rounds guarantee, and the coordinates concentrate like those of
independent minima. Then:

* documents with equal shingle sets form a class; only class representatives go on;
* ``BANDS`` bands of ``ROWS`` coordinates deal representatives into buckets;
* ``STARS`` rounds compare every member with one leader of each of its buckets (the
  smallest id, then others by hash), the last step all members of a bucket that
  are still in different components, each pair once. All first compare one bit of
  every coordinate (threshold 5.5 standard deviations below what similarity 0.75
  gives), then confirm on the full shingle sets. Pairs inside one component need
  no further look: they can't change the components.

A pair at similarity 0.75 shares no band with probability (1 - 0.75**3)**24 =
2e-6 and fails the bit test with about 2e-7.

Edge cases: a null or empty text, or one without words, has an empty set and is
linked with nothing (itself is its component); repeated rows are exact copies;
columns other than the id and the text are ignored; an empty table gives an
empty result. A null id is kept and linked with nothing; rows that repeat an id
with another text are one node of the graph, linked by any of its texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import textops
from tarmac.llm.base import Scratch, components, runs

T, BANDS, ROWS = 512, 24, 3
THRESHOLD = 75  # percent
#: bits of T that may differ: 0.875 of them agree at similarity 0.75
MAX_BITS = T - int(0.875 * T - 5.5 * (T * 0.875 * 0.125) ** 0.5)
_BITS = [f"s{k}" for k in range(T // 64)]
STARS = 3  # rounds against one leader per bucket
BLOCK = 1024  # members of a bucket that meet in one task
_M = np.uint64(0x9E3779B97F4A7C15)


def sketch(s: np.ndarray, t: int = T) -> np.ndarray:
    """Coordinates of a non-empty set of 64-bit hashes: ``round << 32 | value``.
    Rounds run in batches; a round after the last one needed can't lower a minimum."""
    free = np.iinfo(np.uint64).max
    out = np.full(t, free, np.uint64)
    i, at_once = 0, max(1, 4096 // len(s))
    while i < t:
        k = np.arange(i, min(i + at_once, t), dtype=np.uint64)[:, None]
        h, val = _throw(s, k)
        np.minimum.at(out, ((h & np.uint64(0xFFFFFFFF)) % np.uint64(t)).ravel(), val.ravel())
        i = int(k[-1, 0]) + 1
        if len(s) * i >= t and not (out == free).any():
            return out
    empty = np.flatnonzero(out == free)
    out[empty] = _throw(s, (empty + t).astype(np.uint64)[:, None])[1].min(1)
    return out


def _throw(s: np.ndarray, rounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        h = textops.mix64(s[None] + _M * (rounds + np.uint64(1)))
    return h, rounds << np.uint64(32) | h >> np.uint64(32)


_SIG = pa.schema([("_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                  *[(b, pa.int64()) for b in _BITS], ("bands", pa.list_(pa.int64()))])


def _signatures(batches):
    with np.errstate(over="ignore"):
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = []
            for i, s in zip(ids, textops.shingle_sets(b.column(1))):
                if not len(s):
                    rows.append((i, 0, 0, 0, *[0] * len(_BITS), []))
                    continue
                c = sketch(s)
                m = textops.mix64(c)
                band = m[:BANDS * ROWS].reshape(BANDS, ROWS)
                key = textops.mix64(band[:, 0] * np.uint64(3) + band[:, 1] * np.uint64(5) + band[:, 2] * np.uint64(7)
                                    + np.arange(1, BANDS + 1, dtype=np.uint64) * _M)
                bits = np.packbits(((m >> np.uint64(17)) & np.uint64(1)).astype(bool)).view(np.int64).tolist()
                h1 = int(s.sum(dtype=np.uint64))
                h2 = int(textops.mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                rows.append((i, len(s), *(np.array([h1, h2], np.uint64).view(np.int64).tolist()), *bits,
                             key.view(np.int64).tolist()))
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist([dict(zip(_SIG.names, r)) for r in rows], schema=_SIG)
                    rows = []
            yield pa.RecordBatch.from_pylist([dict(zip(_SIG.names, r)) for r in rows], schema=_SIG)


def _confirm(batches):
    """Pairs whose full sets have 100 |A and B| >= 75 |A or B|."""
    for b in batches:
        a, c = b.column(0).to_pylist(), b.column(1).to_pylist()
        keep = []
        for k, (x, y) in enumerate(zip(textops.shingle_sets(b.column(2)), textops.shingle_sets(b.column(3)))):
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= THRESHOLD * (len(x) + len(y) - both):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in keep], pa.int64()),
                                          pa.array([c[k] for k in keep], pa.int64())], ["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of representatives that are links."""
    left = texts.select(F.col("_id").alias("a"), F.col("_text").alias("_ta"))
    right = texts.select(F.col("_id").alias("b"), F.col("_text").alias("_tb"))
    # the smaller ids are few (leaders): their texts travel last
    return (pairs.join(right, "b").join(left, "a").select("a", "b", "_ta", "_tb")
            .mapInArrow(_confirm, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_shingles, component_id, kept``."""
    scratch = Scratch(docs.sparkSession, "near")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    bits = ", ".join(f"{b} long" for b in _BITS)
    sig = scratch.put(texts.mapInArrow(_signatures, f"_id long, n long, h1 long, h2 long, {bits}, bands array<long>"), "sig")
    live = sig.where("n > 0 and _id is not null")
    classes = scratch.put(live.groupBy("h1", "h2", "n").agg(F.min(F.struct("_id", *_BITS, "bands")).alias("r"))
                          .select("h1", "h2", "n", "r.*"), "classes")
    member = classes.select("_id", F.posexplode("bands").alias("band", "bucket"))
    many = member.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    # bits go to members of shared buckets only, and only their texts are ever compared
    met = scratch.put(member.join(many, "bucket"), "met")
    shared = scratch.put(met.join(classes.select("_id", *_BITS), "_id").select("bucket", "_id", *_BITS, "band"), "shared")
    texts = scratch.put(texts.join(met.select("_id").distinct(), "_id", "left_semi"), "texts")
    scratch.drop(met)
    comp, edges, tried = None, None, None
    for turn in range(STARS):  # every member against its buckets' leader, another leader each time
        rows = shared if comp is None else _open(shared, comp, scratch)
        by = F.struct(*([F.xxhash64("_id", F.lit(turn)).alias("o")] if turn else []), "_id", *_BITS)
        lead = rows.groupBy("bucket").agg(F.min(by).alias("l")).select("bucket", F.col("l._id").alias("l_id"), *[F.col(f"l.{b}").alias(f"l{b}") for b in _BITS])
        pairs = (rows.select("bucket", "_id", *_BITS).join(lead, "bucket").where("l_id <> _id").where(_alike("l"))
                 .select(F.least("l_id", "_id").alias("a"), F.greatest("l_id", "_id").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = scratch.put(pairs, "star")
        if rows is not shared:
            scratch.drop(rows)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = scratch.put(_verified(pairs, texts), "links")
        edges = links if edges is None else edges.unionByName(links)
        comp = components(edges, scratch)
    rest = _open(shared, comp, scratch)
    scratch.drop(shared)
    edges = edges.unionByName(_remaining(rest, classes, texts, scratch))
    scratch.drop(rest, texts)
    comp = components(edges, scratch)
    final = _label(classes.select("h1", "h2", "n", "_id"), comp).select("h1", "h2", "n", "comp")
    out = (sig.where("n = 0 or _id is null").select("_id", "n", F.col("_id").alias("comp")).unionByName(
        live.join(final, ["h1", "h2", "n"]).select("_id", "n", "comp")))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
                      (F.col("_id").eqNullSafe(F.col("comp"))).alias("kept"))


def _alike(prefix: str) -> str:
    return " + ".join(f"bit_count({b} ^ {prefix}{b})" for b in _BITS) + f" <= {MAX_BITS}"


def _open(shared: DataFrame, comp: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of buckets that still hold several components, with the bucket's size."""
    rows = _label(shared, comp)
    mixed = rows.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m")).where("x <> y")
    return scratch.put(rows.join(mixed.select("bucket", "m"), "bucket"), "open")


def _remaining(rows: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between members of one open bucket that stand in different components.

    A bucket's members are dealt into blocks; every two blocks meet in one task.
    The first pass names, per member, the partners that pass the bit test (each pair
    in the first bucket it shares only); the second fetches the texts of named
    members and confirms on full sets. Pairs are arrays inside rows; both passes
    return at most one row per member and two blocks, and one per link that joins
    components."""
    key = ["bucket", "bi", "bj"]
    rows = rows.join(classes.select("_id", "bands"), "_id")
    nb = F.ceil(F.col("m") / BLOCK).cast("long")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("_id"), nb)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), nb - 1)))
    rows = rows.select(F.col("bucket"), F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block",
                       "band", "_id", "comp", "bands", *_BITS)
    named = scratch.put(rows.repartition("bucket", "bi", "bj").sortWithinPartitions(*key).mapInArrow(
        _name_partners, "bucket long, bi long, bj long, _id long, comp long, partners array<long>"), "named")
    return scratch.put(named.join(texts, "_id").select(*key, "_id", "comp", "partners", "_text").repartition("bucket", "bi", "bj")
                       .sortWithinPartitions(*key).mapInArrow(_confirm_partners, "a long, b long"), "links")


def _name_partners(batches):
    for t in runs(batches, ["bucket", "bi", "bj"]):
        ids, comp, block = (t.column(c).to_numpy() for c in ("_id", "comp", "block"))
        bits = np.stack([t.column(b).to_numpy() for b in _BITS], 1).view(np.uint64)
        bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), BANDS)
        band, two = int(t.column("band")[0].as_py()), t.column("bi")[0] != t.column("bj")[0]
        partners: list = [None] * len(ids)
        seen = np.zeros(len(ids), bool)
        for i in range(len(ids)):
            ok = (ids > ids[i]) & (comp != comp[i])
            if two:
                ok &= block != block[i]
            j = np.flatnonzero(ok)
            j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64) <= MAX_BITS]
            if len(j) and band:  # an earlier bucket of both has seen the pair
                j = j[~(bands[j, :band] == bands[i, :band]).any(1)]
            if len(j):
                partners[i] = ids[j].tolist()
                seen[i] = True
                seen[j] = True
        keep = np.flatnonzero(seen)
        if len(keep):
            t = t.take(pa.array(keep))
            cols = [t.column(c).combine_chunks() for c in ("bucket", "bi", "bj", "_id", "comp")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([partners[k] or [] for k in keep], pa.list_(pa.int64()))],
                                             ["bucket", "bi", "bj", "_id", "comp", "partners"])


def _confirm_partners(batches):
    for t in runs(batches, ["bucket", "bi", "bj"]):
        ids, comp = t.column("_id").to_pylist(), t.column("comp").to_pylist()
        at: dict[int, list[int]] = {}
        for k, i in enumerate(ids):  # a repeated id has several texts
            at.setdefault(i, []).append(k)
        sets = list(textops.shingle_sets(t.column("_text")))
        root = {c: c for c in comp}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        links = []
        for k, (i, others) in enumerate(zip(ids, t.column("partners").to_pylist())):
            x = sets[k]
            for o in others:
                for j in at[o]:
                    p, q = find(comp[k]), find(comp[j])
                    if p == q:  # joined meanwhile: this pair can't change the components
                        break
                    y = sets[j]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= THRESHOLD * (len(x) + len(y) - both):
                        links.append((i, o))
                        root[p] = q
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])


def _label(df: DataFrame, comp: DataFrame) -> DataFrame:
    return (df.join(comp.select(F.col("id").alias("_k"), "comp"), F.col("_id") == F.col("_k"), "left")
            .withColumn("comp", F.coalesce("comp", "_id")).drop("_k"))
