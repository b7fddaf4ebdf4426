"""Toxicity by weak supervision.

1. Voters. From a bounded sample of labelled training rows (``MAX_LABELLED``,
   chosen by hash; copies and near copies of a text, the groups of ``op4`` within
   the sample, count once per label, all other texts count) take the words and word
   beginnings that favour toxic texts, at most ``MAX_FEATURES``; they are dealt
   out to lexicon voters and pattern voters, beside voters for shouting,
   repeated marks, stretched letters and masked words. A voter votes toxic where
   one of its entries occurs and else abstains.
2. Label model. One pass over *all* documents counts votes and joint votes. Under
   a hidden label y the covariance of two independent voters is g_i g_j, so every
   triple of voters gives g_i = sqrt(C_ij C_ik / C_jk); its median and the label
   share give each voter's hit rates on toxic and clean texts. What C_ij has
   beyond g_i g_j is the correlation of i and j; correlated voters share weight.
3. Classifier. A logistic regression on the features learns the label model's
   posteriors on a bounded sample of documents (``MAX_TRAIN``), which lets features
   speak where voters abstain; two numbers calibrated on the labelled training
   rows put the threshold at 0.5.

Inputs of a score are the text's words alone. Edge cases: a null or empty text
has no hits and gets the base score; documents without a label are scored like
others; several labels of a document count as toxic if any is; without labelled
toxic and clean rows every score is the share of toxic labels (0 without
labels); repeated rows are scored each; words of more than 40 or fewer than 3 bytes are no
features (they still count by their beginnings); very long texts are scored whole; an
empty table gives an empty result; other columns are ignored, whatever their names."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.base import Scratch
from tarmac.llm.near import near_duplicates

MAX_LABELLED = 20_000
MAX_TRAIN = 20_000
MAX_FEATURES = 1_000
WORD_VOTERS, START_VOTERS = 16, 8
STARTS = (4, 5, 6)  # bytes of a word's beginning
#: a feature stands in so many toxic texts of the sample, or this share of them
MIN_TOXIC, MIN_SHARE, MIN_LIFT = 3, 0.006, 25.0
_SHAPES = [re.compile(p) for p in (rb"(?:\b[A-Z]{3,}\b\W+){3}", rb"[!?]{3,}", rb"([A-Za-z])\1{3,}", rb"\b[A-Za-z]+[*#$@]{2,}[A-Za-z]*")]
N_VOTERS = WORD_VOTERS + START_VOTERS + len(_SHAPES)
_PLAIN = bytearray(range(256))
for _c in range(128):
    ch = chr(_c)
    _PLAIN[_c] = ord(ch.lower()) if ch.isalnum() else 32
_PLAIN = bytes(_PLAIN)


def features(raw: bytes) -> set[bytes]:
    """Words of a text (ASCII marks and spaces part them) and their beginnings."""
    words = set(raw.translate(_PLAIN).split())
    out = {b"w" + w for w in words if 2 < len(w) <= 40}
    for k in STARTS:
        out |= {b"s" + w[:k] for w in words if len(w) > k}
    return out


def bucket(doc: str = "doc") -> F.Column:
    """crc32 of the id as text, mod 5; 0 is held out."""
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit(""))) % 5


def _sampled(rows: DataFrame, n: int, most: int, seed: int) -> DataFrame:
    """About ``most`` of ``n`` rows (all of fewer) by a hash of the id, so that no task
    sends more than its share; a little less than ``most``, to stay below it."""
    share = min(1.0, (most - 4 * most**0.5) / max(n, 1))
    return rows.where(F.pmod(F.xxhash64("doc", F.lit(seed)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))) if n > most else rows


def _texts(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    row = F.col(row_col) if row_col else F.lit(None)
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").cast("binary").alias("text"), row.cast("long").alias("row"))


def without_copies(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One of the labelled ``rows (doc, text, toxic)`` per near-duplicate group and
    label: the one with the smallest id. Texts without words are copies of each other."""
    rows = scratch.put(rows.select("doc", "text", "toxic", F.monotonically_increasing_id().alias("row")), "sample")
    group = near_duplicates(rows.select("row", "text"), "row").select(
        "row", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(-1).alias("copies"))
    first = F.min_by("text", F.struct("doc", F.xxhash64("text"), "row")).alias("text")
    return scratch.put(rows.join(group, "row").groupBy("copies", "toxic").agg(first).select("text", "toxic"), "distinct")


def learn_features(rows: DataFrame, scratch: Scratch) -> list[bytes]:
    """The toxic features of labelled ``rows (doc, text, toxic)``."""
    def work(batches):
        for b in batches:
            fs = [sorted(features(x.as_py() or b"")) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(fs, pa.list_(pa.binary()))], ["toxic", "fs"])

    seen = without_copies(rows, scratch).mapInArrow(work, "toxic int, fs array<binary>")
    n = seen.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    if not n.t or not n.c:
        return []
    per = seen.select("toxic", F.explode("fs").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    lift = ((F.col("t") + 0.5) / (n.t + 1)) / ((F.col("c") + 0.5) / (n.c + 1))
    top = (per.where(F.col("t") >= max(MIN_TOXIC, MIN_SHARE * n.t)).withColumn("lift", lift).where(F.col("lift") >= MIN_LIFT)
           .orderBy((F.col("t") * F.log("lift")).desc(), "f").limit(MAX_FEATURES))
    return [bytes(r.f) for r in top.select("f").collect()]


def voter_of(lexicon: list[bytes]) -> list[int]:
    words = starts = 0
    out = []
    for f in lexicon:
        if f[:1] == b"w":
            out.append(words % WORD_VOTERS)
            words += 1
        else:
            out.append(WORD_VOTERS + starts % START_VOTERS)
            starts += 1
    return out


def hits_table(texts: DataFrame, lexicon: list[bytes]) -> DataFrame:
    """``doc, row, hits (indices of lexicon entries, then of shapes), votes (bit mask)``."""
    deal, n = voter_of(lexicon), len(lexicon)
    words = {f[1:]: i for i, f in enumerate(lexicon) if f[:1] == b"w"}
    starts = {f[1:]: i for i, f in enumerate(lexicon) if f[:1] == b"s"}

    def work(batches):
        for b in batches:
            hits, votes = [], []
            for x in b.column(1):
                raw = x.as_py() or b""
                own = set(raw.translate(_PLAIN).split())
                h = [words[w] for w in own & words.keys()]
                for k in STARTS:
                    h += [starts[w] for w in {w[:k] for w in own if len(w) > k} & starts.keys()]
                mask = 0
                for i in h:
                    mask |= 1 << deal[i]
                for j, p in enumerate(_SHAPES):
                    if p.search(raw):
                        h.append(n + j)
                        mask |= 1 << (WORD_VOTERS + START_VOTERS + j)
                hits.append(h)
                votes.append(mask)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(hits, pa.list_(pa.int32())), pa.array(votes, pa.int64())],
                                             ["doc", "row", "hits", "votes"])

    return texts.mapInArrow(work, "doc long, row long, hits array<int>, votes long")


def joint_votes(hits: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents and the matrix of joint votes, over all rows."""
    per = hits.groupBy("votes").agg(F.count("*").alias("n"))
    bits = F.expr(f"filter(sequence(0, {N_VOTERS - 1}), i -> (shiftright(votes, i) & 1L) = 1L)")
    pairs = (per.select("n", bits.alias("b")).select("n", "b", F.explode("b").alias("i"))
             .select("n", "i", F.explode("b").alias("j")).groupBy("i", "j").agg(F.sum("n").alias("n")))
    m = np.zeros((N_VOTERS, N_VOTERS))
    for r in pairs.collect():  # at most N_VOTERS squared rows
        m[r.i, r.j] = r.n
    return hits.count(), m


def label_model(n: int, joint: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weight of each voter's vote and the prior's log odds."""
    rate = np.diag(joint) / max(n, 1)
    cov = joint / max(n, 1) - np.outer(rate, rate)
    g = np.zeros(len(rate))
    for i in range(len(rate)):
        tri = [np.sqrt(cov[i, j] * cov[i, k] / cov[j, k]) for j in range(len(rate)) for k in range(j)
               if i not in (j, k) and min(cov[i, j], cov[i, k], cov[j, k]) > 1e-9]
        g[i] = np.median(tri) if tri else 0.0
    sd = np.sqrt(np.clip(rate * (1 - rate), 1e-12, None))
    extra = np.clip((cov - np.outer(g, g)) / np.outer(sd, sd), 0, 1)
    np.fill_diagonal(extra, 0)
    share = 1 / (1 + np.where(extra > 0.05, extra, 0).sum(1))
    hit = np.clip(rate + g * np.sqrt((1 - prior) / prior), 1e-4, 1 - 1e-4)
    miss = np.clip(rate - g * np.sqrt(prior / (1 - prior)), 1e-4, 1 - 1e-4)
    flat = g < 1e-6
    return np.where(flat, 0, share * np.log(hit / miss)), float(np.log(prior / (1 - prior)))


def posterior(votes: np.ndarray, w: np.ndarray, base: float) -> np.ndarray:
    """Probability of toxic given the votes; an abstention says nothing."""
    return _sigmoid(base + ((votes[:, None] >> np.arange(len(w))) & 1) @ w)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, l2: float, rounds: int = 25) -> np.ndarray:
    """Newton steps on rows that stand for ``n`` documents with the mean label ``y``;
    the last column of x is the constant and is hardly shrunk."""
    w, pen = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    pen[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        grad = x.T @ (n * (p - y)) + pen * w
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pen), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _patterns(hits: list, label: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct feature sets as 0/1 rows with a constant, mean label, count."""
    seen: dict[tuple, list[float]] = {}
    for h, q in zip(hits, label):
        s = seen.setdefault(tuple(sorted(h)), [0.0, 0.0])
        s[0] += q
        s[1] += 1
    x = np.zeros((len(seen), width + 1))
    x[:, -1] = 1
    for i, h in enumerate(seen):
        x[i, list(h)] = 1
    total, n = np.array(list(seen.values())).T
    return x, total / n, n


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", row_col: str | None = None) -> DataFrame:
    """``id_col, held_out, score, predicted`` of every row of ``docs``. With ``row_col``, a
    number per row, the result carries it too, so that rows without an id or with
    a repeated one are told apart."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = (labels.select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("int").alias("toxic"))
             .where("doc is not null and toxic is not null").groupBy("doc").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
             .where(bucket() != 0))
    known = scratch.put(known, "labels")
    known = F.broadcast(scratch.put(_sampled(known, known.count(), MAX_LABELLED, 0), "labelled"))  # MAX_LABELLED rows of 12 bytes
    texts = _texts(docs, id_col, text_col, row_col)
    lexicon = learn_features(texts.join(known, "doc"), scratch)
    hits = scratch.put(hits_table(texts, lexicon), "hits")
    width = len(lexicon) + len(_SHAPES)
    taught = hits.join(known, "doc").dropDuplicates(["doc"]).select("hits", "toxic").toPandas()
    prior = float(taught.toxic.mean()) if len(taught) else 0.0
    model = None
    if lexicon and 0 < prior < 1:
        n, joint = joint_votes(hits)
        w, base = label_model(n, joint, prior)
        sample = _sampled(hits, n, MAX_TRAIN, 1).where(bucket() != 0).select("hits", "votes").toPandas()
        q = posterior(sample.votes.to_numpy(np.int64), w, base)
        coef = fit_logistic(*_patterns(list(sample.hits), q, width), l2=0.1)
        x, y, n = _patterns(list(taught.hits), taught.toxic.to_numpy(float), width)
        fit = fit_logistic(np.stack([x @ coef, np.ones(len(x))], 1), y, n, l2=1e-3)
        model = (coef * fit[0], float(fit[1]))

    def work(batches):
        for b in batches:
            h = b.column(2).to_pylist()
            score = np.full(len(h), prior)
            if model is not None:
                coef, shift = model
                score = _sigmoid(np.array([coef[x].sum() + coef[-1] for x in h]) + shift) if h else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64())], ["doc", "row", "score"])

    out = hits.select("doc", "row", "hits").mapInArrow(work, "doc long, row long, score double")
    return out.select(F.col("doc").alias(id_col), *([F.col("row").alias(row_col)] if row_col else []), (bucket() == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
