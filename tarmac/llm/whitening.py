"""Embedding whitening by shifted CholeskyQR.

Rows whose vector is null or holds null or non-finite entries are dropped. Each
entry c becomes the integer x = floor(1024 c) + 100000; the n remaining rows are the
fit list. S is the exact sum of x per dimension and y = x - S / n the centred row, taken as
the exact difference to the whole part of S / n minus its fraction.

With Y the centred rows (columns scaled by powers of two to a variance near one), a pass
over the rows adds up the Gram matrix G = Q' Q of Q = Y R^-1 (R = identity at first;
every row goes through the triangular solves inside its task). The first G gets a shift
that is large enough for its Cholesky factor to exist whatever the rounding; the factor
is composed into R, and passes go on until G is the identity to rounding. Then Y = Q R
with orthonormal Q, and the singular value decomposition of the small R gives Y's:
components are its right singular vectors, eigenvalues of the covariance sigma^2 / n.
Squaring a badly conditioned Y once would lose its small directions; the repeated
passes bring them back.

Dependent columns (what is left of their variance beside the others is below ``RANK`` of
it, by a pivoted factorisation of the first Gram matrix) do not enter Q; the passes also
return Q' Y for them, which are their columns of R. So constant, repeated or zero
dimensions and fewer rows than dimensions give as many components as there are
directions with variance.

On Spark: the rows are written once as packed integers; each pass is one scan, a task
returns one d x d matrix, and these are added up by rows of the matrix in a shuffle, so
the driver gets d rows whatever the number of tasks. Nothing else is collected.

Edge cases: vectors of different lengths have fit lists of their own; an empty vector
has no components, neither have equal rows or a single one; entries too large for
floor(1024 c) to be a long (|c| >= 2^52) raise an error, for they have no x;
``deviation`` beyond a long is null; repeated rows and ids count as often as
they come; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.base import Scratch

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: a column is dependent if less than this share of its variance is left beside the others
RANK = 1e-12
#: largest entry of G - I at which the passes end, and their number at most
TIGHT, PASSES = 1e-13, 6
SLICE = 4096
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def _rows(batches):
    """Batches (…, x binary) -> (batch, integer matrix) in slices of some MB."""
    for b in batches:
        for lo in range(0, b.num_rows, SLICE):
            part = b.slice(lo, SLICE)
            raw = part.column(part.schema.get_field_index("x")).to_pylist()
            yield part, np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), -1)


LOW = 31  # sums are added up by low bits and the rest, so they cannot overflow


def _sums(batches):
    """Exact sums of a task's rows, per dimension."""
    high = low = None
    for _, x in _rows(batches):
        h, v = (x >> LOW).sum(0), (x & ((1 << LOW) - 1)).sum(0)
        high, low = (h, v) if high is None else (high + h, low + v)
    if high is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high))), pa.array(high), pa.array(low)], ["i", "high", "low"])


class Centre:
    """n and the exact sums S; rows minus their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.mean = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean).astype(np.float64) - self.rest

    def deviation(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact sums of (n x - S)^2 and which of them fit a long."""
        far = np.abs(self(x)).max(1) * self.n
        fits = far * far * x.shape[1] < 2.0 ** 62
        off = np.where(fits[:, None], x - self.mean, 0) * self.n - np.where(fits[:, None], np.round(self.rest * self.n).astype(np.int64), 0)
        out = (off * off).sum(1)
        for i in np.flatnonzero(~fits).tolist():
            exact = sum((self.n * v - s) ** 2 for v, s in zip(x[i].tolist(), self.sums))
            fits[i], out[i] = (True, exact) if exact < 1 << 63 else (False, 0)
        return out, fits


def solve_right(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """y R^-1 for an upper triangular R, by forward substitution over the columns."""
    q = np.array(y, np.float64, order="F")
    for j in range(r.shape[0]):
        if j:
            q[:, j] -= q[:, :j] @ r[:j, j]
        q[:, j] /= r[j, j]
    return q


def _gram(centre: Centre, scale: np.ndarray, cols: np.ndarray, other: np.ndarray, factors: list[np.ndarray]):
    """Q' [Q, Y other] of a task's rows, row by row; Q = Y cols after the triangular solves."""
    def work(batches):
        g = None
        for _, x in _rows(batches):
            y = centre(x) / scale
            q = y[:, cols]
            for r in factors:
                q = solve_right(q, r)
            part = q.T @ np.concatenate([q, y[:, other]], 1)
            g = part if g is None else g + part
        if g is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(g))), pa.array([v.tobytes() for v in g], pa.binary())], ["i", "g"])
    return work


def _add(batches):
    """Sums of equal rows of the tasks' matrices."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            v = np.frombuffer(raw, np.float64)
            held[i] = held[i] + v if i in held else v
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["i", "g"])


def summed(parts: DataFrame) -> np.ndarray:
    """The sum of the tasks' matrices; one row per dimension reaches the driver."""
    total = parts.repartition("i").mapInArrow(_add, "i long, g binary").collect()
    return np.stack([np.frombuffer(r.g, np.float64) for r in sorted(total, key=lambda r: r.i)])


def independent(g: np.ndarray) -> np.ndarray:
    """Columns, in their order, that a pivoted Cholesky factorisation of G takes."""
    a, own = g.copy(), g.diagonal().copy()
    left, taken = [j for j in range(len(g)) if own[j] > 0], []
    while left:
        p = max(left, key=lambda j: a[j, j] / own[j])
        if a[p, p] <= RANK * own[p]:
            break
        taken.append(p)
        left.remove(p)
        v = a[:, p] / np.sqrt(a[p, p])
        a -= np.outer(v, v)
    return np.array(sorted(taken), np.int64)


class Whitening:
    """What ``fit`` learns of the rows of one length."""

    def __init__(self, centre: Centre, components: np.ndarray, values: np.ndarray, trace: float, passes: int):
        self.centre, self.passes = centre, passes
        self.components, self.values, self.trace = components, values, trace

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.components.T / np.sqrt(self.values)


def fit(rows: DataFrame, centre: Centre, k: int = COMPONENTS) -> Whitening:
    """Passes of shifted CholeskyQR over ``rows (x binary)`` and the SVD of R."""
    n, d = centre.n, len(centre.sums)
    x = rows.select("x")

    def gram(scale, cols, other, factors):
        return summed(x.mapInArrow(_gram(centre, scale, cols, other, factors), "i long, g binary"))

    nothing, everything = np.empty(0, np.int64), np.arange(d)
    whole = gram(np.ones(d), everything, nothing, [])
    spread = np.sqrt(whole.diagonal() / n)
    scale = np.exp2(np.round(np.log2(np.where(spread > 0, spread, 1.0))))
    whole = whole / np.outer(scale, scale)
    cols = independent(whole)
    w = len(cols)
    if not w:
        return Whitening(centre, np.empty((0, d)), np.empty(0), 0.0, 1)
    other = np.setdiff1d(everything, cols)
    g, factors, r, passes = whole[np.ix_(cols, cols)], [], np.eye(w), 1
    unit = np.finfo(np.float64).eps / 2
    while True:
        # the first pass is shifted; later Gram matrices come close to the identity
        shift = 0.0 if factors else min(11 * (n * w + w * (w + 1)) * unit * np.linalg.norm(g, 2), 1e-3 * float(g.diagonal().min()))
        while True:
            try:
                up = np.linalg.cholesky(g + shift * np.eye(w)).T
                break
            except np.linalg.LinAlgError:  # not definite to rounding: a larger shift, one more pass
                shift = max(10 * shift, unit * float(np.trace(g)))
        factors.append(up)
        r = up @ r
        got = gram(scale, cols, other, factors)
        g, cross = got[:, :w], got[:, w:]
        passes += 1
        if np.abs(g - np.eye(w)).max() <= TIGHT * max(1.0, np.sqrt(n) / 1000) or passes >= PASSES:
            break
    low = np.linalg.cholesky(g)  # the rest that the last pass measured
    full = np.zeros((w, d))
    full[:, cols] = low.T @ r
    full[:, other] = np.linalg.solve(low, cross)
    sigma, vt = np.linalg.svd(full * scale, full_matrices=False)[1:]
    values = sigma ** 2 / n
    vt = vt[:k]
    vt = vt * np.where(vt[np.arange(len(vt)), np.abs(vt).argmax(1)] < 0, -1.0, 1.0)[:, None]  # largest entry positive
    return Whitening(centre, vt, values[:k], float(values.sum()), passes)


def _project(w: Whitening):
    """First and second moments of a task's whitened rows."""
    def work(batches):
        k = len(w.values)
        s, g, m = np.zeros(k), np.zeros((k, k)), 0
        for _, x in _rows(batches):
            z = w.project(x)
            s, g, m = s + z.sum(0), g + z.T @ z, m + len(z)
        if m:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + 1)), pa.array([v.tobytes() for v in [s, *g]], pa.binary())], ["i", "g"])
    return work


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    mean, *second = summed(rows.select("x").mapInArrow(_project(w), "i long, g binary")) / w.centre.n
    return float(np.abs(np.stack(second) - np.outer(mean, mean) - np.eye(len(mean))).max())


def _results(w: Whitening):
    def work(batches):
        k = len(w.values)
        for b, x in _rows(batches):
            z = w.project(x)
            deviation, fits = w.centre.deviation(x)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, w.centre.n)),
                 pa.array(np.repeat(deviation, k), mask=np.repeat(~fits, k)), pa.array(z.ravel()),
                 pa.array(np.tile(w.values / w.trace, len(x)))], [c.split()[0] for c in RESULT.split(", ")])
    return work


def _integers(batches):
    """(id, d, x) of every vector: x as packed longs."""
    for b in batches:
        ids, vecs = b.column(0), b.column(1).to_pylist()
        out = []
        for v in vecs:
            f = np.floor(np.array(v, np.float64) * SCALE)
            if len(f) and np.abs(f).max() >= 2.0 ** 62:
                raise ValueError(f"entry too large for exact integers of scale {SCALE}: {max(v, key=abs)}")
            out.append((f.astype(np.int64) + OFFSET).tobytes())
        yield pa.RecordBatch.from_arrays([ids, pa.array([len(v) for v in vecs], pa.int32()), pa.array(out, pa.binary())], ["id", "d", "x"])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "whitening")
    v = F.col("v")
    fine = v.isNotNull() & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = scratch.put(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
                       .where(fine).mapInArrow(_integers, "id long, d int, x binary"), "integers")
    out = spark.createDataFrame([], RESULT + ", identity_error double")
    for r in rows.groupBy("d").agg(F.count("*").alias("n")).orderBy("d").collect():  # vector lengths: one or a few
        mine = rows.where(F.col("d") == r.d)
        if not r.d:
            continue
        got = (mine.select("x").mapInArrow(_sums, "i long, high long, low long")
               .groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())  # one row per dimension
        w = fit(mine, Centre(r.n, [(x.high << LOW) + x.low for x in sorted(got, key=lambda x: x.i)]), k)
        if len(w.values):
            out = out.unionByName(mine.select("id", "x").mapInArrow(_results(w), RESULT)
                                  .withColumn("identity_error", F.lit(identity_error(mine, w))))
    return out.withColumnRenamed("vec_id", id_col)
