"""Second moments of a design and the linear fits that need nothing else.

A design row has one column per factor level (most are zero) and a few dense ones:
the numerics, the constant and the target. Its second moments Z'Z are added up block by
block, never as a matrix:

* factor x factor: rows per (level, level), one count per pair that occurs;
* factor x dense: per level the sums of the dense columns and the number of rows;
* dense x dense: the sums of products, one row.

Each block is a grouped aggregation with partial sums in the scan's tasks, so a hot
level is a few partial rows, and the result is a table ``(split, i, j, value)`` with
i <= j that holds only what occurs. Its size follows the pairs of levels that were seen
together, not the square of the design's width, and the rows that enter it are read
by as many tasks as their files have.

``Moments`` holds such a table for one split: on the driver while it has at most
``DRIVER_ENTRIES`` entries, else in Spark, where a product with a vector is one job.
``RidgePath`` solves all penalties from it: by one dense decomposition up to ``DENSE``
columns, else by conjugate gradients, which advance all penalties with one product a
step. ``elastic_net`` is coordinate descent with soft thresholds over its columns.
The driver holds a few vectors of the design's width."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.session import written

#: design columns up to which the path is solved by a dense decomposition
DENSE = 1_500
#: entries of one split that the driver may hold (24 bytes each)
DRIVER_ENTRIES = 5_000_000


def moment_entries(rows: DataFrame, factors: Sequence[str], width: int, dense: Sequence[str], target: str,
                   split: str = "split") -> DataFrame:
    """(split, i, j, value) of Z'Z, i <= j. ``factors`` name integer columns that hold
    the design column of the row's level, all below ``width`` and those of a later factor
    above those of an earlier one (NULL: no column). The dense columns follow from
    ``width`` on, then the constant and the target. Rows without a target are left out."""
    cols = [F.col(c).cast("double") for c in dense] + [F.lit(1.0), F.col(target).cast("double")]
    names = [f"_d{k}" for k in range(len(cols))]
    base = rows.where(F.col(target).isNotNull()).select(split, *factors, *[c.alias(n) for c, n in zip(cols, names)])

    def some(array: list[Column], keep) -> Column:
        return F.explode(F.filter(F.array(*array), keep))

    def entry(i, j, value) -> Column:
        return F.struct(i.cast("int").alias("i"), F.lit(j).cast("int").alias("j"), value.alias("value"))

    blocks = []
    if len(factors) > 1:
        pairs = [F.struct(F.col(a).cast("int").alias("i"), F.col(b).cast("int").alias("j"))
                 for k, a in enumerate(factors) for b in factors[k + 1:]]
        blocks.append(base.select(split, some(pairs, lambda p: p.i.isNotNull() & p.j.isNotNull()).alias("p"))
                      .groupBy(split, "p.i", "p.j").agg(F.count(F.lit(1)).cast("double").alias("value")))
    if factors:
        levels = base.select(split, *names, some([F.col(c).cast("int") for c in factors], lambda x: x.isNotNull()).alias("i"))
        sums = levels.groupBy(split, "i").agg(F.count(F.lit(1)).cast("double").alias("_n"), *[F.sum(n).alias(n) for n in names])
        mine = [entry(F.col("i"), F.col("i"), F.col("_n")), *[entry(F.col("i"), width + k, F.col(n)) for k, n in enumerate(names)]]
        blocks.append(sums.select(split, F.explode(F.array(*mine)).alias("e")).select(split, "e.*"))
    products = base.groupBy(split).agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for k, a in enumerate(names) for b in names[k:]])
    mine = [entry(F.lit(width + k), width + k + m, F.col(f"{a}{b}")) for k, a in enumerate(names) for m, b in enumerate(names[k:])]
    blocks.append(products.select(split, F.explode(F.array(*mine)).alias("e")).select(split, "e.*"))
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out.where("value <> 0")


class Moments:
    """Z'Z of one split with ``size`` columns, the last two being constant and target."""

    def __init__(self, entries: DataFrame, size: int, limit: int = DRIVER_ENTRIES):
        self.size, self.entries, self.local = size, entries, None
        if entries.limit(limit + 1).count() <= limit:
            got = entries.select("i", "j", "value").toArrow()
            self.local = tuple(got[c].to_numpy() for c in ("i", "j", "value"))
        self.diagonal = self._vector(entries.where("i = j"), "i")
        one, target = size - 2, size - 1
        self.sums = self._vector(entries.where((F.col("j") == one) | ((F.col("i") == one) & (F.col("j") > one))),
                                 F.when(F.col("j") == one, F.col("i")).otherwise(F.col("j")))
        self.cross = self._vector(entries.where(F.col("j") == target), "i")
        self.n = float(self.diagonal[one])

    def _vector(self, df: DataFrame, at) -> np.ndarray:
        """One number per column of the design."""
        at = F.col(at) if isinstance(at, str) else at
        got = df.groupBy(at.cast("int").alias("i")).agg(F.sum("value").alias("v")).toArrow()
        out = np.zeros(self.size)
        out[got["i"].to_numpy()] = got["v"].to_numpy()
        return out

    def __add__(self, other: "Moments") -> "Moments":
        both = self.entries.unionByName(other.entries).groupBy("i", "j").agg(F.sum("value").alias("value"))
        return Moments(written(both, "moments"), self.size)

    def dot(self, v: np.ndarray) -> np.ndarray:
        """Z'Z v."""
        if self.local is not None:
            i, j, x = self.local
            off = i != j
            return np.bincount(i, x * v[j], self.size) + np.bincount(j[off], x[off] * v[i[off]], self.size)

        def work(batches):
            out = np.zeros(len(v))
            for b in batches:
                i, j, x = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
                off = i != j
                out += np.bincount(i, x * v[j], len(v)) + np.bincount(j[off], x[off] * v[i[off]], len(v))
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(out[at])], ["i", "value"])

        return self._vector(self.entries.select("i", "j", "value").mapInArrow(work, "i int, value double"), "i")

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start of each column, rows, values) of the whole matrix, column by column."""
        if self.local is None:
            raise ValueError(f"more than {DRIVER_ENTRIES} pairs of levels: use the ridge path, which needs no columns")
        i, j, x = self.local
        off = i != j
        row, col, val = np.append(i, j[off]), np.append(j, i[off]), np.append(x, x[off])
        by = np.argsort(col, kind="stable")
        return np.searchsorted(col[by], np.arange(self.size + 1)), row[by], val[by]

    def dense(self, at: np.ndarray) -> np.ndarray:
        """The matrix of the columns ``at``."""
        place = np.full(self.size, -1)
        place[at] = np.arange(len(at))
        i, j, x = self.local if self.local is not None else (
            self.entries.select("i", "j", "value").toArrow()[c].to_numpy() for c in ("i", "j", "value"))
        keep = (place[i] >= 0) & (place[j] >= 0)
        out = np.zeros((len(at), len(at)))
        np.add.at(out, (place[i[keep]], place[j[keep]]), x[keep])
        return out + np.triu(out, 1).T


def split_moments(rows: DataFrame, factors: Sequence[str], width: int, dense: Sequence[str], target: str,
                  split: str = "split") -> dict[str, Moments]:
    """The moments of every split, from one written table of entries."""
    table = written(moment_entries(rows, factors, width, dense, target, split), "moments")
    size = width + len(dense) + 2
    names = [r[0] for r in table.select(split).distinct().collect()]  # a handful
    return {s: Moments(table.where(F.col(split) == s).drop(split), size) for s in names}


def shifted_cg(matvec, b: np.ndarray, shifts: Sequence[float], tol: float = 1e-12, steps: int = 5_000) -> np.ndarray:
    """x of (A + s I) x = b for every shift s > 0: one product with A a step for all of
    them, since the residuals of the shifted systems stay parallel. Columns follow ``shifts``."""
    shifts = np.asarray(shifts, float)
    low = shifts.min()
    more = shifts - low
    x, p = np.zeros((len(b), len(shifts))), np.repeat(b[:, None], len(shifts), 1)
    r, q = b.copy(), b.copy()
    rho, alpha, last = float(r @ r), 0.0, 1.0
    now, before = np.ones(len(shifts)), np.ones(len(shifts))
    limit = tol * tol * rho
    for _ in range(steps):
        if rho <= limit:
            break
        a = matvec(q) + low * q
        step = rho / float(q @ a)
        # a system whose residual (now times r) is small enough already stands still
        live = now * now * rho > 1e-4 * limit
        nxt = np.zeros(len(shifts))
        nxt[live] = now[live] * before[live] * last / (
            step * alpha * (before[live] - now[live]) + before[live] * last * (1 + more[live] * step))
        ratio = np.divide(nxt, now, out=np.zeros(len(shifts)), where=live)
        x += step * ratio * p
        r = r - step * a
        new = float(r @ r)
        beta = new / rho
        p = nxt * r[:, None] + beta * ratio ** 2 * p
        q = r + beta * q
        before, now, last, alpha, rho = now, nxt, step, beta, new
    return x


class RidgePath:
    """Ridge fits of one design for any penalty, from its second moments.
    Columns are scaled to unit variance and the target likewise, a penalty is in
    the target's units, as in the published path."""

    def __init__(self, moments: Moments, dense: int = DENSE):
        self.moments, n = moments, moments.n
        mean = moments.sums / n
        sd = np.sqrt(np.clip(moments.diagonal / n - mean * mean, 0, None))
        self.n, self.mean, self.y_sd = n, mean, float(sd[-1]) or 1.0
        x = np.arange(len(mean) - 2)
        self.live = x[sd[:-2] > 1e-9 * np.maximum(1, np.abs(mean[:-2]))]
        self.sd, self.p = sd[self.live], len(x)
        self.r = (moments.cross[self.live] / n - mean[self.live] * mean[-1]) / self.sd / self.y_sd
        self.values = None
        if len(self.live) <= dense:
            cov = moments.dense(self.live) / n - np.outer(mean[self.live], mean[self.live])
            self.values, self.vectors = np.linalg.eigh(cov / np.outer(self.sd, self.sd)) if len(self.live) else (np.zeros(0), np.zeros((0, 0)))

    def lambdas(self, n: int = 100, floor: float = 1e-3) -> list[float]:
        """Log-spaced penalties from the computed largest one (at which a mixture
        with ``floor`` of the absolute penalty would keep no column) down to
        1e-4 of it (1e-2 with more columns than rows)."""
        top = (float(np.abs(self.r).max()) if len(self.r) else 1.0) / floor * self.y_sd or 1.0
        return np.geomspace(top, top * (1e-4 if self.n > self.p else 1e-2), n).tolist()

    def _product(self, v: np.ndarray) -> np.ndarray:
        """The live columns' correlation matrix times v."""
        full = np.zeros(self.moments.size)
        full[self.live] = v / self.sd
        got = self.moments.dot(full)[self.live] / self.n
        return (got - self.mean[self.live] * (self.mean[self.live] @ full[self.live])) / self.sd

    def fits(self, lams: Sequence[float]) -> list[tuple[float, np.ndarray]]:
        """(intercept, coefficient of every design column) for every penalty."""
        shifts = np.asarray(lams, float) / self.y_sd
        if self.values is None:
            scaled = shifted_cg(self._product, self.r, shifts)
        else:
            scaled = self.vectors @ ((self.vectors.T @ self.r)[:, None] / (np.clip(self.values, 0, None)[:, None] + shifts[None]))
        out = []
        for k in range(len(shifts)):
            coef = np.zeros(self.p)
            coef[self.live] = scaled[:, k] * self.y_sd / self.sd
            out.append((float(self.mean[-1] - coef @ self.mean[:-2]), coef))
        return out

    def fit(self, lam: float) -> tuple[float, np.ndarray]:
        return self.fits([lam])[0]


def elastic_net(moments: Moments, penalty: float, mixture: float, tol: float = 1e-10, sweeps: int = 10_000) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) that minimise squared error / 2n + penalty (mixture |b| +
    (1 - mixture) b^2 / 2) over columns of unit sample variance, by coordinate descent."""
    n, size = moments.n, moments.size
    mean = moments.sums / n
    sd = np.sqrt(np.clip(moments.diagonal / n - mean * mean, 0, None) * n / max(n - 1, 1))
    y_sd = float(sd[-1]) or 1.0
    p = size - 2
    live = [k for k in range(p) if sd[k] > 1e-9 * max(1.0, abs(mean[k]))]
    start, rows, values = moments.columns()
    cross = (moments.cross / n - mean * mean[-1]) / y_sd  # with the scaled target
    l1, l2 = penalty / y_sd * mixture, penalty / y_sd * (1 - mixture)
    b, q, u = np.zeros(size), np.zeros(size), 0.0  # b: scaled coefficients; q, u: moments of the fit
    var = np.clip(moments.diagonal / n - mean * mean, 0, None)
    while sweeps:
        sweeps, moved = sweeps - 1, 0.0
        for k in live:
            own = var[k] / (sd[k] * sd[k])
            rest = (cross[k] - (q[k] - mean[k] * u)) / sd[k] + own * b[k]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (own + l2)
            if new != b[k]:
                d = (new - b[k]) / sd[k]
                at = slice(start[k], start[k + 1])
                q[rows[at]] += values[at] / n * d
                u += mean[k] * d
                moved = max(moved, abs(new - b[k]))
                b[k] = new
        if moved <= tol:
            break
    coef = np.zeros(p)
    coef[live] = b[live] * y_sd / sd[live]
    return float(mean[-1] - coef @ mean[:p]), coef
