"""Block moments, the fits from them and level tables against dense numpy work."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.operators import models as mdl
from tarmac.operators import moments as mo
from tarmac.operators import prep as pp
from tarmac.plans import registry as R

from tables import SF001

RNG = np.random.default_rng(3)
N, LEVELS = 600, (5, 9)


def frame(spark, n=N):
    """(DataFrame, design matrix, target): two factors (the first level of each has no column),
    two numerics; rows without a target and of another split beside them."""
    f = [RNG.integers(0, k, n) for k in LEVELS]
    f[1][: n // 3] = 4  # a hot level
    num = np.column_stack([RNG.normal(1000, 5, n), RNG.integers(0, 2, n)])
    y = 3.0 * (f[0] == 2) - 2.0 * (f[1] == 4) + 0.3 * num[:, 0] + RNG.normal(size=n)
    width = sum(LEVELS) - 2
    x = np.zeros((n, width + 2))
    cols = []
    for k, (v, first) in enumerate(zip(f, (0, LEVELS[0] - 1))):
        at = np.where(v > 0, v - 1 + first, -1)
        x[np.flatnonzero(v > 0), at[v > 0]] = 1
        cols.append([int(a) if a >= 0 else None for a in at])
    x[:, width:] = num
    rows = [("train", a, b, float(c), float(d), float(t)) for a, b, (c, d), t in zip(*cols, num, y)]
    rows += [("train", 1, 6, 5.0, 1.0, None), ("validation", 1, 6, 5.0, 1.0, 2.0)]
    return spark.createDataFrame(rows, "split string, a int, b int, u double, v double, y double").repartition(3), x, y, width


def entries_matrix(m, size):
    out = np.zeros((size, size))
    for r in m.entries.collect():
        assert r.i <= r.j and out[r.i, r.j] == 0
        out[r.i, r.j] = out[r.j, r.i] = r.value
    return out


def test_entries_are_the_design_s_products(spark):
    df, x, y, width = frame(spark)
    m = mo.split_moments(df, ["a", "b"], width, ["u", "v"], "y")
    assert set(m) == {"train", "validation"}
    z = np.column_stack([x, np.ones(len(y)), y])
    want = z.T @ z
    assert np.allclose(entries_matrix(m["train"], width + 4), want, rtol=1e-12)
    assert m["train"].entries.where("value = 0").isEmpty()
    assert np.allclose(m["train"].dense(np.arange(width + 4)), want) and m["train"].n == len(y)
    assert np.allclose(m["train"].sums, want[-2]) and np.allclose(m["train"].cross, want[-1])
    v = RNG.normal(size=width + 4)
    assert np.allclose(m["train"].dot(v), want @ v)
    far = mo.Moments(m["train"].entries, width + 4, limit=3)  # held in Spark, not on the driver
    assert far.local is None and np.allclose(far.dot(v), want @ v) and np.allclose(far.dense(np.arange(3)), want[:3, :3])
    both = m["train"] + m["validation"]
    extra = np.zeros(width + 4)
    extra[[1, 6, width, width + 1, width + 2, width + 3]] = 1, 1, 5, 1, 1, 2
    assert np.allclose(entries_matrix(both, width + 4), want + np.outer(extra, extra))


def test_no_target_no_entries(spark):
    df, _, _, width = frame(spark, 9)
    assert mo.split_moments(df.where("y is null"), ["a", "b"], width, ["u", "v"], "y") == {}
    alone = mo.split_moments(df, [], 0, ["u", "v"], "y")["train"]
    assert alone.size == 4 and alone.n == 9


@pytest.mark.parametrize("limit", [10 ** 6, 5])
def test_conjugate_gradients_equal_the_dense_path(spark, limit):
    df, x, y, width = frame(spark)
    m = mo.split_moments(df, ["a", "b"], width, ["u", "v"], "y")["train"]
    dense, sparse = mo.RidgePath(m), mo.RidgePath(mo.Moments(m.entries, m.size, limit), dense=0)
    lams = dense.lambdas(7) if limit > 5 else dense.lambdas(7)[:2]
    assert sparse.values is None and np.allclose(dense.r, sparse.r)
    sd = x.std(0)
    for (b0, b), (c0, c), lam in zip(dense.fits(lams), sparse.fits(lams), lams):
        xs, ys = (x - x.mean(0)) / sd, (y - y.mean()) / y.std()
        want = np.linalg.solve(xs.T @ xs / len(y) + np.eye(x.shape[1]) * lam / y.std(), xs.T @ ys / len(y)) * y.std() / sd
        assert np.allclose(b, want, atol=1e-8) and np.allclose(c, want, atol=1e-7)
        assert math.isclose(b0, y.mean() - x.mean(0) @ want, abs_tol=1e-4) and math.isclose(c0, b0, abs_tol=1e-4)


@pytest.mark.parametrize("penalty,mixture", [(0.5, 0.5), (0.05, 1.0), (2.0, 0.0), (1e4, 0.5)])
def test_elastic_net_meets_its_optimality_conditions(spark, penalty, mixture):
    df, x, y, width = frame(spark)
    m = mo.split_moments(df, ["a", "b"], width, ["u", "v"], "y")["train"]
    b0, coef = mo.elastic_net(m, penalty, mixture)
    sd, y_sd = x.std(0, ddof=1), y.std(ddof=1)
    xs, ys = (x - x.mean(0)) / sd, (y - y.mean()) / y_sd
    b = coef * sd / y_sd
    slope = xs.T @ (ys - xs @ b) / len(y) - penalty / y_sd * (1 - mixture) * b
    edge = penalty / y_sd * mixture
    assert np.allclose(slope[b != 0], edge * np.sign(b[b != 0]), atol=1e-7) and (np.abs(slope[b == 0]) <= edge + 1e-7).all()
    assert math.isclose(b0, y.mean() - x.mean(0) @ coef, abs_tol=1e-5)
    if penalty == 1e4:
        assert (coef == 0).all()


def test_any_number_of_levels(spark):
    """20,000 levels align to the same rows as a rule worked by hand; the shuffled join too."""
    train = spark.range(20_000).select(F.format_string("L%05d", "id").alias("c"))
    table = pp.category_levels(train, ["c"])
    assert table.count() == 20_001 and pp.level_lists(table)["c"][-1] == "other"
    rows = spark.createDataFrame([("L00000",), ("L19999",), ("L20000",), (None,), ("",), ("other",)], "c string")
    want = {("L00000", 0), ("L19999", 19_999), ("other", 20_000)}
    got = pp.align_levels(rows, table, ["c"], index="__p")
    assert {(r.c, r["c__p"]) for r in got.collect()} == want and got.count() == 6
    small = pp.DEFAULT_MAX_BROADCAST_ROWS
    try:
        pp.DEFAULT_MAX_BROADCAST_ROWS = 10
        plan = pp.align_levels(rows, table, ["c"], index="__p")
        assert "ResolvedHint (strategy=broadcast)" not in plan._jdf.queryExecution().analyzed().toString()
        assert {(r.c, r["c__p"]) for r in plan.collect()} == want
    finally:
        pp.DEFAULT_MAX_BROADCAST_ROWS = small


def test_levels_that_train_calls_other(spark):
    train = spark.createDataFrame([("z",), ("other",), ("a",), (None,), ("",)], "c string")
    assert pp.level_lists(pp.category_levels(train, ["c"]))["c"] == ["", "a", "z", "other"]
    assert pp.level_lists(pp.category_levels(train, ["c"], "missing"))["c"] == ["a", "missing", "other", "z"]
    assert pp.level_lists(pp.category_levels(train.limit(0), ["c"]))["c"] == ["other"]


def test_wide_ridge_path(spark):
    """A design of some thousand columns: conjugate gradients on the whole path, one scoring
    pass per group of fits, nothing dropped."""
    n = 6_000
    rows = spark.range(n).select(
        F.col("id").alias("flight_id"), F.when(F.col("id") % 10 == 0, "validation").when(F.col("id") % 10 == 1, "test").otherwise("train").alias("split"),
        F.format_string("O%04d", F.col("id") * 7 % 2200).alias("origin"), F.format_string("D%03d", F.col("id") % 90).alias("dest"),
        F.lit("C").alias("carrier"), (F.col("id") % 19).alias("dep_hour_local"), (F.col("id") % 7).alias("dow"), F.lit(1).alias("month"),
        F.lit(None).cast("int").alias("coco"), *[(F.col("id") % k).cast("double").alias(c) for k, c in ((31, "temp"), (13, "wspd"), (5, "rhum"), (11, "pres"), (2, "prcp"), (17, "wdir"))],
        ((F.col("id") * 7 % 2200) % 50 + F.col("id") % 31).cast("double").alias("dep_delay_min"))
    old = mdl.PASS_COEFFICIENTS
    try:
        mdl.PASS_COEFFICIENTS = 4_000
        res = mdl.ridge_path(rows, n_lambdas=5)
    finally:
        mdl.PASS_COEFFICIENTS = old
    assert len(res.model["terms"]) > 1_700 and res.best_lambda == res.lambdas[int(np.argmin(res.valid_mae))]
    got = {r.split: r for r in res.metrics.collect()}
    assert math.isclose(got["validation"].mae, min(res.valid_mae), abs_tol=1e-6) and got["test"].n == 600


def test_recipe_design_matches_its_rows(spark):
    """Design columns of the elastic net: one per level, NULL is a level, an unseen level has none that train uses."""
    hist = R.Ctx(spark, SF001).history
    train, test = hist.where("dep_hour_local < 20"), hist.where("dep_hour_local >= 20").withColumn("dest", F.lit("ZZZ"))
    both, design, learned = mdl.recipe_frame(train, test, keep=["flight_id"])
    names = [f"{c}={lv}" for c in mdl.EN_NOMINAL for lv in learned["levels"][c]]
    assert "carrier=unknown" in names and design.width == len(names)
    own = {r.flight_id: r for r in hist.collect()}
    for r in both.collect():
        assert names[r["origin__j"]] == f"origin={own[r.flight_id].origin}"
        assert names[r["carrier__j"]] == f"carrier={own[r.flight_id].carrier or 'unknown'}"
        assert names[r["dest__j"]] == ("dest=other" if r.split == "test" else f"dest={own[r.flight_id].dest}")
        assert r.temp == (learned["medians"]["temp"] if own[r.flight_id].temp is None else own[r.flight_id].temp)
