"""Model jobs: invariants, not values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.operators import boosting
from tarmac.operators import models as mdl
from tarmac.plans import registry as R
from tarmac.session import written

from tables import SF001


def test_ridge_path_invariants(spark):
    sp = R._split(R.Ctx(spark, SF001))
    res = mdl.ridge_path(sp, n_lambdas=12)
    rows = {r.split: r for r in res.metrics.collect()}
    assert set(rows) == {"validation", "test"}
    for r in rows.values():
        assert r.n > 0 and not math.isnan(r.mae) and r.median_ae <= r.p90_ae
    # the chosen penalty is the argmin of all validation errors, and its error is the reported one
    assert len(res.lambdas) == len(res.valid_mae) == 12 and res.lambdas == sorted(res.lambdas, reverse=True)
    assert res.best_lambda == res.lambdas[int(np.argmin(res.valid_mae))]
    assert math.isclose(min(res.valid_mae), rows["validation"].mae, abs_tol=1e-6)
    assert res.test_pred.where(F.col("pred_glmnet").isNull()).count() == 0


def test_ridge_path_matches_numpy(spark):
    """Moments equal those of the dense design; fits solve the ridge equations."""
    sp = R._split(R.Ctx(spark, SF001))
    aligned, levels, _ = mdl.prepare_ridge(sp)
    aligned = aligned.persist()
    names, design = mdl.ridge_terms(levels), mdl.ridge_design_of(levels)
    moments = mdl.design_moments(aligned, design)["train"]
    train = aligned.where(F.col("split") == "train").select("flight_id", "split", "dep_delay_min", *mdl.pp.RIDGE_FACTORS, *design.columns)
    at = {r.flight_id: i for i, r in enumerate(train.select("flight_id").collect())}
    y = np.array([r[0] for r in train.select("dep_delay_min").collect()])
    x = np.zeros((len(at), len(names)))
    for r in mdl.design_entries(train, levels, ["flight_id"]).collect():
        x[at[r.flight_id], names.index(r.term)] = r.value
    z = np.column_stack([x, np.ones(len(y)), y])
    assert np.allclose(moments.dense(np.arange(z.shape[1])), z.T @ z)
    path = mdl.RidgePath(moments)
    for lam in path.lambdas(3):
        b0, b = path.fit(lam)
        sd = x.std(0)
        live = sd > 1e-9
        xs, ys = (x[:, live] - x[:, live].mean(0)) / sd[live], (y - y.mean()) / y.std()
        want = np.linalg.solve(xs.T @ xs / len(y) + np.eye(live.sum()) * lam / y.std(), xs.T @ ys / len(y)) * y.std() / sd[live]
        assert np.allclose(b[live], want, atol=1e-8) and (b[~live] == 0).all()
        assert math.isclose(b0, y.mean() - x.mean(0) @ b, abs_tol=1e-6)
    pred = {r.flight_id: r.pred_glmnet for r in mdl.linear_predict(train, design, (b0, b)).collect()}
    assert all(math.isclose(pred[k], b0 + x[i] @ b, abs_tol=1e-6) for k, i in at.items())


def test_unseen_levels_still_score(spark):
    sp = R._split(R.Ctx(spark, SF001))
    res = mdl.ridge_path(sp, n_lambdas=3)
    assert res.valid_pred.count() == sp.where(F.col("split") == "validation").count()


@pytest.fixture(scope="module")
def trees(spark):
    x = written(mdl.prepare_tree(R._split(R.Ctx(spark, SF001)))[0].select("flight_id", "split", "dep_delay_min", "features"), "trees")
    return x.where("split = 'train'"), x.where("split = 'validation'")


TREE = dict(maxDepth=3, minInstancesPerNode=10, subsamplingRate=0.8, featureSubsetStrategy="0.8", maxBins=32)


def test_rounds_equal_mllib_s_own_boosting(spark, trees):
    """The same errors after every round and the same predictions as one long fit."""
    from pyspark.ml.regression import GBTRegressor
    train, valid = trees
    run = boosting.boost(train, valid, "dep_delay_min", max_rounds=12, patience=40, block=5, **TREE)
    fit = GBTRegressor(featuresCol="features", labelCol="dep_delay_min", maxIter=12, stepSize=0.05, seed=42, **TREE).fit(train)
    assert np.allclose(run.curve, fit.evaluateEachIteration(valid, "absolute")) and len(run.trees) == 12
    run.best = 12
    a = {r.flight_id: r.prediction for r in run.predict(valid).collect()}
    b = {r.flight_id: r.prediction for r in fit.transform(valid).collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_a_stopped_run_goes_on(spark, trees, tmp_path, monkeypatch):
    """Stopped after its first block, boosting fits only the rounds that lack; other
    parameters start anew."""
    train, valid = trees
    folder, fits = str(tmp_path / "progress"), []
    fit = boosting.RandomForestRegressor.fit

    def counted(self, df):
        if len(fits) == 6 and not stopped:
            stopped.append(1)
            raise RuntimeError("lost")
        fits.append(self.getSeed())
        return fit(self, df)

    stopped: list[int] = []
    monkeypatch.setattr(boosting.RandomForestRegressor, "fit", counted)
    with pytest.raises(RuntimeError):
        boosting.boost(train, valid, "dep_delay_min", max_rounds=9, block=4, folder=folder, **TREE)
    again = boosting.boost(train, valid, "dep_delay_min", max_rounds=9, block=4, folder=folder, **TREE)
    assert fits == [42, 43, 44, 45, 46, 47, 46, 47, 48, 49, 50]  # the first block is not fitted again
    whole = boosting.boost(train, valid, "dep_delay_min", max_rounds=9, block=4, **TREE)
    assert np.allclose(again.curve, whole.curve) and len(again.trees) == 9 and again.best == whole.best
    fits.clear()
    boosting.boost(train, valid, "dep_delay_min", max_rounds=2, block=4, seed=1, folder=folder, **TREE)
    assert fits == [1, 2]


def test_patience_ends_boosting(spark, trees):
    train, valid = trees
    run = boosting.boost(train, valid.withColumn("dep_delay_min", F.rand(1) * 1000), "dep_delay_min", max_rounds=60, patience=3, block=2, **TREE)
    assert len(run.curve) < 60 and run.best == boosting.best_round(run.curve, 3) and run.best + 3 <= len(run.curve)
    none = boosting.boost(train, valid.limit(0), "dep_delay_min", max_rounds=2, block=2, **TREE)
    assert none.best == 1


def test_a_round_fits_rows_that_are_kept(spark, monkeypatch):
    """Every fit passes over its rows several times: they are kept until the next round's are."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(400).selectExpr("cast(id % 20 as double) a", "cast(id % 7 as double) b", "cast((id % 20) * 3 - id % 7 as double) y"))
    seen, real = [], RandomForestRegressor.fit

    def fit(self, df, params=None):
        seen.append("InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString())
        return real(self, df, params) if params else real(self, df)

    monkeypatch.setattr(RandomForestRegressor, "fit", fit)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    run = boosting.boost(rows, rows, "y", max_rounds=5, block=3, maxDepth=3, minInstancesPerNode=1, subsamplingRate=1.0)
    assert len(run.trees) == 5 and run.curve[-1] < run.curve[1]
    assert seen == [True] * 5
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_compared_metrics_split_the_history_once(spark, monkeypatch):
    from types import SimpleNamespace
    from tarmac.plans import queries_baselines as qb
    from tarmac.plans import queries_models as qm
    calls, real = [], qb._split
    for m in (qb, qm):
        monkeypatch.setattr(m, "_split", lambda c: (calls.append(1), real(c))[1])
    none = spark.createDataFrame([], qm.sinks.METRICS_SCHEMA)
    monkeypatch.setattr(qm.mdl, "ridge_path", lambda sp: SimpleNamespace(metrics=none))
    monkeypatch.setattr(qm.mdl, "gbt_run", lambda sp, max_rounds: SimpleNamespace(metrics=none))
    got = R.QUERIES["metrics_comparison"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.model, r.split) for r in got} == {(qm.mdl.MODEL_ROLLING_90D, s) for s in ("validation", "test")}
    assert len(calls) == 1
