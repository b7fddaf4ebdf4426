"""Property tests: the bucketed rolling mean equals the plain RANGE window, and
the equi-joined nearest observation equals a brute-force search."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.operators import baselines as bl
from tarmac.operators import features as feat

T0 = dt.datetime(2022, 1, 1)


def _window_mean(df):
    """The plain RANGE window over whole keys."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    w = (Window.partitionBy(*bl.ROUTE).orderBy(F.unix_micros(F.col("sched_dep_tstz")))
         .rangeBetween(-30 * 86_400 * 10**6, -(10**6)))
    return df.withColumn("trailing_avg", F.avg("dep_delay_min").over(w))


_delay = st.one_of(st.none(), st.integers(-30, 300).map(float), st.floats(-1e6, 1e6, allow_nan=False),
                   st.sampled_from([float("nan"), float("inf"), float("-inf")]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["AA", "BB", None]), st.integers(0, 90 * 24), _delay, st.booleans()),
                min_size=1, max_size=40))
def test_bucketed_equals_window(spark, rows):
    import math

    from pyspark.sql import functions as F
    data = [(i, c, "JFK", "LAX", T0 + dt.timedelta(hours=h), v, w) for i, (c, h, v, w) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, carrier string, origin string, dest string, "
                                     "sched_dep_tstz timestamp, dep_delay_min double, w boolean")
    a = {r.i: r.trailing_avg for r in bl.rolling_mean(df, bl.ROUTE, "sched_dep_tstz", "dep_delay_min", 30).collect()}
    b = {r.i: r.trailing_avg for r in _window_mean(df).collect()}
    some = bl.rolling_mean(df, bl.ROUTE, "sched_dep_tstz", "dep_delay_min", 30, wanted=F.col("w")).collect()
    assert {r.i for r in some} == {r[0] for r in data if r[6]} and set(a) == set(b)

    def same(x, y):
        if x is None or y is None or math.isnan(x) or math.isinf(x):
            return (x is None) == (y is None) and (x is None or repr(x) == repr(y))
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6)

    assert all(same(a[i], b[i]) for i in a) and all(same(r.trailing_avg, b[r.i]) for r in some)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["S1", "S2"]), st.integers(0, 48 * 60)), max_size=30),
       st.lists(st.tuples(st.sampled_from(["S1", "S2", "S3"]), st.integers(0, 47)), min_size=1,
                max_size=20))
def test_nearest_matches_brute_force(spark, obs, deps):
    wx = [(s, T0 + dt.timedelta(minutes=m), float(i)) for i, (s, m) in enumerate(obs)]
    w = spark.createDataFrame(wx or [("S9", T0, 0.0)], "station_id string, time timestamp, temp double")
    fx = spark.createDataFrame([(s, T0 + dt.timedelta(hours=h)) for s, h in deps],
                               "station_id string, dep_hr_bin timestamp")
    got = {(r.station_id, r.dep_hr_bin): r.temp for r in feat.attach_weather(fx, w).collect()}
    for s, h in deps:
        b = T0 + dt.timedelta(hours=h)
        cands = [(abs((t - b).total_seconds()), t, v) for ss, t, v in wx
                 if ss == s and abs((t - b).total_seconds()) <= 1800]
        want = min(cands)[2] if cands else None
        assert got[(s, b)] == want


def _py_cut(x, lo, hi, w, include_lowest):
    """Plain right-closed cut: bin k covers (lo + (k-1) w, lo + k w]."""
    if x is None:
        return None
    n = round((hi - lo) / w)
    for k in range(1, n + 1):
        a, b = lo + (k - 1) * w, lo + k * w
        if (a < x <= b) or (include_lowest and k == 1 and x == a):
            return k
    return None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-120, 520).map(lambda v: v / 2)), min_size=1,
                max_size=40),
       st.sampled_from([(-50, 50, 5, False), (0, 240, 10, True), (0, 105, 5, True)]))
def test_cut_matches_python(spark, xs, spec):
    from pyspark.sql import functions as F

    from tarmac.functions.bins import cut_index
    lo, hi, w, inc = spec
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(cut_index(F.col("x"), lo, hi, w, inc)).collect()]
    assert got == [_py_cut(x, lo, hi, w, inc) for x in xs]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-100, 300), st.one_of(st.none(), st.integers(-100, 300))),
                min_size=1, max_size=50))
def test_metrics_match_numpy(spark, pairs):
    import numpy as np

    from tarmac.operators.evaluate import error_metrics
    df = spark.createDataFrame([("m", "s", float(t), None if p is None else float(p)) for t, p in pairs],
                               "model string, split string, truth double, pred double")
    r = error_metrics(df, "truth", "pred", digits=None).first()
    err = np.array([p - t for t, p in pairs if p is not None], dtype=float)
    assert r.n == len(pairs)
    if len(err) == 0:
        assert r.mae is None and r.median_ae is None
        return
    assert abs(r.mae - np.mean(np.abs(err))) < 1e-9
    assert abs(r.rmse - np.sqrt(np.mean(err ** 2))) < 1e-9
    assert abs(r.bias - np.mean(err)) < 1e-9
    assert abs(r.median_ae - np.median(np.abs(err))) < 1e-9
    assert abs(r.p90_ae - np.quantile(np.abs(err), 0.9)) < 1e-9
