"""Exact distributed quantiles agree with numpy's linear rule, also with a
hot value holding a third of the rows and with tiny groups."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.operators.quantiles import exact_quantiles


def _np_q(vals, p):
    return float(np.quantile(np.asarray(vals, float), p)) if len(vals) else None


def test_hot_value_and_groups(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("a", 3000), ("b", 7), ("c", 1), ("d", 2)):
        vals = np.round(rng.normal(10, 5, n), 1).tolist()
        if g == "a":
            vals[: n // 3] = [4.0] * (n // 3)          # one value holds a third
        rows += [(g, float(v)) for v in vals]
    rows += [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    assert got["e"]["q_2"] is None                     # only NULLs -> NULL quantiles
    for g in ("a", "b", "c", "d"):
        vals = [v for gg, v in rows if gg == g and v is not None]
        for i, p in enumerate(probs):
            assert abs(got[g][f"q_{i}"] - _np_q(vals, p)) < 1e-9, (g, p)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60),
       st.sampled_from([0.25, 0.5, 0.9]))
def test_property_vs_numpy(spark, vals, p):
    df = spark.createDataFrame([("x", float(v)) for v in vals], "g string, v double")
    got = exact_quantiles(df, ["g"], "v", [p], ["q"]).first()["q"]
    assert abs(got - _np_q(vals, p)) < 1e-9


def test_narrowing_keeps_windows_small(spark):
    """One group of all-distinct values with a tiny tail bound: the bracket is cut
    down before the last window, and results stay exact (ties and infinities too)."""
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(0, 1, 30_000), rng.lognormal(3, 4, 30_000), [float("inf")] * 5, [2.5] * 9000])
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, v double")
    probs = [0.001, 0.25, 0.5, 0.613, 0.9, 0.999]
    got = exact_quantiles(df, ["g"], "v", probs, accuracy=100, max_tail=50).first()
    for i, p in enumerate(probs):
        assert abs(got[f"q_{i}"] - _np_q(vals, p)) <= 1e-9 * max(1, abs(_np_q(vals, p))), p
