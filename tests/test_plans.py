"""Physical-plan properties the design relies on."""

import contextlib
import io

from tarmac.plans.registry import QUERIES

from tables import SF01


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF01).explain("formatted")
    return buf.getvalue()


def test_nearest_join_is_equi_join_with_map_side_top1(spark):
    p = _plan(spark, "features_left")
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "HashJoin" in p or "SortMergeJoin" in p
    assert p.count("WindowGroupLimit") >= 4          # partial + final, weather and flights


def test_rolling_mean_has_no_per_key_range_frame(spark):
    p = _plan(spark, "rolling_30d_backfilled")
    assert "RangeFrame" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_metrics_use_no_exact_percentile_aggregate(spark):
    p = _plan(spark, "metrics")       # the sketch pass is checkpointed before this plan
    assert "percentile(" not in p.replace("percentile_approx(", "")
    assert "median(" not in p


def test_scans_are_pruned(spark):
    p = _plan(spark, "late_flag")
    read = [ln for ln in p.splitlines() if "ReadSchema" in ln]
    assert read and all("props" not in ln and "user_id" not in ln for ln in read)
    p = _plan(spark, "seasonality")
    read = [ln for ln in p.splitlines() if "ReadSchema" in ln]
    assert all("o_orderstatus" not in ln and "c_acctbal" not in ln for ln in read)


def test_bucketed_sides_join_without_an_exchange(spark):
    p = _plan(spark, "features_bucketed")
    assert "SortMergeJoin" in p and "Exchange" not in p and "Bucketed: true" in p


def test_coverage_counts_below_both_joins(spark):
    p = _plan(spark, "weather_coverage")
    tree = p[:p.index("\n\n")].splitlines()
    upper = [i for i, ln in enumerate(tree) if "Join" in ln][:2]  # the fixture's weather holds a join of its own
    below = [ln for ln in tree[upper[1]:] if "HashAggregate" in ln]
    assert len(below) >= 4  # flights and readings, partial and final each


def test_kept_totals_read_only_their_span(spark, tmp_path):
    """Older months of the kept totals are not opened: theirs is no Parquet file."""
    import datetime as dt

    from tarmac.operators import baselines as bl
    cols = "carrier string, origin string, dest string, sched_dep_tstz timestamp, dep_delay_min double"
    rows = [("AA", "JFK", None, dt.datetime(2022, m, d, 8), float(m + d)) for m in range(1, 8) for d in (1, 20)]
    rows.append(("AA", "JFK", None, dt.datetime(2022, 6, 25), float("nan")))
    train = spark.createDataFrame(rows, cols)
    test = spark.createDataFrame([("AA", "JFK", None, dt.datetime(2022, 8, 2, 9), 1.0), ("AA", "JFK", None, dt.datetime(2022, 8, 9, 9), 3.0),
                                  ("ZZ", "JFK", "LAX", dt.datetime(2022, 8, 2, 9), 1.0), ("AA", "JFK", None, None, 1.0)], cols)
    totals, sums = bl.history_tables(train.where("not isnan(dep_delay_min)"))
    root = tmp_path / "totals"
    totals.write.partitionBy("year", "month").parquet(str(root))
    for m in range(1, 6):
        for f in (root / "year=2022" / f"month={m}").iterdir():
            f.write_bytes(b"not a table" if f.suffix == ".parquet" else b"")
    got = bl.rolling_30d_from_history(spark.read.schema(totals.schema).parquet(str(root)), sums, test).collect()
    want = bl.rolling_30d_backfilled(train.where("not isnan(dep_delay_min)"), test).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 4
