"""Hand-made edge rows for the semantic traps (time zones, NULLs, bins,
windows, ties, level handling, metrics, early stopping)."""

import datetime as dt

from pyspark.sql import functions as F

from tarmac.functions import bins, flags, timeparts as tp
from tarmac.operators import baselines as bl
from tarmac.operators import evaluate as ev
from tarmac.operators import features as feat
from tarmac.operators.boosting import best_round
from tarmac.operators import prep as pp
from tarmac.operators import stations as st


def test_hhmm_parsing_and_2400(spark):
    df = spark.createDataFrame([("0005",), (" 600",), ("2359",), ("2400",), (None,)], "h string")
    got = [r[0] for r in df.select(tp.hhmm_minutes(F.col("h"))).collect()]
    assert got == [5, 360, 1439, 1440, None]
    ts = df.select(tp.local_schedule(F.lit("2022-01-01").cast("date"), F.col("h")).alias("t"))
    assert ts.collect()[3]["t"] == dt.datetime(2022, 1, 2, 0, 0)
    utc = spark.range(1).select(tp.to_ntz(tp.sched_dep_utc(
        F.lit("2022-01-01").cast("date"), F.lit("2400"), F.lit("America/New_York"))).alias("t"))
    assert utc.first()["t"] == dt.datetime(2022, 1, 2, 5, 0)
    hour = spark.range(1).select(tp.crs_dep_hour(F.lit("2022-01-01").cast("date"), F.lit("2400")))
    assert hour.first()[0] is None


def test_dst_gap_and_overlap(spark):
    import duckdb
    rows = [("2022-03-13", "0230"), ("2022-11-06", "0130"), ("2022-11-06", "0030"),
            ("2022-11-06", "0200"), ("2022-11-06", "0059"), ("2022-07-01", "1200")]
    df = spark.createDataFrame(rows, "d string, h string")
    col = lambda how: tp.to_ntz(tp.sched_dep_utc(
        F.col("d").cast("date"), F.col("h"), F.lit("America/New_York"), how))
    later = [r[0] for r in df.select(col("later")).collect()]
    earlier = [r[0] for r in df.select(col("earlier")).collect()]
    assert later[:2] == [dt.datetime(2022, 3, 13, 7, 30), dt.datetime(2022, 11, 6, 6, 30)]
    assert earlier[:2] == [dt.datetime(2022, 3, 13, 7, 30), dt.datetime(2022, 11, 6, 5, 30)]
    con = duckdb.connect()
    for (d, h), got in zip(rows, later):
        y, m, dd = map(int, d.split("-"))
        want = con.execute(f"select make_timestamptz({y}, {m}, {dd}, {int(h[:2])}, {int(h[2:])}, 0.0, "
                           f"'America/New_York') at time zone 'UTC'").fetchone()[0]
        assert got == want, (d, h)


def test_session_vs_airport_hour_and_dow(spark):
    f = spark.createDataFrame([(dt.datetime(2022, 1, 2, 3, 0), "America/Los_Angeles"),
                               (dt.datetime(2022, 1, 8, 12, 0), "UTC")],
                              "sched_dep_tstz timestamp, tz string")
    s = feat.calendar_features(f, "session").collect()
    a = feat.calendar_features(f, "airport").collect()
    assert s[0]["dep_hour_local"] == 3 and a[0]["dep_hour_local"] == 19
    assert s[0]["dow"] == 0 and a[0]["dow"] == 6            # Sunday in UTC, Saturday in LA
    assert s[1]["dow"] == 6


def test_positive_part_and_late_flag(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.0,), (14.0,), (15.0,)], "d double")
    rows = df.select(flags.positive_part(F.col("d")), flags.late_flag(F.col("d"))).collect()
    assert [r[0] for r in rows] == [None, 0.0, 0.0, 14.0, 15.0]
    assert [r[1] for r in rows] == [None, False, False, False, True]


def test_nearest_weather_edges_and_ties(spark):
    bin_ = dt.datetime(2022, 1, 1, 10, 0)
    m = dt.timedelta(minutes=1)
    w = spark.createDataFrame(
        [("S1", bin_ - 30 * m, 1.0), ("S1", bin_ + 30 * m, 2.0), ("S2", bin_ - 30 * m, 3.0),
         ("S2", bin_ + 30 * m, 4.0), ("S2", bin_, 5.0), ("S3", bin_ + 31 * m, 6.0)],
        "station_id string, time timestamp, temp double")
    near = {(r.station_id, r.bin): r.temp for r in feat.nearest_weather(w).collect()}
    assert near[("S1", bin_)] == 1.0                      # tie at +/-30: earlier one
    assert near[("S2", bin_)] == 5.0                      # exact hour wins
    assert ("S3", bin_) not in near                       # 31 minutes: not eligible
    assert near[("S3", bin_ + 60 * m)] == 6.0


def test_flight_dedup_fixed_choice(spark):
    t = dt.datetime(2022, 1, 1, 10, 0)
    f = spark.createDataFrame([(2, "AA", "JFK", "LAX", t, 5.0), (1, "AA", "JFK", "LAX", t, 5.0),
                               (3, "AA", "JFK", "LAX", t, None)],
                              "flight_id long, carrier string, origin string, dest string, "
                              "sched_dep_tstz timestamp, dep_delay_min double")
    rows = feat.flight_dedup(f).collect()
    assert [r.flight_id for r in rows] == [1]


def test_cut_bins(spark):
    t = spark.createDataFrame([(-50.0,), (-45.0,), (50.0,), (50.1,), (None,)], "x double")
    got = [r[0] for r in t.select(bins.cut_index(F.col("x"), -50, 50, 5)).collect()]
    assert got == [None, 1, 20, None, None]
    labels = [r[0] for r in t.select(bins.cut_label(F.col("x"), -50, 50, 5)).collect()]
    assert labels == [None, "(-50,-45]", "(45,50]", None, None]
    w = spark.createDataFrame([(0.0,), (10.0,), (10.1,), (240.0,), (241.0,)], "x double")
    got = [r[0] for r in w.select(bins.cut_index(F.col("x"), 0, 240, 10, True)).collect()]
    assert got == [1, 1, 2, 24, None]
    assert w.select(bins.cut_label(F.col("x"), 0, 240, 10, True)).first()[0] == "[0,10]"
    h = spark.createDataFrame([(2.5,), (2.6,), (-60.0,)], "x double")
    assert [r[0] for r in h.select(bins.hist_center(F.col("x"), 5)).collect()] == [0.0, 5.0, -60.0]


def _roll_rows(spark):
    base = dt.datetime(2022, 3, 1, 12, 0)
    day, sec = dt.timedelta(days=1), dt.timedelta(seconds=1)
    rows = [("AA", "JFK", "LAX", base, 10.0),
            ("AA", "JFK", "LAX", base, 20.0),                  # same instant: excluded
            ("AA", "JFK", "LAX", base - 30 * day, 30.0),       # exactly 30 days: included
            ("AA", "JFK", "LAX", base - 30 * day - sec, 1000.0),  # 30 days + 1 s: excluded
            ("AA", "JFK", "LAX", base - sec, None),            # NULL value ignored
            (None, "JFK", "LAX", base, 7.0), (None, "JFK", "LAX", base - day, 9.0)]
    return spark.createDataFrame(rows, "carrier string, origin string, dest string, "
                                       "sched_dep_tstz timestamp, dep_delay_min double")


def test_rolling_window_bounds(spark):
    out = bl.rolling_mean(_roll_rows(spark), bl.ROUTE, "sched_dep_tstz", "dep_delay_min", 30)
    got = [(r.carrier or "", r.sched_dep_tstz, r.dep_delay_min, r.trailing_avg) for r in out.collect()]
    base = dt.datetime(2022, 3, 1, 12, 0)
    at_base = [g for g in got if g[1] == base and g[0] == "AA"]
    assert {g[3] for g in at_base} == {30.0}
    assert [g[3] for g in got if g[0] == "" and g[1] == base] == [9.0]


def test_null_keys_match_in_90d_only(spark):
    h = spark.createDataFrame([(None, "A", "B", 5, 1, dt.date(2022, 11, 20), 40.0),
                               ("X", "A", "B", 5, 1, dt.date(2022, 12, 21), 0.0)],
                              "carrier string, origin string, dest string, dep_hour_local long, "
                              "dow long, dep_date date, dep_delay_min double")
    new = h.limit(0).unionByName(spark.createDataFrame(
        [(None, "A", "B", 5, 1, dt.date(2023, 1, 5), 1.0)], h.schema))
    pred = bl.rolling_avg_90d(h, new, "2023-01-01").first()["pred_rolling_avg"]
    assert pred == 40.0                                     # NULL carrier matched NULL carrier
    train = h.withColumn("sched_dep_tstz", F.col("dep_date").cast("timestamp"))
    test = new.withColumn("sched_dep_tstz", F.col("dep_date").cast("timestamp"))
    out = bl.rolling_30d_backfilled(train, test).first()["yhat_baseline"]
    assert out == 20.0                                      # no NULL match: global mean


def test_level_alignment_variants(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    rows = spark.createDataFrame([("z",), (None,), ("",), ("a",)], "c string")
    la = pp.category_levels(train, ["c"], "other")
    assert [r.level for r in la.orderBy("idx").collect()] == ["a", "b", "other"]
    a = [r.c for r in pp.align_levels(rows, la, ["c"], "other").collect()]
    assert a == ["other", "other", "other", "a"]
    lb = pp.category_levels(train, ["c"], "missing")
    assert [r.level for r in lb.orderBy("idx").collect()] == ["a", "b", "missing", "other"]
    b = [r.c for r in pp.align_levels(rows, lb, ["c"], "missing").collect()]
    assert b == ["other", "missing", "missing", "a"]


def test_all_null_train_column_median_zero(spark):
    t = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    med = {r.feature: r.median for r in pp.train_medians(t, ["a", "b"]).collect()}
    assert med == {"a": 0.0, "b": 2.0}


def test_metrics_definition(spark):
    df = spark.createDataFrame([("m", "s", 0.0, e) for e in (1.0, 2.0, 3.0, 4.0)]
                               + [("m", "s", 0.0, None)],
                               "model string, split string, truth double, pred double")
    r = ev.error_metrics(df, "truth", "pred").first()
    assert r.n == 5 and r.mae == 2.5 and r.median_ae == 2.5 and abs(r.p90_ae - 3.7) < 1e-9
    assert r.bias == 2.5 and abs(r.rmse - (7.5 ** 0.5)) < 1e-6


def test_patience_rule():
    down = [10.0 - i for i in range(5)]
    assert best_round(down + [6.0] * 39 + [4.0], 40) == 45      # 39-round plateau: goes on
    assert best_round(down + [6.0] * 40 + [4.0], 40) == 5       # 40 rounds: stops


def test_sentinel_airports(spark):
    a = spark.createDataFrame([("AAA", "\\N", "UTC"), ("BBB", "KBBB", "\\N"), ("CCC", "KCCC", ""),
                               ("DDD", "KDDD", "UTC")], "iata string, icao string, tz string")
    assert [r.iata for r in st.sentinel_filter(a).collect()] == ["DDD"]


def test_coverage_fan_out_and_dedupe(spark):
    fl = spark.createDataFrame([(1, dt.date(2022, 1, 1), "0700", "JFK"), (2, dt.date(2022, 1, 1), "0815", "JFK")],
                               "flight_id long, flight_date date, crs_dep_time string, origin string")
    xw = spark.createDataFrame([("JFK", "KJFK", "S1"), ("JFK", "KJFK", "S2")],
                               "iata string, icao string, meteostat_id string")
    wx = spark.createDataFrame([("S1", dt.datetime(2022, 1, 1, 7), 1.0)],
                               "station_id string, time timestamp, temp double")
    parity = feat.weather_coverage(fl, xw, wx).first()
    assert (parity.total_flights, parity.with_weather) == (4, 1)      # two stations per flight
    once = feat.weather_coverage(fl, xw, wx, dedupe=True).first()
    assert (once.total_flights, once.with_weather) == (2, 1)


def test_test_rows_feed_later_test_predictions(spark):
    cols = "carrier string, origin string, dest string, sched_dep_tstz timestamp, dep_delay_min double"
    train = spark.createDataFrame([("AA", "JFK", "LAX", dt.datetime(2022, 11, 1, 8), 100.0)], cols)
    test = spark.createDataFrame([("AA", "JFK", "LAX", dt.datetime(2022, 12, 2, 8), 10.0),
                                  ("AA", "JFK", "LAX", dt.datetime(2022, 12, 3, 8), 0.0)], cols)
    out = {r.sched_dep_tstz.day: r.yhat_baseline
           for r in bl.rolling_30d_backfilled(train, test).collect()}
    assert out[2] == 100.0          # window empty -> train route mean
    assert out[3] == 10.0           # the earlier test row feeds the window


def test_model_input_guards(spark):
    import pytest

    from tarmac.operators import filters as flt
    df = spark.createDataFrame([("2022-03-01 10:15:00", 5.0, None), ("garbage", 1.0, None)],
                               "sched_dep_tstz string, dep_delay_min double, dow long")
    assert flt.tolerant_select(df, ["dep_delay_min", "nope"]).columns == ["dep_delay_min"]
    with pytest.raises(ValueError, match="carrier"):
        flt.require_columns(df, ["sched_dep_tstz", "carrier"])
    ts = flt.ensure_timestamp(df).collect()
    assert ts[0].sched_dep_tstz == dt.datetime(2022, 3, 1, 10, 15) and ts[1].sched_dep_tstz is None
    w = flt.study_window(df, "2022-01-01", "2023-01-01").collect()
    assert len(w) == 1 and w[0].dep_hour_local == 10 and w[0].dow == "Tue"       # all-NULL dow refilled
    sp = flt.chrono_split(flt.study_window(df, "2022-01-01", "2023-01-01"),
                          [("train", "2022-01-01", "2022-03-01"), ("test", "2022-03-01", "2022-04-01")])
    assert [r.split for r in sp.collect()] == ["test"]


def test_scale_conf_sizing():
    from tarmac.session import scale_conf
    big = scale_conf(100e12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) >= 100e12 / (256 << 20)
    small = scale_conf(1e6, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24          # three waves of 8 cores
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
