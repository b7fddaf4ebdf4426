"""End-to-end: landed CSV/JSON files -> partitioned flights -> features."""

import gzip
import json

from pyspark.sql import functions as F

from tarmac import jobs
from tarmac.operators import models as mdl

HDR = ('"Year","Month","DayofMonth","FlightDate","IATA_CODE_Reporting_Airline",'
       '"Flight_Number_Reporting_Airline","Origin","Dest","CRSDepTime","DepDelay","Cancelled"')


def test_ingest_and_features(spark, tmp_path):
    land = tmp_path / "ontime"
    land.mkdir()
    (land / "2022_01.csv").write_text(
        HDR + '\n2022,1,3,"2022-01-03","AA","1","JFK","LAX","0700",12.00,0.00\n'
              '2022,1,3,"2022-01-03","AA","2","JFK","SFO","0930",,1.00\n')
    (land / "2022_02.csv").write_text(
        HDR + '\n2022,2,1,"2022-02-01","DL","3","JFK","ATL","2400",-4.00,0.00\n')
    flights_root = str(tmp_path / "parquet")
    assert jobs.ingest_range(spark, [str(land)], flights_root, "2022-01", "2022-02") == [(2022, 1), (2022, 2)]
    assert jobs.ingest_range(spark, [str(land)], flights_root, "2022-01", "2022-02") == []
    air = tmp_path / "airports.dat"
    air.write_text('1,"Kennedy","NY","US","JFK","KJFK",0,0,0,0,"A","America/New_York","airport","x"\n')
    st = tmp_path / "stations.json"
    st.write_text(json.dumps([{"id": "72503", "identifiers": {"icao": "KJFK"}}]))
    wdir = tmp_path / "wx" / "2022"
    wdir.mkdir(parents=True)
    with gzip.open(wdir / "72503.csv.gz", "wt") as f:
        f.write("year,month,day,hour,temp,rhum,prcp,wdir,wspd,pres,coco\n"
                "2022,1,3,12,1.0,50,0,10,5,1000,2\n"       # 07:00 New York = 12:00 UTC
                "2022,2,2,5,3.0,50,0,10,5,1000,2\n")       # 2400 on Feb 1 = 05:00 UTC Feb 2
    out = str(tmp_path / "features")
    weather = str(tmp_path / "weather")
    kw = dict(weather_files=[str(wdir / "72503.csv.gz")], weather_root=weather, airports_csv=str(air), stations_json=str(st))
    assert jobs.ingest_range(spark, [str(land)], flights_root, "2022-01", "2022-02", do_coverage=True, **kw) == []
    seen = spark.read.parquet(f"{weather}/hourly")
    assert sorted((r.year, r.month, r.temp) for r in seen.collect()) == [(2022, 1, 1.0), (2022, 2, 3.0)]
    assert spark.read.parquet(f"{weather}/crosswalk").first().meteostat_id == "72503"
    cover = spark.read.option("header", True).csv(f"{weather}/coverage").first()
    assert (cover.total_flights, cover.with_weather) == ("3", "0")
    months = jobs.build_features_range(spark, flights_root, [str(wdir / "72503.csv.gz")], str(air),
                                       str(st), out, "2022-01", "2022-02")
    assert months == [(2022, 1), (2022, 2)]
    rows = {r.dest: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"LAX", "ATL"}                    # cancelled flight dropped
    assert rows["LAX"].temp == 1.0 and rows["LAX"].late_15 is False
    assert rows["ATL"].temp == 3.0 and rows["ATL"].dep_hour_local == 5
    landed = str(tmp_path / "features2")
    jobs.build_features_range(spark, flights_root, None, str(air), str(st), landed, "2022-01", "2022-02", weather_root=weather)
    jobs.open_views(spark, flights_root, weather, out)
    assert spark.sql("select count(*) n from features f join flights l on f.dest = l.dest, xwalk, weather").first().n == 4
    cols = ["dest", "temp", "late_15", "year", "month"]
    assert sorted(map(tuple, spark.read.parquet(landed).select(*cols).collect())) == sorted(
        map(tuple, spark.read.parquet(out).select(*cols).collect()))


def test_feature_months_never_erase_each_other(spark, tmp_path):
    land = tmp_path / "ontime"
    land.mkdir()
    line = '2022,{m},{d},"2022-{m:02d}-{d:02d}","AA","{n}","JFK","LAX","{t}",1.00,0.00\n'
    (land / "jan.csv").write_text(HDR + "\n" + line.format(m=1, d=5, n=1, t="0700") + line.format(m=1, d=31, n=2, t="2200"))
    (land / "feb.csv").write_text(HDR + "\n" + "".join(line.format(m=2, d=d, n=d, t="0800") for d in range(1, 11)))
    air = tmp_path / "airports.dat"
    air.write_text('1,"Kennedy","NY","US","JFK","KJFK",0,0,0,0,"A","America/New_York","airport","x"\n')
    st = tmp_path / "stations.json"
    st.write_text(json.dumps([{"id": "72503", "identifiers": {"icao": "KJFK"}}]))
    wx = tmp_path / "72503.csv"
    wx.write_text("year,month,day,hour,temp\n2022,1,5,12,1.0\n2022,2,1,3,2.0\n")
    flights, out = str(tmp_path / "parquet"), str(tmp_path / "features")
    jobs.ingest_range(spark, [str(land)], flights, "2022-01", "2022-02")
    build = lambda m, **kw: jobs.build_features_range(spark, flights, [str(wx)], str(air), str(st), out, m, m, **kw)
    count = lambda: spark.read.parquet(out).count()
    assert build("2022-01") == [(2022, 1)] and count() == 2
    assert build("2022-02") == [(2022, 2)] and count() == 12
    for m in ("2022-02", "2022-01"):
        build(m, overwrite=True)
        assert count() == 12
    late = [r for r in spark.read.parquet(out).collect() if r.sched_dep_tstz.day == 1 and r.sched_dep_tstz.hour == 3]
    assert [(r.month, r.temp) for r in late] == [(1, 2.0)]  # 22:00 in New York, weather of the next UTC month


def test_a_failed_run_leaves_its_months_pending(spark, tmp_path, monkeypatch):
    """A run that dies while it writes leaves no month that counts as complete, and the next
    run replaces what it left."""
    import pytest

    from tarmac.sources import flights as fs
    from tarmac.sources import months as mo
    land, root = tmp_path / "land", str(tmp_path / "flights")
    land.mkdir()
    line = '2022,{m},1,"2022-{m:02d}-01","AA","{n}","JFK","LAX","0700",1.00,0.00\n'
    (land / "old name.csv").write_text(HDR + "\n" + line.format(m=1, n=1) + line.format(m=2, n=2))
    write = fs.write_flights

    def dies(df, out):
        write(df, out)
        raise RuntimeError("lost")

    monkeypatch.setattr(fs, "write_flights", dies)
    with pytest.raises(RuntimeError):
        jobs.ingest_range(spark, [str(land)], root, "2022-01", "2022-02")
    assert mo.existing_months(spark, root).isEmpty() and fs.read_flights(spark, root).count() == 2
    monkeypatch.setattr(fs, "write_flights", write)
    (land / "old name.csv").rename(land / "new name.csv")
    assert jobs.ingest_range(spark, [str(land)], root, "2022-01", "2022-02") == [(2022, 1), (2022, 2)]
    assert fs.read_flights(spark, root).count() == 2  # the failed run's rows are gone


def test_eda_job_reads_a_month_once(spark, tmp_path):
    """All tables from month states equal the operators; a later run reads new and rebuilt months only."""
    from tarmac.operators import eda
    from tarmac.plans import registry as R
    from tarmac.sources import sinks
    from tarmac.sources.ledger import recorded

    from tables import SF001
    root, out = str(tmp_path / "features"), str(tmp_path / "eda")
    hist = R.Ctx(spark, SF001).history
    t = F.col("sched_dep_tstz")
    rows = hist.drop("flight_id").withColumns({"year": F.year(F.date_sub(t, 1)), "month": F.month(F.date_sub(t, 1))})

    def land(months):
        with recorded(spark, root, months):
            sinks.write_features(rows.where((F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months])), root)

    early = [(1995, m) for m in range(1, 13)] + [(1994, 12)]
    rest = [tuple(r) for r in rows.select("year", "month").distinct().collect() if tuple(r) not in early]
    land(early)
    assert set(jobs.refresh_states(spark, root, f"{out}/states")) == set(early)
    land(rest)
    land([(1995, 3)])
    paths = jobs.write_eda(spark, root, out, "1995-01-01", "2001-08-01", min_flights=10)
    assert jobs.refresh_states(spark, root, f"{out}/states") == []
    assert len(paths) == 15
    whole = eda.eda_window(hist, "1995-01-01", "2001-08-01")
    for name, want in (("monthly_counts", eda.monthly_counts(hist)), ("seasonality", eda.seasonality(whole)), ("delay_by_temp", eda.delay_by_temp(whole)),
                       ("missing_by_month", eda.missing_by_month(whole)), ("airport_summary", eda.airport_summary_labeled(whole, 10)),
                       ("delay_histogram", eda.delay_histogram(whole)), ("origin_sanity", eda.origin_sanity(hist)), ("tail_stats", eda.tail_stats(whole))):
        got = spark.read.schema(want.schema).option("header", True).csv(paths[name])
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())), name


def test_feature_checks_are_written(spark, tmp_path):
    root, out = str(tmp_path / "features"), str(tmp_path / "checks")
    _history(spark, root)
    tables = jobs.feature_checks(spark, root, [(2000, 1), (2000, 2)], out)
    n = int(spark.read.option("header", True).csv(f"{out}/count").first().n)
    assert n == spark.read.parquet(root).where("year = 2000 and month in (1, 2)").count() > 0
    assert spark.read.option("header", True).csv(f"{out}/busiest_origins").count() == tables["busiest_origins"].count() <= 10
    assert spark.read.option("header", True).csv(f"{out}/earliest_rows").count() == 5


def test_study_window_prunes_month_partitions(spark, tmp_path):
    import contextlib
    import datetime as dt
    import io

    from tarmac.operators.features import FEATURE_COLUMNS
    from tarmac.operators.filters import study_window
    from tarmac.sources.sinks import write_features
    rows = [("AA", "JFK", "LAX", dt.datetime(2022, m, 10, 8), 5, 1) + (None,) * 10 + (None, 10.0, False)
            for m in (1, 2, 3)]
    df = spark.createDataFrame(rows, ", ".join(
        f"{c} {t}" for c, t in zip(FEATURE_COLUMNS, ["string"] * 3 + ["timestamp_ntz", "long", "long"]
                                   + ["double"] * 10 + ["int", "double", "boolean"])))
    df = df.withColumns({"year": F.year("sched_dep_tstz"), "month": F.month("sched_dep_tstz")})
    root = str(tmp_path / "features")
    write_features(df, root)
    w = study_window(spark.read.parquet(root), "2022-02-01", "2022-03-01")
    assert [r.month for r in w.collect()] == [2]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        w.explain()
    assert "PartitionFilters: [" in buf.getvalue() and "month" in buf.getvalue().split("PartitionFilters: [")[1][:400]


def _history(spark, root):
    from tables import SF001
    from tarmac.operators.features import FEATURE_COLUMNS
    from tarmac.plans.fixtures import fx_history
    from tarmac.sources.sinks import write_features
    t = F.col("sched_dep_tstz")
    write_features(fx_history(spark, SF001).select(*FEATURE_COLUMNS, F.year(t).alias("year"), F.month(t).alias("month")), root)


def test_train_baseline_on_partitioned_features(spark, tmp_path):
    import math

    import pytest

    from tarmac.sources import sinks
    root, out = str(tmp_path / "features"), str(tmp_path / "models")
    _history(spark, root)
    train_months = [(2000, m) for m in range(1, 13)]
    got = jobs.train_baseline(spark, root, train_months, (2001, 1), out)
    m = got["metrics"]
    assert all(math.isfinite(m[c]) for c in ("baseline30d_mae", "glmnet_mae", "glmnet_rmse")) and m["glmnet_rmse"] >= m["glmnet_mae"]
    model = sinks.load_metadata(spark, got["files"]["model"])
    assert model["penalty"] == 0.01 and "unknown" not in model["medians"] and len(model["terms"]) > 50
    # the stored model gives the reported error again, on the month's own rows
    test = spark.read.parquet(root).where("year = 2001 and month = 1")
    again = mdl.elastic_net_predict(test, model)
    assert again.columns == [*test.columns, "prediction"] and again.select(*test.columns).exceptAll(test).isEmpty()
    assert math.isclose(again.agg(F.avg(F.abs(F.col("prediction") - F.col("dep_delay_min")))).first()[0], m["glmnet_mae"], abs_tol=1e-5)
    # kept totals give the same baseline; a month that is written anew is read again, no other
    from tarmac.sources.ledger import recorded
    history = str(tmp_path / "history")
    with recorded(spark, root, [*train_months, (2001, 1)]):
        pass
    kept = jobs.train_baseline(spark, root, train_months, (2001, 1), history_root=history)["metrics"]
    assert kept == m
    with recorded(spark, root, [(2000, 6)]):
        pass
    assert jobs.refresh_history(spark, root, history) == [(2000, 6)] and jobs.refresh_history(spark, root, history) == []
    assert jobs.train_baseline(spark, root, train_months, (2001, 1), history_root=history)["metrics"] == m
    for months, test, what in (([*train_months, (2035, 1)], (2001, 1), "2035/month=1|year=2035"), (train_months, (2030, 1), "test features")):
        with pytest.raises(ValueError, match=what):
            jobs.train_baseline(spark, root, months, test)


def test_model_jobs_write_all_outputs(spark, tmp_path):
    from tarmac.plans.queries_baselines import SPLITS, STUDY_END, STUDY_START
    from tarmac.sources import sinks
    root, out = str(tmp_path / "features"), str(tmp_path / "models")
    _history(spark, root)
    study = (STUDY_START, STUDY_END)
    metrics = {(r.model, r.split): r for r in jobs.train_ridge(spark, root, out, study, SPLITS, n_lambdas=10).collect()}
    assert len(metrics) == 4
    stored = {(r.model, r.split): r.mae for r in sinks.read_small_csv(spark, f"{out}/metrics_baseline_v2", sinks.METRICS_SCHEMA).collect()}
    assert stored == {k: r.mae for k, r in metrics.items()}
    counts = {r.split: r.n for r in sinks.read_small_csv(spark, f"{out}/split_counts", "split string, n long").collect()}
    pred = spark.read.parquet(f"{out}/predictions")
    assert {r.split: r["count"] for r in pred.groupBy("split").count().collect()} == {k: counts[k] for k in ("validation", "test")}
    # the flights' own keys, not the levels they were aligned to
    own = {(r.sched_dep_tstz, r.carrier, r.origin, r.dest) for r in spark.read.parquet(root).collect()}
    assert {(r.sched_dep_tstz, r.carrier, r.origin, r.dest) for r in pred.collect()} <= own
    ridge = sinks.load_metadata(spark, f"{out}/ridge_model")
    assert ridge["best_lambda"] in ridge["lambdas"] and len(ridge["terms"]) > 30
    both = jobs.train_trees(spark, root, out, study, SPLITS, max_rounds=3).collect()
    assert sorted({r.model for r in both}) == ["glmnet_ridge", "rolling_avg_90d", "xgboost_v1"] and len(both) == 6
    model, meta = sinks.load_model(spark, f"{out}/tree_model")
    assert meta["best_iteration"] == sum(hasattr(s, "trees") for s in model.stages)
    trees = spark.read.parquet(f"{out}/tree_predictions")
    assert trees.count() == pred.count() and set(trees.columns) == {"split", "truth", "pred", "err"}
