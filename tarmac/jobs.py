"""End-to-end jobs over landed files, one Spark job per stage for a whole
month range (no per-month driver loop over data).

* ``ingest_range``          monthly flight CSVs -> partitioned Parquet; station weather
                            files -> observations by month; crosswalk over all months;
                            coverage on request
* ``build_features_range``  flights + airports + stations + weather -> features by the
                            flight's month, only pending months unless overwrite
* ``write_eda``             every exploratory table from one read of new months of features
* ``train_baseline``        30-day rolling baseline + elastic net, model and metrics saved
* ``train_ridge``           90-day averages + ridge path: split counts, metrics,
                            predictions and model saved
* ``train_trees``           boosted trees: metrics, comparison with stored baseline
                            metrics, model, metadata and (optional) predictions saved
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import baselines as bl
from tarmac.operators import eda, profiles
from tarmac.operators import evaluate as ev
from tarmac.operators import features as feat
from tarmac.operators import filters as flt
from tarmac.operators import models as mdl
from tarmac.operators import stations as st
from tarmac.operators.sizing import row_count_at_most
from tarmac.session import configure, drop_path, written
from tarmac.sources import airports as ap
from tarmac.sources import flights as fs
from tarmac.sources import ledger
from tarmac.sources import months as mo
from tarmac.sources import sinks
from tarmac.sources import weather as ws
from tarmac.sources.ledger import recorded
from tarmac.sources.paths import month_path, require_paths


def _month_list(df: DataFrame) -> list[tuple[int, int]]:
    """(year, month) pairs of a month frame - at most a few hundred rows."""
    return [(r["year"], r["month"]) for r in df.orderBy("year", "month").collect()]


def _in_months(df: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of the listed (year, month) partitions, as a partition filter."""
    ym = F.col("year") * 12 + F.col("month")
    return df.where(ym.isin([y * 12 + m for y, m in months]))


def _require_months(spark: SparkSession, root: str, months: Sequence[tuple[int, int]], what: str) -> None:
    """Every listed month has its folder; all that lack one are named."""
    require_paths(spark, [month_path(root, y, m) for y, m in months], what)


def ingest_range(spark: SparkSession, flight_csvs: Sequence[str], out_root: str,
                 start: str, end: str, overwrite: bool = False, weather_files: Sequence[str] | None = None,
                 weather_root: str | None = None, airports_csv: str | None = None, stations_json: str | None = None,
                 stations_cache: str | None = None, do_coverage: bool = False) -> list[tuple[int, int]]:
    """Land the requested months of flights and, where ``weather_files`` are given,
    of weather under ``weather_root`` (``year/month`` partitions, crosswalk in
    ``crosswalk``, ``coverage`` as CSV on request). Months that exist are skipped, for
    flights and weather apart. Returns the months of flights written."""
    configure(spark)
    requested = mo.month_range(spark, start, end)
    months = _month_list(mo.pending_months(requested, mo.existing_months(spark, out_root), overwrite))
    if months:
        rows = _in_months(fs.read_flights_csv(spark, flight_csvs), months)
        with recorded(spark, out_root, months):
            fs.clear_months(spark, out_root, months)
            fs.write_flights(rows, out_root)
    if weather_files:
        landed = f"{weather_root.rstrip('/')}/hourly"
        wanted = _month_list(mo.pending_months(requested, mo.existing_months(spark, landed), overwrite))
        flights = fs.read_flights(spark, out_root)
        if wanted or do_coverage:
            xwalk = written(st.airport_xwalk(ap.read_airports(spark, airports_csv), flights,
                                             ap.read_stations(spark, stations_json, stations_cache)), "crosswalk")
            require_rows(xwalk, "no airport of the flights has a weather station")
        if wanted:
            # the files of the stations in the crosswalk, no others
            t = F.col("time")
            near = xwalk.select(F.col("meteostat_id").alias("station_id"))
            seen = ws.read_weather(spark, weather_files, stations=near).withColumns({"year": F.year(t), "month": F.month(t)})
            with recorded(spark, landed, wanted):
                ws.write_weather(_in_months(seen, wanted).drop("year", "month"), landed)
            ws.write_crosswalk(xwalk, f"{weather_root.rstrip('/')}/crosswalk")
        if do_coverage:
            asked = _month_list(requested)
            cover = feat.weather_coverage(_in_months(flights, asked), xwalk, _in_months(spark.read.parquet(landed), asked))
            sinks.write_small_csv(cover, f"{weather_root.rstrip('/')}/coverage")
    return months


def open_views(spark: SparkSession, flights_root: str, weather_root: str, features_root: str) -> None:
    """``flights``, ``weather``, ``xwalk`` and ``features`` as SQL views over what the jobs landed."""
    sinks.register_views(spark, {"flights": flights_root, "weather": f"{weather_root.rstrip('/')}/hourly",
                                 "xwalk": f"{weather_root.rstrip('/')}/crosswalk", "features": features_root})


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if row_count_at_most(df, 0):
        raise ValueError(message)
    return df


def build_features_range(spark: SparkSession, flights_root: str, weather_files: Sequence[str] | None,
                         airports_csv: str, stations_json: str, out_root: str, start: str,
                         end: str, overwrite: bool = False, how: str = "left",
                         stations_cache: str | None = None,
                         hour_basis: str = "session", weather_root: str | None = None,
                         checks_dir: str | None = None) -> list[tuple[int, int]]:
    """Features for every pending month of ``start..end`` in one job, partitioned by
    the flight's own month. ``hour_basis="airport"`` takes hour and weekday on the
    airport's clock. Weather comes from what ``ingest_range`` landed under
    ``weather_root``, else from the raw files. Both ends read a few days beyond the
    months, so a late flight whose UTC schedule falls into the next month finds its
    weather too (a month-by-month build would leave it NULL). With ``checks_dir`` the
    written months are looked over: number of rows, busiest origins, earliest rows."""
    configure(spark)
    require_paths(spark, [flights_root], "flights")
    todo = mo.pending_months(mo.month_range(spark, start, end),
                             mo.existing_months(spark, out_root), overwrite)
    months = _month_list(todo)
    if not months:
        return []
    flights = fs.read_flights(spark, flights_root, months=months)
    airports = ap.read_airports(spark, airports_csv)
    stations = ap.read_stations(spark, stations_json, stations_cache)
    smap = written(st.station_map(st.airports_in_month(airports, flights), stations), "station-map")
    require_rows(smap, "no airport of the flights has a weather station")
    # observations that can reach a departure of the months: local schedules
    # are within a day of UTC, the join radius is 30 minutes
    (y0, m0), (y1, m1) = months[0], months[-1]
    lo = F.date_sub(F.make_date(F.lit(y0), F.lit(m0), F.lit(1)), 2).cast("timestamp")
    hi = F.date_add(F.last_day(F.make_date(F.lit(y1), F.lit(m1), F.lit(1))), 3).cast("timestamp")
    if weather_root:
        weather = spark.read.parquet(f"{weather_root.rstrip('/')}/hourly")
        ym = F.col("year") * 12 + F.col("month")  # prunes month folders; the exact times follow
        weather = weather.where((ym >= y0 * 12 + m0 - 1) & (ym <= y1 * 12 + m1 + 1)).drop("year", "month")
    else:
        weather = ws.read_weather(spark, weather_files, stations=smap.select("station_id"))
    weather = weather.where((F.col("time") >= lo) & (F.col("time") < hi))
    out = feat.build_features(flights, smap, weather, how=how, hour_basis=hour_basis, keep_month=True)
    with recorded(spark, out_root, months):
        # a month that has no rows any more would keep its old folder
        fs.clear_months(spark, out_root, months)
        sinks.write_features(out, out_root)
    if checks_dir:
        feature_checks(spark, out_root, months, checks_dir)
    return months


def feature_checks(spark: SparkSession, features_root: str, months: Sequence[tuple[int, int]], out_dir: str) -> dict[str, DataFrame]:
    """What a build is looked over by, as small CSV files: ``count``, ``busiest_origins`` and
    ``earliest_rows`` of the months."""
    rows = _in_months(spark.read.parquet(features_root), months)
    tables = {"count": rows.agg(F.count(F.lit(1)).alias("n")), "busiest_origins": eda.origin_sanity(rows),
              "earliest_rows": eda.earliest_rows(rows)}
    for name, df in tables.items():
        sinks.write_small_csv(df, f"{out_dir}/{name}")
    return tables


def _renewed(spark: SparkSession, features_root: str, root: str) -> dict[tuple[int, int], str]:
    """Complete months of features, with the run that wrote them, that ``root`` has not been
    derived from yet."""
    have = ledger.complete_months(spark, root).select("year", "month", F.col("source").alias("run"))
    todo = ledger.complete_months(spark, features_root).select("year", "month", "run").join(have, ["year", "month", "run"], "left_anti")
    return {(r.year, r.month): r.run for r in todo.orderBy("year", "month").collect()}


def refresh_states(spark: SparkSession, features_root: str, states_root: str) -> list[tuple[int, int]]:
    """Bring the month states under ``states_root`` up to date: months of features that have
    none, or were written anew since, are read once; no other month is. Returns them."""
    sources = _renewed(spark, features_root, states_root)
    if sources:
        rows = _in_months(spark.read.parquet(features_root), list(sources))
        states = profiles.month_states(rows, by=("year", "month"))
        with recorded(spark, states_root, list(sources), sources):
            (states.hint("rebalance", "year_read", "month_read").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("year_read", "month_read").parquet(states_root))
    return list(sources)


def refresh_history(spark: SparkSession, features_root: str, history_root: str) -> list[tuple[int, int]]:
    """The same for the tables of the 30-day predictor, ``totals`` and ``sums`` under
    ``history_root``, by the month read and the month of the schedule."""
    sources = _renewed(spark, features_root, history_root)
    if sources:
        read = {"year_read": F.col("year"), "month_read": F.col("month")}
        rows = _in_months(spark.read.parquet(features_root), list(sources)).withColumns(read)
        with recorded(spark, history_root, list(sources), sources):
            for name, df in zip(("totals", "sums"), bl.history_tables(rows, tuple(read))):
                for y, m in sources:
                    drop_path(spark, f"{history_root}/{name}/year_read={y}/month_read={m}")
                (df.hint("rebalance", *read, "year", "month").write.mode("append")
                 .partitionBy(*read, "year", "month").parquet(f"{history_root}/{name}"))
    return list(sources)


def write_eda(spark: SparkSession, features_root: str, out_dir: str, start: str, end: str, **limits) -> dict[str, str]:
    """Every exploratory table over the months of ``[start, end)`` as a small CSV under
    ``out_dir``, from month states kept in ``out_dir/states``: a run reads the features of
    months that are new or were rebuilt, in one scan. Returns the tables' paths."""
    configure(spark)
    require_paths(spark, [features_root], "features")
    refresh_states(spark, features_root, f"{out_dir}/states")
    require_paths(spark, [f"{out_dir}/states"], "complete months of features")
    states = written(profiles.merged(spark.read.parquet(f"{out_dir}/states")), "states")
    paths = {}
    for name, df in profiles.reports(states, start, end, **limits).items():
        paths[name] = f"{out_dir}/{name}"
        sinks.write_small_csv(df, paths[name])
    return paths


def train_baseline(spark: SparkSession, features_root: str, train_months: Sequence[tuple[int, int]],
                   test_month: tuple[int, int], out_dir: str | None = None, history_root: str | None = None) -> dict:
    """30-day baseline MAE and elastic-net MAE / RMSE; the model goes to ``out_dir``. With
    ``history_root`` the 30-day predictor reads tables kept there (brought up to date first)
    instead of every train row.
    Returns ``{"files": {train, test, model}, "metrics": {...}}``; a month without
    features is an error that names it."""
    configure(spark)
    _require_months(spark, features_root, train_months, "train features")
    _require_months(spark, features_root, [test_month], "test features")
    df = spark.read.parquet(features_root)
    train, test, rolled = _in_months(df, train_months), _in_months(df, [test_month]), None
    if history_root:
        refresh_history(spark, features_root, history_root)
        ym = F.col("year_read") * 12 + F.col("month_read")
        kept = [spark.read.parquet(f"{history_root}/{name}").where(ym.isin([y * 12 + m for y, m in train_months])) for name in ("totals", "sums")]
        rolled = bl.rolling_30d_from_history(*kept, test)
    scores, model = mdl.train_baseline(train, test, rolled)
    metrics = scores.first().asDict()
    if out_dir:
        sinks.save_metadata(spark, f"{out_dir}/baseline_delay", model)
        sinks.write_small_csv(scores, f"{out_dir}/metrics_baseline")
    return {"files": {"train": [month_path(features_root, y, m) for y, m in train_months],
                      "test": month_path(features_root, *test_month),
                      "model": f"{out_dir}/baseline_delay" if out_dir else None}, "metrics": metrics}


#: fixed values: the published study window, splits and history cutoffs
STUDY = ("2022-01-01", "2023-04-01")
SPLITS = [("train", "2022-01-01", "2023-01-01"), ("validation", "2023-01-01", "2023-02-01"), ("test", "2023-02-01", "2023-04-01")]
BASELINE_METRICS = "metrics_baseline_v2"


#: what the models read of a feature row
STUDY_COLUMNS = ["sched_dep_tstz", "carrier", "origin", "dest", "dep_hour_local", "dow", "coco", "temp", "wspd", "rhum", "pres",
                 "prcp", "wdir", mdl.TARGET]


def _study_rows(features: DataFrame, study, splits) -> DataFrame:
    """Labelled study rows; hour and day of week are filled where the files lack them."""
    rows = flt.chrono_split(flt.study_window(features, *study), splits)
    return written(rows.select("split", "dep_date", "month", *STUDY_COLUMNS), "study")


def train_ridge(spark: SparkSession, features_root: str, out_dir: str, study=STUDY, splits=SPLITS,
                n_lambdas: int = 100) -> DataFrame:
    """90-day averages and the ridge path on validation and test. Writes
    ``split_counts``, ``metrics_baseline_v2``, ``predictions`` (by split) and
    ``ridge_model``; returns the metrics."""
    configure(spark)
    features = flt.tolerant_select(spark.read.parquet(features_root), [*STUDY_COLUMNS, "year", "month"])
    sp = _study_rows(features, study, splits)
    sinks.write_small_csv(flt.split_counts(sp), f"{out_dir}/split_counts")
    cut = {name: lo for name, lo, _ in splits}
    train, valid, test = (sp.where(F.col("split") == s) for s in ("train", "validation", "test"))
    rolled = bl.rolling_avg_90d(train, valid, cut["validation"]).unionByName(
        bl.rolling_avg_90d(train.unionByName(valid), test, cut["test"]))
    rolled = written(rolled, "rolling")
    rows = train.withColumn("pred_rolling_avg", F.lit(None).cast("double")).unionByName(rolled)
    res = mdl.ridge_path(rows, keep=mdl.PREDICTION_KEYS, n_lambdas=n_lambdas)
    metrics = ev.error_metrics(rolled.withColumn("model", F.lit(mdl.MODEL_ROLLING_90D)), mdl.TARGET, "pred_rolling_avg")
    metrics = written(metrics.unionByName(res.metrics), "metrics")
    sinks.write_small_csv(metrics, f"{out_dir}/{BASELINE_METRICS}")
    sinks.write_predictions(mdl.stored_predictions(res), f"{out_dir}/predictions")
    sinks.save_metadata(spark, f"{out_dir}/ridge_model", {**res.model, "lambdas": res.lambdas, "valid_mae": res.valid_mae})
    return metrics


def train_trees(spark: SparkSession, features_root: str, out_dir: str, study=STUDY, splits=SPLITS,
                max_rounds: int = 1000, baseline_metrics: str | None = None, save_predictions: bool = True) -> DataFrame:
    """Boosted trees on validation and test. Writes ``metrics_trees``,
    ``metrics_with_baselines`` (stored baseline metrics, where they exist, with these
    appended), ``tree_model`` with its metadata and ``tree_predictions``; returns the
    comparison."""
    configure(spark)
    # a run that was stopped goes on after its last finished block of rounds
    features = flt.require_columns(spark.read.parquet(features_root), STUDY_COLUMNS)
    res = mdl.gbt_run(_study_rows(features, study, splits), max_rounds=max_rounds, folder=f"{out_dir}/tree_progress")
    metrics = written(res.metrics, "metrics")
    sinks.write_small_csv(metrics, f"{out_dir}/metrics_trees")
    both = sinks.append_metrics(spark, metrics, baseline_metrics or f"{out_dir}/{BASELINE_METRICS}")
    sinks.write_small_csv(both, f"{out_dir}/metrics_with_baselines")
    sinks.save_model(spark, res.model, f"{out_dir}/tree_model", res.metadata)
    drop_path(spark, f"{out_dir}/tree_progress")
    if save_predictions:
        sinks.write_predictions(mdl.tree_predictions(res), f"{out_dir}/tree_predictions")
    return sinks.read_small_csv(spark, f"{out_dir}/metrics_with_baselines", sinks.METRICS_SCHEMA)
