"""Round trips through the sources and sinks: data Spark derives from the test
tables is written in the landed formats under the shared scratch folder and
read back with the library's readers (one fresh folder per call)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans import queries_features  # noqa: F401  (registers the SQL steps used here)
from tarmac.plans.core import Ctx, query
from tarmac.operators import filters as flt
from tarmac.plans.oracle import compose
from tarmac.plans.queries_baselines import _split
from tarmac.session import scratch_path, written
from tarmac.sources import flights as fs
from tarmac.sources import sinks


def _folder(c: Ctx, what: str) -> str:
    return scratch_path(c.spark, f"roundtrip/{what}-{uuid.uuid4().hex}")


@query("flights_csv_roundtrip", compose("""
select flight_id, flight_date, trim(crs_dep_time) as crs_dep_time, carrier, origin, dest,
  dep_delay, cancelled, cast(year(flight_date) as integer) as year,
  cast(month(flight_date) as integer) as month
from fx_flights""", "fx_flights"))
def _flights_csv(c: Ctx) -> DataFrame:
    """Departures as monthly CSV files with the on-time column names (header
    in every file), read back with the header-mapped reader. A large month is split
    into files of about the advisory size, so no task writes a whole month."""
    src = {v[0]: k for k, v in fs.ONTIME_COLUMNS.items()}
    f = c.flights.withColumn("year", F.year("flight_date")).withColumn(
        "month", F.month("flight_date")).withColumn("day", F.dayofmonth("flight_date"))
    out = f.select(*[(F.col("flight_id").cast("string") if name == "flight_number" else F.col(name))
                     .alias(col) for col, name in src.items()])
    path = _folder(c, "on time csv")
    out.hint("rebalance", "Year", "Month").write.option("header", True).csv(path)
    back = fs.read_flights_csv(c.spark, path, all_columns=False)
    return back.select(F.col("flight_number").cast("bigint").alias("flight_id"), "flight_date",
                       "crs_dep_time", "carrier", "origin", "dest", "dep_delay", "cancelled",
                       "year", "month")


@query("features_parquet_roundtrip", compose("""
select * exclude (flight_id, station_id, wx_ts) from features_left_ids""", "features_left_ids"))
def _features_parquet(c: Ctx) -> DataFrame:
    """Features written month-partitioned (dynamic overwrite) and read back."""
    path = _folder(c, "features")
    sinks.write_features(c.features("left", keep_month=True), path)
    return c.spark.read.parquet(path)


@query("features_by_flight_month", compose("""
select flight_id, year, month, sched_dep_tstz from features_left_ids""", "features_left_ids"))
def _features_by_month(c: Ctx) -> DataFrame:
    """Features written one flight month after the other and read back: no month's
    run takes rows from another, though schedules cross months in UTC."""
    path = _folder(c, "features-by-month")
    rows = written(c.features("left", keep_ids=True, keep_month=True), "features")
    for r in rows.select("year", "month").distinct().orderBy("year", "month").collect():  # a few months
        sinks.write_features(rows.where((F.col("year") == r.year) & (F.col("month") == r.month)), path)
    return c.spark.read.parquet(path).select("flight_id", "year", "month", "sched_dep_tstz")


@query("weather_months", compose("""
select station_id, time, cast(year(time) as integer) as year, cast(month(time) as integer) as month, temp, coco
from fx_weather""", "fx_weather"))
def _weather_months(c: Ctx) -> DataFrame:
    """Observations landed by month of observation and read back."""
    from tarmac.functions.timeparts import to_ntz
    from tarmac.sources import weather as ws
    path = _folder(c, "weather-months")
    ws.write_weather(c.weather, path)
    back = c.spark.read.parquet(path)
    return back.select("station_id", to_ntz(F.col("time")).alias("time"), "year", "month", "temp", "coco")


@query("split_counts_csv_roundtrip", compose("select split, count(*) as n from sp group by 1", "sp"))
def _split_counts_csv(c: Ctx) -> DataFrame:
    """Split counts through the small CSV sink."""
    path = _folder(c, "split-counts")
    sinks.write_small_csv(flt.split_counts(_split(c)), path)
    return sinks.read_small_csv(c.spark, path, "split string, n long")


@query("weather_csv_roundtrip", compose("""
select station_id, time, cast(null as double) as dwpt, rhum, prcp, cast(null as double) as snow,
  wdir, wspd, cast(null as double) as wpgt, pres, cast(null as double) as tsun, temp, coco
from fx_weather""", "fx_weather"))
def _weather_csv(c: Ctx) -> DataFrame:
    """Hourly weather as gzip CSV files per station (year, month, day, hour and
    the measures present - dwpt, snow, wpgt, tsun absent), read back in one
    scan: absent measures NULL, time built in UTC."""
    from tarmac.functions.timeparts import to_ntz
    from tarmac.operators.features import MEASURES
    from tarmac.sources import weather as ws
    w = c.weather
    t = F.col("time").cast("timestamp")
    out = w.select("station_id", F.year(t).alias("year"), F.month(t).alias("month"),
                   F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"),
                   *[m for m in MEASURES if m in w.columns], "coco")
    path = _folder(c, "weather-csv")
    (out.repartition("station_id").write.partitionBy("station_id").option("header", True)
     .option("compression", "gzip").csv(path))
    back = ws.read_weather(c.spark, path)
    return back.select("station_id", to_ntz(F.col("time")).alias("time"), *MEASURES, "coco")
