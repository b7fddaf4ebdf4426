"""Hourly station weather files (one CSV.gz per station and year).

The files of the wanted stations are read in one scan; the station id comes from the file name, the
observation time is built in UTC, measures absent from a file are NULL, and
only the requested month is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.features import MEASURES
from tarmac.sources.csvmap import FILE, field, read_csv_files

#: stations up to which the files to read are picked by name
MAX_PICKED = 200_000


def station_of(path) -> F.Column:
    """Station id of a file: a ``station_id=<id>`` folder when present, else the file name."""
    folder = F.regexp_extract(path, r"station_id=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"([^/]+?)(\.csv)?(\.gz)?$", 1))


def read_weather(spark: SparkSession, paths: str | Sequence[str], year: int | None = None,
                 month: int | None = None, stations: DataFrame | None = None) -> DataFrame:
    """Observations of all files, or of the files of ``stations (station_id)``: the others are
    pruned by their names and not opened (with more than ``MAX_PICKED`` stations, read and
    left out)."""
    keep = None
    if stations is not None:
        few = [r.station_id for r in stations.select("station_id").distinct().limit(MAX_PICKED + 1).collect()]
        if len(few) <= MAX_PICKED:
            keep = lambda path: station_of(path).isin(few)
    raw = read_csv_files(spark, paths, keep)
    station = station_of(F.col(FILE))
    y, m, d, h = (field(raw, c, "int") for c in ("year", "month", "day", "hour"))
    time = F.make_timestamp(y, m, d, h, F.lit(0), F.lit(0), F.lit("UTC"))
    df = raw.select(time.alias("time"), station.alias("station_id"),
                    *[field(raw, c, "double").alias(c) for c in MEASURES],
                    field(raw, "coco", "int").alias("coco"), y.alias("_y"), m.alias("_m"))
    if year is not None:
        df = df.where(F.col("_y") == year)
    if month is not None:
        df = df.where(F.col("_m") == month)
    if stations is not None and keep is None:
        df = df.join(stations.select("station_id").distinct(), "station_id", "left_semi")
    return df.drop("_y", "_m")


def write_weather(df: DataFrame, root: str) -> None:
    """``year/month`` partitions of the observation time (UTC); only the months
    present are replaced."""
    t = F.col("time")
    (df.withColumn("year", F.year(t)).withColumn("month", F.month(t)).hint("rebalance", "year", "month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(root))


def read_weather_months(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("year", "month")


def write_crosswalk(df: DataFrame, path: str) -> None:
    """The crosswalk carries no month: build it over every month, write once."""
    df.write.mode("overwrite").parquet(path)
