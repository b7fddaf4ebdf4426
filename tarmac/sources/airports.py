"""Headerless airport file (IATA at column 5, ICAO at 6, zone at 12)
and the station dictionary (nested JSON with a Parquet read-through cache) (S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.paths import path_exists


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """(iata, icao, tz) as text; the ``\\N`` sentinel is kept as text."""
    df = (spark.read.option("header", False).option("escape", '"')
          .option("nullValue", None).csv(path))
    return df.select(F.col("_c4").alias("iata"), F.col("_c5").alias("icao"),
                     F.col("_c11").alias("tz"))


def read_stations(spark: SparkSession, json_path: str, cache_path: str | None = None) -> DataFrame:
    """(id, icao) from the nested station dictionary (``identifiers.icao``).
    With ``cache_path`` the whole dictionary is written once and read back after."""
    if cache_path and path_exists(spark, cache_path):
        raw = spark.read.parquet(cache_path)
    else:
        raw = spark.read.option("multiLine", True).json(json_path)
        if cache_path:
            raw.write.mode("overwrite").parquet(cache_path)
            raw = spark.read.parquet(cache_path)
    return raw.select(F.col("id").cast("string").alias("id"),
                      F.col("identifiers.icao").cast("string").alias("icao"))
