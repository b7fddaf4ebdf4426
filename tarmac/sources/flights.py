"""Monthly on-time performance CSV -> month-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import drop_path
from tarmac.sources.csvmap import FILE, field, read_csv_files
from tarmac.sources.paths import month_path

# Source column names of the monthly on-time performance files.
ONTIME_COLUMNS = {
    "year": ("Year", "int"), "month": ("Month", "int"), "day": ("DayofMonth", "int"),
    "flight_date": ("FlightDate", "date"), "crs_dep_time": ("CRSDepTime", "string"),
    "carrier": ("IATA_CODE_Reporting_Airline", "string"), "flight_number":
        ("Flight_Number_Reporting_Airline", "string"),
    "origin": ("Origin", "string"), "dest": ("Dest", "string"),
    "dep_delay": ("DepDelay", "double"), "cancelled": ("Cancelled", "double"),
}


def _typed(raw: DataFrame, all_columns: bool) -> DataFrame:
    cols = [field(raw, src, dtype).alias(name) for name, (src, dtype) in ONTIME_COLUMNS.items()]
    if all_columns:  # the file's other columns as they are, unless the name is taken
        taken = {n.lower() for n in (*ONTIME_COLUMNS, "flight_id", "source_file", *(c for c, _ in ONTIME_COLUMNS.values()))}
        cols += [F.col(f"`{c}`") for c in raw.columns if c != FILE and c.lower() not in taken]
    df = raw.select(*cols, F.regexp_extract(FILE, "([^/]+)$", 1).alias("source_file"))
    # a stable id for tie-breaking: the flight's identifying fields
    return df.withColumn("flight_id", F.xxhash64("flight_date", "carrier", "flight_number",
                                                 "origin", "dest", "crs_dep_time"))


def read_flights_csv(spark: SparkSession, paths: str | Sequence[str], all_columns: bool = True, literal: bool = False) -> DataFrame:
    """All monthly files in one scan, with each row's ``source_file`` name; HHMM stays text.
    With ``all_columns`` the source's other columns follow as text."""
    return _typed(read_csv_files(spark, paths, literal=literal), all_columns)


def write_flights(df: DataFrame, out_root: str) -> None:
    """``year=YYYY/month=M/source_file=F`` partitions from each row's own values, for batch
    and stream alike: writing a file's rows again replaces that file's rows of the month
    and no other's, so files of a month may come in any order. The ``rebalance`` hint
    clusters rows by partition but lets AQE split a large one into advisory-size tasks."""
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.lit("rows"))
    (df.hint("rebalance", "year", "month", "source_file").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "source_file").parquet(out_root))


def clear_months(spark: SparkSession, root: str, months: Sequence[tuple[int, int]]) -> None:
    """Remove what lies under the months, of whatever files: a batch run replaces them as a
    whole. The ledger holds them pending meanwhile."""
    for y, m in months:
        drop_path(spark, month_path(root, y, m))


def read_flights(spark: SparkSession, root: str, months: Sequence[tuple[int, int]] | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Partitioned flights; a month list becomes a partition filter."""
    df = spark.read.parquet(root)
    if months:
        cond = None
        for y, m in months:
            c = (F.col("year") == y) & (F.col("month") == m)
            cond = c if cond is None else cond | c
        df = df.where(cond)
    return df.select(*columns) if columns else df
