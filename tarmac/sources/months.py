"""Month ranges and incremental processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.ledger import complete_months


def month_range_between(start: Column, end: Column) -> Column:
    """Array of first-of-month dates from ``start``'s month to ``end``'s, inclusive."""
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"),
                      F.expr("interval 1 month"))


def months_frame(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """(year, month) rows for every month between two columns of a one-row frame."""
    return (df.select(F.explode(month_range_between(start, end)).alias("m"))
            .select(F.year("m").alias("year"), F.month("m").alias("month")))


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``"YYYY-MM"`` bounds, inclusive."""
    one = spark.range(1).select(F.to_date(F.lit(start + "-01")).alias("a"),
                                F.to_date(F.lit(end + "-01")).alias("b"))
    return months_frame(one, F.col("a"), F.col("b"))


def pending_months(requested: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """Requested (year, month) rows with no existing partition (all of them
    when ``overwrite``)."""
    if overwrite:
        return requested
    return requested.join(existing.select("year", "month").distinct(), ["year", "month"],
                          "left_anti")


def existing_months(spark: SparkSession, root: str) -> DataFrame:
    """(year, month) that are complete under a partitioned root: its ledger says that the
    run which wrote them has ended, and their folders are there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(conf)
    found = []
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(top, "year=*/month=*")) or []:
        month, year = status.getPath().getName(), status.getPath().getParent().getName()
        found.append((int(year.partition("=")[2]), int(month.partition("=")[2])))
    return spark.createDataFrame(found, "year int, month int").join(complete_months(spark, root), ["year", "month"], "left_semi")
