"""Path layout of the landed and derived data (S12) and existence checks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def month_path(root: str, year: int, month: int) -> str:
    """Folder of one month under a root partitioned by year and month."""
    return f"{root.rstrip('/')}/year={int(year)}/month={int(month)}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system of the path (works for shared stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def require_paths(spark: SparkSession, paths, what: str = "input") -> None:
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise ValueError(f"no {what} at: " + ", ".join(missing))
