"""CSV files whose column sets differ from file to file.

One Spark job over the files reads the first line of each (a task per file stops after
that line) into a table (file, header). All files are then scanned together with a schema
by position, so only the fields a query uses are parsed; where headers differ, the
header table is joined to the rows by file and tells which position a name has. A column
that a file lacks reads as NULL. Header lines are skipped by the reader, never matched as
text; a column without a name is dropped together with its values, wherever it stands;
any number of columns is read. The driver sees the distinct headers, no file names.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.sizing import broadcast_if_bounded
from tarmac.session import scratch_path
from tarmac.sources.paths import path_exists

FILE = "_file"
_ONE_FILE = str(1 << 40)


def _escape_glob(path: str) -> str:
    """Spark reads paths as patterns; this one is meant literally."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def _patterns(spark: SparkSession, paths: Sequence[str], literal: bool) -> list[str]:
    """Given paths as patterns: a path that is there is itself, whatever characters it has."""
    return [_escape_glob(p) if literal or path_exists(spark, p) else p for p in paths]


def file_path() -> Column:
    """A row's file, as the file system names it (the metadata path is URL-encoded; a plus
    sign is not a space there)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def column_names(line: str) -> list[str | None]:
    """Names by position; None for a blank one. A repeated name gets a number."""
    seen: dict[str, int] = {}
    out: list[str | None] = []
    for h in next(csv.reader([line.lstrip("﻿")])):
        h = h.strip()
        seen[h.lower()] = seen.get(h.lower(), 0) + 1
        out.append((h if seen[h.lower()] == 1 else f"{h}_{seen[h.lower()]}") if h else None)
    return out


def _first_row(batches):
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([b.column(0).slice(0, 1), b.column(1).slice(0, 1)], ["file", "header"])
            return


def headers(spark: SparkSession, patterns: Sequence[str], keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """(file, header): the first line of every file that has one. ``file`` is the encoded
    metadata path. A session of its own deals one file to a task and one row to a batch."""
    own = spark.newSession()
    for k, v in (("spark.sql.files.maxPartitionBytes", _ONE_FILE), ("spark.sql.files.openCostInBytes", _ONE_FILE),
                 ("spark.sql.execution.arrow.maxRecordsPerBatch", "1")):
        own.conf.set(k, v)
    lines = own.read.option("recursiveFileLookup", True).text(list(patterns))
    if keep is not None:
        lines = lines.where(keep(file_path()))
    first = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header")).mapInArrow(
        _first_row, "file string, header string")
    path = scratch_path(spark, f"headers-{uuid.uuid4().hex[:12]}")
    first.coalesce(64).write.parquet(path)
    return spark.read.schema("file string, header string").parquet(path)


def read_csv_files(spark: SparkSession, paths: str | Sequence[str], keep: Callable[[Column], Column] | None = None,
                   literal: bool = False) -> DataFrame:
    """All rows as text columns under their own names, plus the file's path. ``keep`` takes
    the path and says whether to read the file: others are not opened. ``literal``: the
    paths are file names, not patterns."""
    patterns = _patterns(spark, [paths] if isinstance(paths, str) else list(paths), literal)
    heads = headers(spark, patterns, keep)
    lines = [r.header for r in heads.select("header").distinct().orderBy("header").collect()]  # distinct headers: a few
    groups = [column_names(line) for line in lines]
    if not groups:
        return spark.createDataFrame([], f"{FILE} string")
    width = max(len(g) for g in groups)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    df = (spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", True)
          .option("recursiveFileLookup", True).csv(patterns))
    if keep is not None:
        df = df.where(keep(file_path()))
    places: dict[str, dict[int, int]] = {}  # name -> position by header
    for g, names in enumerate(groups):
        for i, n in enumerate(names):
            if n:
                places.setdefault(n, {})[g] = i
    df = df.select("*", file_path().alias(FILE), F.col("_metadata.file_path").alias("_at"))
    if len(groups) > 1:
        numbers = broadcast_if_bounded(spark.createDataFrame(list(enumerate(lines)), "_group int, header string"))
        of = heads.join(numbers, "header").select(F.col("file").alias("_at"), "_group")
        df = df.join(broadcast_if_bounded(of), "_at")

    def column(name: str) -> Column:
        at = places[name]
        if len(set(at.values())) == 1 and len(at) == len(groups):
            return F.col(f"_c{next(iter(at.values()))}")
        out = None
        for place in sorted(set(at.values())):
            mine = F.col("_group").isin([g for g, i in at.items() if i == place])
            out = F.when(mine, F.col(f"_c{place}")) if out is None else out.when(mine, F.col(f"_c{place}"))
        return out

    return df.select(FILE, *[column(n).alias(n) for n in places])


def field(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """A named column, trimmed, blank as NULL, cast so that bad text is NULL; a
    column that no file has is NULL."""
    if name.lower() not in {c.lower() for c in df.columns}:
        return F.lit(None).cast(dtype)
    v = F.trim(F.col(f"`{name}`"))
    v = F.when(v != F.lit(""), v)
    return v if dtype == "string" else v.try_cast(dtype)
