"""Month ledger: which months of a root are complete.

A run that writes months under a root leaves two kinds of records under ``_months``: one
when it begins, one when its data is written. A month is complete when the run that began
it last has also ended, and its folder is there. So a run that failed half-way, or that is
still replacing a month, leaves the month pending, whatever files lie in its folder. A
record may name the ``source`` run a month was derived from, so that what depends on
a month is renewed when the month was written anew."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.paths import path_exists

_SCHEMA = "at long, event string, run string, year int, month int, source string"


def _path(root: str) -> str:
    return f"{root.rstrip('/')}/_months"


def _record(spark: SparkSession, root: str, event: str, run: str, months: Sequence[tuple[int, int]], sources: dict) -> None:
    rows = [(time.time_ns(), event, run, y, m, sources.get((y, m))) for y, m in months]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").json(_path(root))


@contextmanager
def recorded(spark: SparkSession, root: str, months: Sequence[tuple[int, int]],
             sources: dict[tuple[int, int], str] | None = None) -> Iterator[str]:
    """Writes the months inside the block; they count as complete once it ends well."""
    run = uuid.uuid4().hex
    if months:
        _record(spark, root, "begin", run, months, sources or {})
    yield run
    if months:
        _record(spark, root, "end", run, months, sources or {})


def complete_months(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, run, source) of the complete months by the records alone."""
    if not path_exists(spark, _path(root)):
        return spark.createDataFrame([], "year int, month int, run string, source string")
    events = spark.read.schema(_SCHEMA).json(_path(root))
    last = (events.where("event = 'begin'").groupBy("year", "month").agg(F.max_by("run", "at").alias("run")))
    ends = events.where("event = 'end'").select("year", "month", "run", "source")
    return last.join(ends, ["year", "month", "run"]).select("year", "month", "run", "source")
