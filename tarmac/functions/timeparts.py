"""Time parsing and calendar parts.

Schedules arrive as a local date plus an ``HHMM`` text (possibly blank padded,
``2400`` meaning midnight at the end of the day). The UTC instant is built as
``date + minutes`` read in the airport zone, which carries ``2400`` into the
next day instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_minutes(hhmm: Column) -> Column:
    """Minutes after local midnight of an ``HHMM`` text; NULL stays NULL."""
    v = F.trim(hhmm).cast("bigint")
    return F.floor(v / 100) * 60 + v % 100


def local_schedule(flight_date: Column, hhmm: Column) -> Column:
    """Local wall-clock schedule as TIMESTAMP_NTZ (``2400`` -> next day 00:00)."""
    return F.timestamp_add("MINUTE", hhmm_minutes(hhmm),
                          flight_date.cast("date").cast("timestamp_ntz"))


def sched_dep_utc(flight_date: Column, hhmm: Column, tz: Column,
                  dst_overlap: str = "later") -> Column:
    """Scheduled departure as a UTC instant (TIMESTAMP).

    A wall-clock time that occurs twice (DST fall-back hour) resolves to the
    later instant by default, as the published pipeline's engine does;
    ``dst_overlap="earlier"`` keeps Spark's own choice. Non-existent times
    (spring-forward gap) shift forward in both."""
    local = local_schedule(flight_date, hhmm)
    early = F.to_utc_timestamp(local, tz)
    if dst_overlap == "earlier":
        return early
    late = early + F.make_dt_interval(F.lit(0), F.lit(1))
    ambiguous = F.from_utc_timestamp(late, tz) == local.cast("timestamp")
    return F.when(ambiguous, late).otherwise(early)


def crs_dep_hour(flight_date: Column, hhmm: Column) -> Column:
    """Coverage-view hour: ``date || ' ' || lpad(HHMM, 4, '0')`` parsed and
    truncated to the hour; texts that do not parse (``2400``) give NULL."""
    text = F.concat(F.date_format(flight_date, "yyyy-MM-dd"), F.lit(" "),
                    F.lpad(F.trim(hhmm), 4, "0"))
    ts = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HHmm"))
    return to_ntz(F.date_trunc("hour", ts))


def hour_bin(ts: Column) -> Column:
    """Whole-hour bin of an instant in the session zone (UTC)."""
    return F.date_trunc("hour", ts)


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def dow_sunday0(ts: Column) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def to_ntz(ts: Column) -> Column:
    """UTC instant -> TIMESTAMP_NTZ wall clock (session zone is UTC)."""
    return ts.cast("timestamp_ntz")


def gap_seconds(a: Column, b: Column) -> Column:
    """Absolute distance in seconds between two instants."""
    return F.abs(F.unix_seconds(a.cast("timestamp")) - F.unix_seconds(b.cast("timestamp")))
