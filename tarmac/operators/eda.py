"""Exploratory aggregates over a feature table.

Each function is one aggregation (map-side partial aggregation, one shuffle on
the group keys); nothing is collected. Means of the positive-part delay skip
NULL delays; ``n`` counts all rows of the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.bins import cut_label, hist_center
from tarmac.functions.flags import positive_part, rain_label
from tarmac.operators.sizing import broadcast_if_bounded

# The columns profiled for missing data, with their output names.
MISSING_PROFILE = [
    ("carrier", "carrier_na_pc"), ("origin", "origin_na_pc"), ("dest", "dest_na_pct"),
    ("sched_dep_tstz", "sched_dep_tstz_na_pct"), ("dep_hour_local", "dep_hour_local_na_pct"),
    ("dow", "dow_na_pct"), ("dwpt", "dwpt_na_pct"), ("rhum", "rhum_na_pct"),
    ("prcp", "prcp_na_pct"), ("snow", "snow_na_pct"), ("wdir", "wdir_na_pct"),
    ("wspd", "wspd_na_pct"), ("wpgt", "wpgt_na_pct"), ("pres", "pres_na_pct"),
    ("tsun", "tsun_na_pct"), ("temp", "temp_na_pct"), ("coco", "coco_na_pct"),
    ("dep_delay_min", "dep_delay_min_na_pct"), ("late_15", "late_15_na_pct"),
]
# Weather columns found empty over the whole window.
UNUSED_WEATHER = ["dwpt", "snow", "wpgt", "tsun"]


def _r(c):
    return F.round(c, 6)


def _na_pct(c: str):
    return F.avg(F.col(c).isNull().cast("double")) * 100


def _mean_pos():
    return F.avg(positive_part(F.col("dep_delay_min")))


def eda_window(features: DataFrame, start: str, end: str) -> DataFrame:
    """Half-open window on the schedule instant (drops zone spill-over months)."""
    from tarmac.operators.filters import partition_window
    features = partition_window(features, start, end)
    ts = F.col("sched_dep_tstz")
    return features.where((ts >= F.lit(start).cast("timestamp_ntz"))
                          & (ts < F.lit(end).cast("timestamp_ntz")))


def monthly_counts(features: DataFrame) -> DataFrame:
    ts = F.col("sched_dep_tstz")
    return (features.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("year", "month"))


def missing_by_month(features: DataFrame) -> DataFrame:
    ts = F.col("sched_dep_tstz")
    return (features.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
            .agg(*[_r(_na_pct(c)).alias(name) for c, name in MISSING_PROFILE])
            .orderBy("year", "month"))


def missing_overall(features: DataFrame, cols=tuple(UNUSED_WEATHER)) -> DataFrame:
    return features.agg(*[_r(_na_pct(c)).alias(c) for c in cols])


def tail_stats(features: DataFrame, thresholds=(60, 120, 240)) -> DataFrame:
    d = F.col("dep_delay_min")
    return features.agg(F.count(F.lit(1)).alias("n"),
                        *[_r(F.avg((d > t).cast("double")) * 100).alias(f"pct_gt_{t}")
                          for t in thresholds])


def seasonality(features: DataFrame) -> DataFrame:
    return (features.groupBy("dep_hour_local", "dow")
            .agg(_r(_mean_pos()).alias("mean_pos_delay"), F.count(F.lit(1)).alias("n")))


def _airport_means(features: DataFrame, min_flights: int) -> DataFrame:
    return (features.groupBy("origin")
            .agg(F.count(F.lit(1)).alias("n"), _mean_pos().alias("mean_pos_delay"),
                 (F.avg(F.col("late_15").cast("double")) * 100).alias("late_15_pct"))
            .where(F.col("n") >= min_flights))


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumns({c: _r(F.col(c)) for c in ("mean_pos_delay", "late_15_pct")})


def airport_summary(features: DataFrame, min_flights: int = 5000) -> DataFrame:
    """Per origin: n, mean positive delay, % late (>= 15 min); origins with
    at least ``min_flights`` rows."""
    return _rounded(_airport_means(features, min_flights))


def top_origins(features: DataFrame, min_flights: int = 5000, k: int = 20) -> DataFrame:
    """The ``k`` origins with the highest mean positive delay (origin breaks ties);
    ranked by the exact mean, rounded afterwards."""
    top = _airport_means(features, min_flights).orderBy(F.col("mean_pos_delay").desc_nulls_last(), F.col("origin"))
    return _rounded(top.limit(k))


def airport_summary_labeled(features: DataFrame, min_flights: int = 5000,
                            k: int = 15) -> DataFrame:
    """Whole summary plus ``top_label``: whether the origin is among the ``k``
    highest mean positive delays (the labelled points of the scatter)."""
    # one row per origin, used twice: computed once into the scratch folder
    from tarmac.session import written
    summary = written(_airport_means(features, min_flights), "airports")
    top = (summary.orderBy(F.col("mean_pos_delay").desc_nulls_last(), F.col("origin")).limit(k)
           .select("origin", F.lit(True).alias("top_label")))
    return _rounded(summary.join(broadcast_if_bounded(top, k), "origin", "left")
                    .withColumn("top_label", F.coalesce("top_label", F.lit(False))))


def _binned(features: DataFrame, col: str, lo: float, hi: float, width: float,
            include_lowest: bool, with_mean: bool) -> DataFrame:
    label = cut_label(F.col(col), lo, hi, width, include_lowest).alias(f"{col}_bin")
    aggs = ([_r(_mean_pos()).alias("mean_pos_delay")] if with_mean else []) + [
        F.count(F.lit(1)).alias("n")]
    return features.groupBy(label).agg(*aggs)


def delay_by_temp(features: DataFrame) -> DataFrame:
    """Temperature bins (-50, 50] by 5, right-closed; -50 itself falls outside."""
    return _binned(features, "temp", -50, 50, 5, False, True)


def delay_by_wind(features: DataFrame) -> DataFrame:
    return _binned(features, "wspd", 0, 240, 10, True, True)


def wind_bin_counts(features: DataFrame) -> DataFrame:
    return _binned(features, "wspd", 0, 240, 10, True, False)


def delay_by_precip(features: DataFrame) -> DataFrame:
    return _binned(features, "prcp", 0, 105, 5, True, True)


def precip_bin_counts(features: DataFrame) -> DataFrame:
    return _binned(features, "prcp", 0, 105, 5, True, False)


def delay_by_rain(features: DataFrame) -> DataFrame:
    return (features.groupBy(rain_label(F.col("prcp")).alias("rain"))
            .agg(_r(_mean_pos()).alias("mean_pos_delay"), F.count(F.lit(1)).alias("n")))


def delay_histogram(features: DataFrame, lo: float = -60, hi: float = 360,
                    width: float = 5) -> DataFrame:
    """Counts per 5-minute bin (centred on multiples of 5) over [lo, hi],
    every bin from the first to the last occupied one (empty bins n = 0),
    with ``log10_n`` for the log-scaled view (NULL for empty bins)."""
    d = F.col("dep_delay_min")
    counts = (features.where((d >= lo) & (d <= hi))
              .groupBy(hist_center(d, width).alias("bin_center"))
              .agg(F.count(F.lit(1)).alias("n")))
    # one row with all bins (at most (hi - lo) / width + 1 of them), spread over the occupied range
    bins = counts.agg(F.map_from_entries(F.collect_list(F.struct(F.col("bin_center").cast("bigint"), "n"))).alias("m"))
    keys = F.map_keys("m")
    grid = F.when(F.size(keys) > 0, F.sequence(F.array_min(keys), F.array_max(keys), F.lit(int(width)).cast("bigint")))
    out = bins.select("m", F.explode(grid).alias("c")).select(
        F.col("c").cast("double").alias("bin_center"), F.coalesce(F.col("m")[F.col("c")], F.lit(0)).cast("bigint").alias("n"))
    return out.withColumn("log10_n", _r(F.when(F.col("n") > 0, F.log10(F.col("n").cast("double")))))


def origin_sanity(features: DataFrame, k: int = 10) -> DataFrame:
    """Busiest origins: rows, mean delay, temperature and precipitation."""
    return (features.groupBy("origin")
            .agg(F.count(F.lit(1)).alias("n_rows"), _r(F.avg("dep_delay_min")).alias("avg_delay"),
                 _r(F.avg("temp")).alias("avg_temp"), _r(F.avg("prcp")).alias("avg_prcp"))
            .orderBy(F.col("n_rows").desc(), F.col("origin")).limit(k))


def earliest_rows(features: DataFrame, k: int = 5) -> DataFrame:
    """First ``k`` departures by schedule (carrier, origin, dest break ties)."""
    return (features.orderBy("sched_dep_tstz", "carrier", "origin", "dest").limit(k)
            .select("sched_dep_tstz", "origin", "carrier", "dep_delay_min", "temp", "prcp", "wspd"))
