"""Every exploratory table from one read of the features, by mergeable month states.

``month_states`` reads the rows once. Each row stands for its key in eight profiles (its
month, hour and weekday, origin, temperature, wind and rain bin, rain flag, delay bin),
and one aggregation adds up counts and sums per (month of the schedule, profile, key);
partial sums in the scan's tasks keep a busy origin or bin a few rows. The states of
different rows add up by ``merged``: a new month's states join the stored ones and no
earlier month is read again.

``reports`` derives the tables of ``operators.eda`` from states: means are quotients of
sums, shares quotients of counts, and a window of whole months selects states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.bins import cut_label, hist_center
from tarmac.functions.flags import positive_part, rain_label
from tarmac.operators.eda import MISSING_PROFILE, UNUSED_WEATHER
from tarmac.operators.sizing import broadcast_if_bounded

KEYS = ["year", "month", "profile", "text", "a", "b"]
TAILS = (60, 120, 240)


def _measures() -> dict[str, Column]:
    """Name -> what a row adds to the sum of its key; a NULL adds nothing."""
    d = F.col("dep_delay_min")
    return {"pos_sum": positive_part(d), "pos_n": positive_part(d).isNotNull().cast("long"),
            "late": F.col("late_15").cast("long"), "late_n": F.col("late_15").isNotNull().cast("long"),
            "delay": d, "delay_n": d.isNotNull().cast("long"),
            "temp": F.col("temp"), "temp_n": F.col("temp").isNotNull().cast("long"),
            "prcp": F.col("prcp"), "prcp_n": F.col("prcp").isNotNull().cast("long"),
            **{f"over_{t}": (d > t).cast("long") for t in TAILS}}


def month_states(features: DataFrame, hist: tuple[float, float, float] = (-60, 360, 5), by: tuple[str, ...] = ()) -> DataFrame:
    """(by, year, month, profile, text, a, b, n, sums, nulls per column). ``by``: further
    columns to keep apart, such as the month of the flights a run has read."""
    d, ts = F.col("dep_delay_min"), F.col("sched_dep_tstz")
    lo, hi, width = hist

    def key(profile: str, text=None, a=None, b=None) -> Column:
        return F.struct(F.lit(profile).alias("profile"), (F.lit(None) if text is None else text).cast("string").alias("text"),
                        (F.lit(None) if a is None else a).cast("long").alias("a"), (F.lit(None) if b is None else b).cast("long").alias("b"))

    keys = [key("month"), key("hour", a=F.col("dep_hour_local"), b=F.col("dow")), key("origin", F.col("origin")),
            key("temp", cut_label(F.col("temp"), -50, 50, 5, False)), key("wspd", cut_label(F.col("wspd"), 0, 240, 10, True)),
            key("prcp", cut_label(F.col("prcp"), 0, 105, 5, True)), key("rain", rain_label(F.col("prcp"))),
            F.when((d >= lo) & (d <= hi), key("delay", a=hist_center(d, width)))]
    measures = _measures()
    # NULLs per column as one bit mask, counted for the month's key only
    mask = sum((F.shiftleft(F.col(c).isNull().cast("long"), k) for k, (c, _) in enumerate(MISSING_PROFILE)), F.lit(0).cast("long"))
    rows = features.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.year(ts).alias("_year"), F.month(ts).alias("_month"),
                           *[v.alias(f"_{n}") for n, v in measures.items()], mask.alias("_mask"),
                           F.explode(F.filter(F.array(*keys), lambda k: k.isNotNull())).alias("_key"))
    lost = F.when(F.col("profile") == "month", F.col("_mask")).otherwise(0)
    flat = rows.select(*[F.col(f"_by_{c}").alias(c if c not in KEYS else f"{c}_read") for c in by], F.col("_year").alias("year"),
                       F.col("_month").alias("month"), "_key.*", *[f"_{n}" for n in measures], "_mask")
    groups = [c for c in flat.columns if not c.startswith("_")]
    return flat.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(n) for n in measures],
        *[F.sum(F.shiftright(lost, k).bitwiseAND(1)).alias(f"null_{c}") for k, (c, _) in enumerate(MISSING_PROFILE)])


def merged(states: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """States added up by their keys; the sums of any parts equal those of the whole."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in states.columns if c not in KEYS and not c.endswith("_read")])


def _r(c: Column) -> Column:
    return F.round(c, 6)


def _mean(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(total) / F.col(n))


def in_window(states: DataFrame, start: str, end: str) -> DataFrame:
    """States of the whole months of ``[start, end)``; other bounds are an error."""
    if not (start.endswith("-01") and end.endswith("-01")):
        raise ValueError(f"month states hold whole months: {start} .. {end}")
    ym = F.col("year") * 100 + F.col("month")
    return states.where((ym >= int(start[:4]) * 100 + int(start[5:7])) & (ym < int(end[:4]) * 100 + int(end[5:7])))


def reports(states: DataFrame, start: str, end: str, min_flights: int = 5000, top: int = 20, labelled: int = 15,
            busiest: int = 10) -> dict[str, DataFrame]:
    """The exploratory tables by name, from states (of all months; the window is applied here)."""
    everything = states
    states = in_window(states, start, end)

    def of(profile: str, *keys: str) -> DataFrame:
        part = states.where(F.col("profile") == profile)
        return part.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in part.columns if c not in KEYS and not c.endswith("_read")])

    mean = _r(_mean("pos_sum", "pos_n")).alias("mean_pos_delay")
    months = of("month", "year", "month")
    whole = of("month")

    def missing(c: str) -> Column:
        return _r(F.col(f"null_{c}") / F.col("n") * 100)

    def binned(col: str, with_mean: bool) -> DataFrame:
        return of(col, "text").select(F.col("text").alias(f"{col}_bin"), *([mean] if with_mean else []), "n")

    origins = of("origin", "text").withColumnRenamed("text", "origin")
    summary = (origins.where(F.col("n") >= min_flights)
               .select("origin", "n", _mean("pos_sum", "pos_n").alias("mean_pos_delay"), (_mean("late", "late_n") * 100).alias("late_15_pct")))
    best = [F.col("mean_pos_delay").desc_nulls_last(), F.col("origin")]
    rounded = {c: _r(F.col(c)) for c in ("mean_pos_delay", "late_15_pct")}
    first = summary.orderBy(*best).limit(labelled).select("origin", F.lit(True).alias("top_label"))
    delays = of("delay", "a").select(F.col("a").alias("c"), "n")
    grid = delays.agg(F.min("c").alias("lo"), F.max("c").alias("hi")).select(
        F.explode(F.when(F.col("lo").isNotNull(), F.sequence("lo", "hi", F.lit(5).cast("long")))).alias("c"))
    every = everything.where(F.col("profile") == "origin").groupBy("text").agg(
        *[F.sum(c).alias(c) for c in ("n", "delay", "delay_n", "temp", "temp_n", "prcp", "prcp_n")])
    return {
        "monthly_counts": everything.where(F.col("profile") == "month").groupBy("year", "month").agg(F.sum("n").alias("n")).orderBy("year", "month"),
        "missing_by_month": months.select("year", "month", *[missing(c).alias(name) for c, name in MISSING_PROFILE]).orderBy("year", "month"),
        "missing_overall": whole.select(*[missing(c).alias(c) for c in UNUSED_WEATHER]),
        "tail_stats": whole.select("n", *[_r(_mean(f"over_{t}", "delay_n") * 100).alias(f"pct_gt_{t}") for t in TAILS]),
        "seasonality": of("hour", "a", "b").select(F.col("a").alias("dep_hour_local"), F.col("b").alias("dow"), mean, "n"),
        "top_origins": summary.orderBy(*best).limit(top).withColumns(rounded),
        "airport_summary": (summary.join(broadcast_if_bounded(first, labelled), "origin", "left")
                            .withColumns({**rounded, "top_label": F.coalesce("top_label", F.lit(False))})),
        "delay_by_temp": binned("temp", True), "delay_by_wind": binned("wspd", True), "wind_bin_counts": binned("wspd", False),
        "delay_by_precip": binned("prcp", True), "precip_bin_counts": binned("prcp", False),
        "delay_by_rain": of("rain", "text").select(F.col("text").alias("rain"), mean, "n"),
        "delay_histogram": (grid.join(delays, "c", "left").select(F.col("c").cast("double").alias("bin_center"), F.coalesce("n", F.lit(0)).alias("n"))
                            .withColumn("log10_n", _r(F.when(F.col("n") > 0, F.log10(F.col("n").cast("double")))))),
        "origin_sanity": (every.select(F.col("text").alias("origin"), F.col("n").alias("n_rows"), _r(_mean("delay", "delay_n")).alias("avg_delay"),
                                       _r(_mean("temp", "temp_n")).alias("avg_temp"), _r(_mean("prcp", "prcp_n")).alias("avg_prcp"))
                          .orderBy(F.col("n_rows").desc(), F.col("origin")).limit(busiest)),
    }
