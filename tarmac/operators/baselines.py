"""Historical-average delay predictors.

* ``rolling_30d``: per route, mean delay over the 30 days before each
  departure (the departure's own instant excluded), train and test rows both
  feeding the window; NULL delays ignored.
* ``rolling_30d_backfilled``: that mean, else the train route mean, else the
  train carrier mean, else the train global mean; test rows returned.
* ``rolling_avg_90d``: a history window fixed at a cutoff date; mean by
  (carrier, route, hour, weekday), else by (route, hour), else global.
  Lookups match NULL keys to NULL keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.rolling import day_totals, rolling_mean_bucketed, rolling_mean_from_totals
from tarmac.operators.sizing import broadcast_if_bounded

ROUTE = ["carrier", "origin", "dest"]
MICROS_PER_SECOND = 1_000_000
SECONDS_PER_DAY = 86_400


def tagged_union(train: DataFrame, test: DataFrame) -> DataFrame:
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))


def rolling_mean(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str,
                 days: int = 30, gap_seconds: int = 1, out_col: str = "trailing_avg",
                 wanted: Column | None = None) -> DataFrame:
    """Mean of ``value_col`` over rows of the same key with time in
    ``[t - days, t - gap_seconds]`` (both ends inclusive), for the rows where
    ``wanted`` holds (all rows by default; only those are returned). No key is
    sorted as a whole in one task, see ``operators.rolling``."""
    return rolling_mean_bucketed(df, keys, ts_col, value_col, days * SECONDS_PER_DAY * MICROS_PER_SECOND,
                                 gap_seconds * MICROS_PER_SECOND, out_col, wanted=wanted)


def route_mean(train: DataFrame) -> DataFrame:
    return train.groupBy(*ROUTE).agg(F.avg("dep_delay_min").alias("route_avg"))


def carrier_mean(train: DataFrame) -> DataFrame:
    return train.groupBy("carrier").agg(F.avg("dep_delay_min").alias("carrier_avg"))


def global_mean(train: DataFrame) -> DataFrame:
    return train.agg(F.avg("dep_delay_min").alias("overall_avg"))


def global_mean_value(train: DataFrame) -> Column:
    """The global mean as a scalar subquery (evaluated once, no join)."""
    return global_mean(train).scalar()


def backfill_means(train: DataFrame):
    """Route, carrier and global train means from one scan (grouping sets).
    The result (one row per route) is written since three lookups read it.
    Returns (route table, carrier table, global mean as a scalar subquery)."""
    from tarmac.session import written
    g = written(train.groupingSets([ROUTE, ["carrier"], []], *ROUTE)
                .agg(F.avg("dep_delay_min").alias("_m"), F.grouping_id().alias("_gid")), "train-levels")
    # grouping_id bits (carrier, origin, dest): 0 = route, 0b011 = carrier, 0b111 = all
    route = g.where(F.col("_gid") == 0).select(*ROUTE, F.col("_m").alias("route_avg"))
    carr = g.where(F.col("_gid") == 3).select("carrier", F.col("_m").alias("carrier_avg"))
    glob = g.where(F.col("_gid") == 7).select(F.col("_m").alias("overall_avg")).scalar()
    return route, carr, glob


def history_tables(rows: DataFrame, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """What the 30-day predictor needs of past rows, to be kept by month: (totals per route
    and instant, sums per route). Both add up over months. ``by``: further columns to keep
    apart, such as the month that a run has read."""
    d, ts, keys = F.col("dep_delay_min").cast("double"), F.col("sched_dep_tstz"), [*ROUTE, *by]
    sums = (rows.groupBy(*keys, F.year(ts).alias("year"), F.month(ts).alias("month"))
            .agg(F.sum(d).alias("total"), F.count(d).alias("n")))
    return day_totals(rows, keys, "sched_dep_tstz", "dep_delay_min"), sums


def rolling_30d_from_history(totals: DataFrame, sums: DataFrame, test: DataFrame, days: int = 30) -> DataFrame:
    """``rolling_30d_backfilled`` from kept tables of the train rows: reads the totals of the
    30 days before the test rows and one row per route and month, no train row."""
    cols = ROUTE + ["sched_dep_tstz", "dep_delay_min"]
    rolled = rolling_mean_from_totals(totals, test.select(*cols), ROUTE, "sched_dep_tstz", "dep_delay_min",
                                      days * SECONDS_PER_DAY * MICROS_PER_SECOND, MICROS_PER_SECOND, "trailing_avg")
    from tarmac.session import written
    mean = F.when(F.sum("n") > 0, F.sum("total") / F.sum("n"))
    route = written(sums.groupBy(*ROUTE).agg(F.sum("total").alias("total"), F.sum("n").alias("n")), "route-sums")
    return _backfilled(rolled, route.select(*ROUTE, F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("route_avg")),
                       route.groupBy("carrier").agg(mean.alias("carrier_avg")), route.agg(mean.alias("overall_avg")).scalar())


def _backfilled(rolled: DataFrame, route: DataFrame, carr: DataFrame, glob: Column) -> DataFrame:
    # equality joins: a NULL key never finds a backfill row
    out = rolled.join(route, ROUTE, "left").join(broadcast_if_bounded(carr), "carrier", "left")
    return out.select(*ROUTE, "sched_dep_tstz", "dep_delay_min",
                      F.coalesce("trailing_avg", "route_avg", "carrier_avg", glob).alias("yhat_baseline"))


def rolling_30d_backfilled(train: DataFrame, test: DataFrame, days: int = 30) -> DataFrame:
    cols = ROUTE + ["sched_dep_tstz", "dep_delay_min"]
    all_rows = tagged_union(train.select(*cols), test.select(*cols))
    rolled = rolling_mean(all_rows, ROUTE, "sched_dep_tstz", "dep_delay_min", days,
                          wanted=F.col("split") == "test")
    route, carr, glob = backfill_means(train)
    return _backfilled(rolled, route, carr, glob)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def rolling_avg_90d(history: DataFrame, new_data: DataFrame, cutoff: str,
                    window_days: int = 90) -> DataFrame:
    """``new_data`` plus ``pred_rolling_avg`` from history in
    ``[cutoff - window_days, cutoff)`` (on ``dep_date``)."""
    c = F.lit(cutoff).cast("date")
    hist = history.where((F.col("dep_date") >= F.date_sub(c, window_days)) & (F.col("dep_date") < c))
    main_keys = ["carrier", "origin", "dest", "dep_hour_local", "dow"]
    fb_keys = ["origin", "dest", "dep_hour_local"]
    # the three averages from one scan of the history (grouping sets);
    # grouping_id bits follow main_keys: 0 = main, 0b10001 = fallback, 0b11111 = all
    from tarmac.session import written
    g = written(hist.groupingSets([main_keys, fb_keys, []], *main_keys)
                .agg(F.avg("dep_delay_min").alias("_m"), F.grouping_id().alias("_gid")), "averages-90d")
    avg_main = g.where(F.col("_gid") == 0).select(*main_keys, F.col("_m").alias("pred_main"))
    avg_fb = g.where(F.col("_gid") == 17).select(*fb_keys, F.col("_m").alias("pred_fallback"))
    glob = g.where(F.col("_gid") == 31).select("_m").scalar()
    out = _null_safe_join(_null_safe_join(new_data, avg_main, main_keys), avg_fb, fb_keys)
    return (out.withColumn("pred_rolling_avg", F.coalesce("pred_main", "pred_fallback", glob))
            .drop("pred_main", "pred_fallback"))
