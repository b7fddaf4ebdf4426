"""Range-window mean that does not put a whole key into one task.

A ``RANGE`` window partitioned by key sorts every row of a key in one task;
one hot route would make that task hold a third of the data. Here the frame
total is a difference of running totals, ``C(t - gap) - C<(t - span)``, and the
running totals are built from day buckets:

1. rows are aggregated to one record per (key, instant) (map-side partial
   aggregation), written once as pruned Parquet;
2. every record becomes a data point, and a record that has a wanted row also
   its two query points (upper end, inclusive; lower end, exclusive);
3. a window per (key, day) gives running totals inside the day - a partition
   holds at most one day of distinct instants of one key;
4. per-(key, day) totals get a running total over the key's days (a few hundred
   rows per key); it joins in the window's own partitioning;
5. the upper and lower results are paired by one aggregation on (key, instant),
   in whose partitioning the wanted rows join back.

``day_totals`` keeps step 1 as a table by month; ``rolling_mean_from_totals`` starts from it
and reads the span of the frames only.

Totals are kept of finite values, non-NULL values, NaN, +Inf and -Inf apart, so a
special value counts while it is inside a frame and leaves no trace after it.
Keys are one struct, in which a NULL equals a NULL. Results equal ``avg(value)
over (partition by keys order by ts range between span preceding and gap
preceding)``; a NULL time has no frame and gets NULL. Sums are exact for
integer-valued inputs and else differ by rounding only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import written

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND
_INF = float("inf")
_TOTALS = ["_s", "_c", "_nan", "_pos", "_neg"]


def instant_totals(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str, wanted: Column | None = None) -> DataFrame:
    """(_key, _t, totals, _w): one row per key and instant; ``_w``: some row there is wanted."""
    y = F.col("_y")
    special = F.isnan(y) | (F.abs(y) == _INF)
    want = F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))
    t = F.unix_micros(F.col(ts_col).cast("timestamp"))
    return (df.select(F.struct(*keys).alias("_key"), t.alias("_t"), F.col(value_col).cast("double").alias("_y"), want.alias("_w"))
            .where("_t is not null").groupBy("_key", "_t")
            .agg(F.sum(F.when(y.isNotNull() & ~special, y).otherwise(0.0)).alias("_s"), F.count("_y").alias("_c"),
                 *[F.count_if(F.coalesce(cond, F.lit(False))).alias(n) for n, cond in (
                     ("_nan", F.isnan(y)), ("_pos", y == _INF), ("_neg", y == -_INF))],
                 F.max("_w").alias("_w")))


def rolling_mean_bucketed(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str,
                          span_micros: int, gap_micros: int, out_col: str,
                          bucket_micros: int = MICROS_PER_DAY, wanted: Column | None = None) -> DataFrame:
    points = written(instant_totals(df, keys, ts_col, value_col, wanted), "rolling-points")
    rows = df if wanted is None else df.where(wanted)
    return _with_means(rows, points, keys, ts_col, span_micros, gap_micros, out_col, bucket_micros)


def day_totals(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str) -> DataFrame:
    """The totals of every key and instant in a form to be kept: key columns, ``_t``, totals,
    and the instant's ``year`` and ``month`` to partition by. Totals of different rows
    add up, so a new month is appended."""
    t = F.timestamp_micros("_t")
    return (instant_totals(df, keys, ts_col, value_col).select(*[F.col(f"_key.{k}").alias(k) for k in keys], "_t", *_TOTALS)
            .withColumns({"year": F.year(t), "month": F.month(t)}))


def rolling_mean_from_totals(stored: DataFrame, rows: DataFrame, keys: Sequence[str], ts_col: str, value_col: str,
                             span_micros: int, gap_micros: int, out_col: str, bucket_micros: int = MICROS_PER_DAY) -> DataFrame:
    """The mean for ``rows`` over themselves and the kept totals of other rows. Only the
    totals of the frames' span are read: months outside it are pruned."""
    own = instant_totals(rows, keys, ts_col, value_col)
    ends = rows.agg(F.min(F.unix_micros(F.col(ts_col).cast("timestamp"))).alias("a"), F.max(F.unix_micros(F.col(ts_col).cast("timestamp"))).alias("b")).first()
    lo, hi = (ends.a or 0) - span_micros, ends.b or 0
    month = lambda x: F.year(x) * 12 + F.month(x)
    ym = F.col("year") * 12 + F.col("month")
    part = (stored.where((ym >= month(F.timestamp_micros(F.lit(lo)))) & (ym <= month(F.timestamp_micros(F.lit(hi)))))
            .where((F.col("_t") >= lo) & (F.col("_t") <= hi))
            .select(F.struct(*keys).alias("_key"), "_t", *_TOTALS, F.lit(False).alias("_w")))
    both = own.unionByName(part).groupBy("_key", "_t").agg(*[F.sum(c).alias(c) for c in _TOTALS], F.max("_w").alias("_w"))
    return _with_means(rows, written(both, "rolling-points"), keys, ts_col, span_micros, gap_micros, out_col, bucket_micros)


def _with_means(rows: DataFrame, points: DataFrame, keys: Sequence[str], ts_col: str, span_micros: int, gap_micros: int,
                out_col: str, bucket_micros: int) -> DataFrame:
    """``rows`` with the mean over the written ``points`` of their key."""
    key, t = F.struct(*keys), F.unix_micros(F.col(ts_col).cast("timestamp"))
    at = F.col("_t")
    none = [F.lit(0.0), *[F.lit(0).cast("long")] * 4]

    def rec(kind: int, p: Column, values) -> Column:
        return F.struct(F.floor(p / F.lit(bucket_micros)).alias("_b"), p.alias("_p"), F.lit(kind).alias("_kind"),
                        *[v.alias(n) for v, n in zip(values, _TOTALS)])

    # kind: 0 = lower query (before data at equal time), 1 = data, 2 = upper query
    recs = F.array(rec(1, at, [F.col(n) for n in _TOTALS]),
                   F.when(F.col("_w"), rec(2, at - F.lit(gap_micros), none)),
                   F.when(F.col("_w"), rec(0, at - F.lit(span_micros), none)))
    stream = points.select("_key", at.alias("_at"), F.explode(F.filter(recs, lambda r: r.isNotNull())).alias("r")).select(
        "_key", "_at", "r.*")
    in_day = Window.partitionBy("_key", "_b").orderBy("_p", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    queries = stream.select("_key", "_b", "_at", "_kind", *[F.sum(n).over(in_day).alias(n) for n in _TOTALS]).where("_kind <> 1")

    days = stream.groupBy("_key", "_b").agg(*[F.sum(n).alias(n) for n in _TOTALS])
    before = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_key", "_b", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_d{n}") for n in _TOTALS])

    sign = F.when(F.col("_kind") == 2, 1).otherwise(-1)
    frame = queries.join(days, ["_key", "_b"]).groupBy("_key", "_at").agg(
        *[F.sum(sign * (F.col(n) + F.col(f"_d{n}"))).alias(n) for n in _TOTALS])
    c = {n: F.col(n) for n in _TOTALS}
    mean = (F.when((c["_nan"] > 0) | ((c["_pos"] > 0) & (c["_neg"] > 0)), F.lit(float("nan")))
            .when(c["_pos"] > 0, F.lit(_INF)).when(c["_neg"] > 0, F.lit(-_INF)).otherwise(c["_s"] / c["_c"]))
    frame = frame.select("_key", "_at", F.when(c["_c"] > 0, mean).alias(out_col))
    rows = rows.withColumn("_key", key).withColumn("_at", t)
    return rows.join(frame, ["_key", "_at"], "left").drop("_key", "_at")
