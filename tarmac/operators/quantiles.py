"""Exact quantiles (linear interpolation between order statistics, the
``type 7`` rule) without gathering a group into one task.

Pass 1, one aggregation per group: row count and a mergeable quantile sketch
(``percentile_approx``) read a little below and above each target
probability. The sketch's rank error is at most n/accuracy, so the two values
bracket the wanted order statistics up to one rank at either end.

Pass 2 narrows a bracket that may still hold more than ``MAX_TAIL`` rows: one
aggregation counts rows per slice of the bracket (``SLICES`` of equal width, with
each slice's smallest and largest value), and the slices that hold the wanted
ranks become the new bracket. It repeats until every bracket is small or is a
single value, so no window below ever holds more than about ``MAX_TAIL`` distinct
values or ``SLICES`` rows, however large a group is.

Pass 3, one aggregation over (group, target, zone, value): rows below the
bracket collapse to one row (count, largest value), rows above to one row
(count, smallest value), rows inside to (value, multiplicity) pairs. A running
count over these few rows gives every value its rank range; the two order
statistics around ``h = (n - 1) p`` are picked and interpolated. A rank that the
bracket does not hold is an error, never a NULL.

The brackets (one row per group and target) are written to the shared scratch
folder and broadcast when proven small - otherwise (very many groups) the join
shuffles, spreading the groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.sizing import broadcast_if_bounded
from tarmac.session import written

DEFAULT_ACCURACY = 10_000
MAX_TAIL = 200_000
SLICES = 4096


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], names: Sequence[str] | None = None,
                    accuracy: int = DEFAULT_ACCURACY,
                    extra_aggs: Sequence[Column] = (), max_tail: int = MAX_TAIL) -> DataFrame:
    """Columns ``group_cols + extra + names``: the exact ``probs`` quantiles of
    ``value_col`` per group (NULL values skipped; NULL when a group has no
    value). ``extra_aggs`` are evaluated over all rows of the group in pass 1.
    Group keys must not be NULL."""
    group_cols = list(group_cols)
    names = list(names or [f"q_{i}" for i in range(len(probs))])
    margin = 5.0 / accuracy
    lo_p = [max(0.0, p - margin) for p in probs]
    hi_p = [min(1.0, p + margin) for p in probs]
    k = len(probs)
    v = F.col(value_col).cast("double")

    stats = df.groupBy(*group_cols).agg(
        *extra_aggs, F.count(v).alias("_n"),
        F.percentile_approx(v, lo_p + hi_p, accuracy).alias("_br"))
    stats = written(stats, "quantile-stats")
    extra_names = [c for c in stats.columns if c not in group_cols + ["_n", "_br"]]
    targets = F.array(*[F.struct(F.lit(i).alias("i"), F.col("_br")[i].alias("lo"),
                                 F.col("_br")[k + i].alias("hi"),
                                 ((F.col("_n") - 1) * F.lit(float(p))).alias("h"))
                        for i, p in enumerate(probs)])
    bounds = stats.where(F.col("_n") > 0).select(*group_cols, F.explode(targets).alias("t"),
                                                 F.ceil(F.col("_n") * (4 * margin)).alias("_in"))
    base = df.select(*group_cols, v.alias("_v")).where(F.col("_v").isNotNull())
    bounds = _narrowed(base, bounds, group_cols, max_tail)
    lo, hi = F.col("t.lo"), F.col("t.hi")
    zone = F.when(F.col("_v") < lo, -1).when(F.col("_v") > hi, 1).otherwise(0)
    z = (base.join(broadcast_if_bounded(bounds), group_cols)
         .select(*group_cols, F.col("t.i").alias("i"), F.col("t.h").alias("h"), "_v",
                 zone.alias("_zone"))
         .groupBy(*group_cols, "i", "h", "_zone", F.when(F.col("_zone") == 0, F.col("_v")).alias("_key"))
         .agg(F.count(F.lit(1)).alias("_m"), F.max("_v").alias("_max"), F.min("_v").alias("_min")))

    w = Window.partitionBy(*group_cols, "i").orderBy("_zone", "_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (z.withColumn("_cum", F.sum("_m").over(w))
              .withColumn("_first", F.col("_cum") - F.col("_m"))
              .withColumn("_last", F.col("_cum") - 1))

    def value_at(rank: Column) -> Column:
        zone_ = F.col("_zone")
        inside = (zone_ == 0) & (F.col("_first") <= rank) & (rank <= F.col("_last"))
        return (F.when(inside, F.col("_key"))
                .when((zone_ == -1) & (F.col("_last") == rank), F.col("_max"))
                .when((zone_ == 1) & (F.col("_first") == rank), F.col("_min")))

    h = F.col("h")
    def found(c: Column) -> Column:
        return F.coalesce(c, F.raise_error(F.lit("a quantile's bracket lost its rank")).cast("double"))

    picked = ranked.groupBy(*group_cols, "i", "h").agg(
        F.max(value_at(F.floor(h))).alias("_xlo"), F.max(value_at(F.ceil(h))).alias("_xhi")).select(
        *group_cols, "i", "h", found(F.col("_xlo")).alias("_xlo"), found(F.col("_xhi")).alias("_xhi"))
    q = F.col("_xlo") + (h - F.floor(h)) * (F.col("_xhi") - F.col("_xlo"))
    wide = picked.withColumn("_q", q).groupBy(*group_cols).agg(
        *[F.max(F.when(F.col("i") == i, F.col("_q"))).alias(nm) for i, nm in enumerate(names)])
    return (stats.select(*group_cols, *extra_names)
            .join(wide, group_cols, "left")
            .select(*group_cols, *extra_names, *names))


def _narrowed(base: DataFrame, bounds: DataFrame, group_cols: list[str], max_tail: int) -> DataFrame:
    """``bounds`` (group, t, _in) with brackets cut down until ``_in``, a bound on
    the rows inside, is at most ``max_tail`` or the bracket is a single value."""
    last = None
    while True:
        bounds = written(bounds, "quantile-bounds")
        open_ = bounds.where((F.col("_in") > max_tail) & (F.col("t.lo") < F.col("t.hi")))
        left = open_.agg(F.sum("_in")).first()[0]
        if not left or left == last:
            return bounds.drop("_in")
        last = left
        j = base.join(broadcast_if_bounded(open_), group_cols).where(F.col("_v") <= F.col("t.hi"))
        width = F.col("t.hi") - F.col("t.lo")
        at = F.floor((F.col("_v") - F.col("t.lo")) / width * SLICES)
        cut = F.when(F.col("_v") < F.col("t.lo"), -1).when((width < float("inf")) & (width > 0),
                                                            F.least(at, F.lit(SLICES - 1))).otherwise(0)
        counts = j.groupBy(*group_cols, "t", cut.cast("int").alias("_cut")).agg(
            F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        w = Window.partitionBy(*group_cols, "t").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_first", F.coalesce(F.sum("_m").over(w), F.lit(0)))
        holds = ((F.col("_cut") >= 0) & (F.col("_first") <= F.ceil("t.h"))
                 & (F.floor("t.h") < F.col("_first") + F.col("_m")))
        new = counts.where(holds).groupBy(*group_cols, "t").agg(
            F.min("_a").alias("_a"), F.max("_b").alias("_b"), F.sum("_m").alias("_in")).select(
            *group_cols, F.struct(F.col("t.i").alias("i"), F.col("_a").alias("lo"), F.col("_b").alias("hi"),
                                  F.col("t.h").alias("h")).alias("t"), "_in")
        rest = bounds.where(~((F.col("_in") > max_tail) & (F.col("t.lo") < F.col("t.hi"))))
        bounds = rest.unionByName(new)
