"""Error metrics of predictions (error = prediction - truth).

``n`` counts every row, NULL errors included; the other measures skip NULLs.
Median and 90th percentile of the absolute error are exact (see quantiles).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.quantiles import exact_quantiles

# Fixed value: metric columns in published order.
METRIC_COLUMNS = ["model", "split", "n", "mae", "rmse", "median_ae", "p90_ae", "bias"]


def error_metrics(pred: DataFrame, truth_col: str, pred_col: str,
                  group_cols: Sequence[str] = ("model", "split"), digits: int | None = 6) -> DataFrame:
    group_cols = list(group_cols)
    err = F.col(pred_col).cast("double") - F.col(truth_col).cast("double")
    # the two quantile passes read this narrow projection; materialize it once
    # instead of recomputing the predictions upstream twice
    from tarmac.session import written
    base = written(pred.select(*group_cols, err.alias("_err")), "errors").withColumn("_ae", F.abs("_err"))
    out = exact_quantiles(
        base, group_cols, "_ae", [0.5, 0.9], ["median_ae", "p90_ae"],
        extra_aggs=[F.count(F.lit(1)).alias("n"), F.avg("_ae").alias("mae"),
                    F.sqrt(F.avg(F.col("_err") * F.col("_err"))).alias("rmse"),
                    F.avg("_err").alias("bias")])
    cols = [c for c in METRIC_COLUMNS if c in group_cols or c in out.columns]
    cols = group_cols + [c for c in cols if c not in group_cols]
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) if c in ("mae", "rmse", "median_ae",
                                                                "p90_ae", "bias") else F.col(c)
                           for c in cols])
    return out.select(*cols)


def mean_absolute_error(pred: DataFrame, truth_col: str, pred_col: str) -> DataFrame:
    """One-row MAE with NULL errors skipped."""
    err = F.col(pred_col) - F.col(truth_col)
    return pred.agg(F.round(F.avg(F.abs(err)), 6).alias("mae"))


def mae_by_candidate(stored: DataFrame, candidates: dict, truth_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group, candidate, mae) of prediction columns over stored rows, one pass and
    one partial aggregation whatever the number of candidates."""
    errs = F.array(*[F.struct(F.lit(k).alias("candidate"), F.abs(p - F.col(truth_col)).alias("_e")) for k, p in candidates.items()])
    return (stored.select(*group_cols, F.explode(errs).alias("c")).groupBy(*group_cols, F.col("c.candidate").alias("candidate"))
            .agg((F.round(F.avg("c._e"), 6) + F.lit(0.0)).alias("mae")))
