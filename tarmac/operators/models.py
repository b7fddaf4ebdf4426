"""Model jobs: ridge path with validation-chosen penalty, the elastic-net recipe,
and boosted trees with early stopping.

The linear models need only second moments of their design (``operators.moments``):
every penalty of the ridge path and the elastic net are solved from them. Frames that
several passes read are written once as pruned Parquet to the shared scratch
folder, so a lost executor does not replay the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.splines import natural_spline_basis
from tarmac.operators import prep as pp
from tarmac.operators.boosting import BLOCK, boost
from tarmac.operators.evaluate import error_metrics, mean_absolute_error
from tarmac.operators.moments import Moments, RidgePath, elastic_net, split_moments
from tarmac.operators.quantiles import exact_quantiles
from tarmac.operators.sizing import broadcast_if_bounded
from tarmac.session import written

TARGET = "dep_delay_min"

# Model labels and report columns as they appear in the
# published metrics and prediction files.
MODEL_ROLLING_90D = "rolling_avg_90d"
MODEL_RIDGE = "glmnet_ridge"
MODEL_TREE = "xgboost_v1"
PRED_RIDGE = "pred_glmnet"
EN_MAE, EN_RMSE, BASELINE_30D_MAE = "glmnet_mae", "glmnet_rmse", "baseline30d_mae"


# ---------------------------------------------------------------- ridge (baseline_v2)
#: suffixes of a factor's level place and of its design column
PLACE, COLUMN = "__p", "__j"


def design_columns(aligned: DataFrame, levels: dict[str, list[str]], factors: Sequence[str], first: int) -> tuple[DataFrame, int]:
    """``aligned`` with every factor's place turned into its design column (NULL for the
    levels before ``first``, which have none), and the number of those columns."""
    width, cols = 0, {}
    for c in factors:
        cols[f"{c}{COLUMN}"] = F.when(F.col(f"{c}{PLACE}") >= first, F.col(f"{c}{PLACE}") + F.lit(width - first)).cast("int")
        width += len(levels[c]) - first
    return aligned.withColumns(cols).drop(*[f"{c}{PLACE}" for c in factors]), width


def prepare_ridge(split_df: DataFrame, keep: Sequence[str] = ("flight_id", "split")):
    """(aligned and imputed ridge frame with the factors' design columns, level lists,
    train medians). Columns named in ``keep`` that are predictors too stay beside the
    aligned ones as ``key_*``."""
    keys = [c for c in keep if c in pp.RIDGE_FACTORS + pp.RIDGE_NUMERICS]
    rows = split_df.withColumns({f"key_{c}": F.col(c) for c in keys}) if keys else split_df
    kept = [f"key_{c}" if c in keys else c for c in keep]
    # levels, medians and the aligned frame all read this: write it once
    rf = written(pp.ridge_features(rows, keep=kept), "ridge-frame")
    train = rf.where(F.col("split") == "train")
    table = written(pp.category_levels(train, pp.RIDGE_FACTORS, "other"), "ridge-levels")
    levels = pp.level_lists(table)
    medians = pp.median_values(pp.train_medians(train, pp.RIDGE_NUMERICS))
    aligned = pp.align_levels(rf, table, pp.RIDGE_FACTORS, "other", index=PLACE)
    return design_columns(pp.impute_medians(aligned, medians), levels, pp.RIDGE_FACTORS, 1)[0], levels, medians


def ridge_terms(levels: dict[str, list[str]], factors: Sequence[str] = pp.RIDGE_FACTORS,
                numerics: Sequence[str] = pp.RIDGE_NUMERICS) -> list[str]:
    """Name of every design column: ``col=level`` for each level but the factor's
    first (treatment coding), then the numerics."""
    return [f"{c}={lv}" for c in factors for lv in levels[c][1:]] + list(numerics)


def design_entries(aligned: DataFrame, levels: dict[str, list[str]], keep: Sequence[str],
                   factors: Sequence[str] = pp.RIDGE_FACTORS,
                   numerics: Sequence[str] = pp.RIDGE_NUMERICS) -> DataFrame:
    """Long form of the design: one row per nonzero entry (term, value), taken from
    the aligned columns, so work follows the columns and not the design's width."""
    def entry(cond, term, value):
        return F.when(cond, F.struct(term.alias("term"), value.cast("double").alias("value")))

    parts = [entry(F.col(c) != levels[c][0], F.concat(F.lit(f"{c}="), F.col(c)), F.lit(1.0)) for c in factors]
    parts += [entry(F.col(c) != 0, F.lit(c), F.col(c)) for c in numerics]
    entries = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return aligned.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.term", "e.value")


class Design:
    """Design rows of Arrow batches: the factors' columns (``width`` where a row has none)
    and the dense columns after them."""

    def __init__(self, factors: Sequence[str], numerics: Sequence[str], width: int):
        self.factors, self.numerics, self.width = list(factors), list(numerics), width
        self.columns = [*[f"{c}{COLUMN}" for c in factors], *numerics]

    def predicted(self, b: pa.RecordBatch, intercepts: np.ndarray, coefs: np.ndarray) -> np.ndarray:
        """(rows, fits) predictions of a batch."""
        num = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in self.numerics], 1)
        factor = np.vstack([coefs[:self.width], np.zeros((1, coefs.shape[1]))])
        out = intercepts[None] + num @ coefs[self.width:]
        for c in self.factors:
            out += factor[b.column(f"{c}{COLUMN}").fill_null(self.width).to_numpy(zero_copy_only=False)]
        return out


def ridge_design_of(levels: dict[str, list[str]]) -> Design:
    return Design(pp.RIDGE_FACTORS, pp.RIDGE_NUMERICS, sum(len(levels[c]) - 1 for c in pp.RIDGE_FACTORS))


def design_moments(aligned: DataFrame, design: Design) -> dict[str, Moments]:
    """The moments of the train and validation rows."""
    rows = aligned.where(F.col("split").isin("train", "validation"))
    return split_moments(rows, [f"{c}{COLUMN}" for c in design.factors], design.width, design.numerics, TARGET)


#: coefficients (width x fits) that one scoring pass carries to the tasks
PASS_COEFFICIENTS = 4_000_000


def mae_by_penalty(rows: DataFrame, design: Design, fits: list[tuple[float, np.ndarray]]) -> list[float]:
    """Mean absolute error of every fit over ``rows``, in one pass (more only for designs so
    wide that all fits together would not fit a task)."""
    at_once = max(1, PASS_COEFFICIENTS // max(1, len(fits[0][1])))
    if len(fits) > at_once:
        return [m for k in range(0, len(fits), at_once) for m in mae_by_penalty(rows, design, fits[k:k + at_once])]
    b0, coefs = np.array([f[0] for f in fits]), np.stack([f[1] for f in fits], 1)

    def work(batches):
        total, n = np.zeros(len(b0)), 0
        for b in batches:
            y = b.column(TARGET).to_numpy(zero_copy_only=False).astype(float)
            total += np.abs(design.predicted(b, b0, coefs) - y[:, None]).sum(0)
            n += len(y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(b0))), pa.array(total), pa.array(np.full(len(b0), n))], ["k", "s", "n"])

    got = (rows.where(F.col(TARGET).isNotNull()).select(TARGET, *design.columns).mapInArrow(work, "k long, s double, n long")
           .groupBy("k").agg((F.sum("s") / F.sum("n")).alias("mae")).collect())
    out = {r.k: r.mae for r in got}
    return [out[k] if out.get(k) is not None else float("inf") for k in range(len(fits))]


def linear_predict(rows: DataFrame, design: Design, fit: tuple[float, np.ndarray], out_col: str = PRED_RIDGE) -> DataFrame:
    """``rows`` without their design columns and with the prediction."""
    b0, coef = np.array([fit[0]]), fit[1][:, None]
    kept = [c for c in rows.columns if not c.endswith(COLUMN)]

    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(design.predicted(b, b0, coef)[:, 0])], [*kept, out_col])

    return rows.mapInArrow(work, T.StructType([*rows.select(*kept).schema.fields, T.StructField(out_col, T.DoubleType())]))


@dataclass
class RidgeResult:
    best_lambda: float
    valid_pred: DataFrame
    test_pred: DataFrame
    metrics: DataFrame
    lambdas: list[float] = field(default_factory=list)
    valid_mae: list[float] = field(default_factory=list)
    model: dict = field(default_factory=dict)


def ridge_path(split_df: DataFrame, keep: Sequence[str] = ("flight_id", "split"),
               n_lambdas: int = 100, model_name: str = MODEL_RIDGE) -> RidgeResult:
    """Penalty with the smallest validation MAE of a path fitted on train (the larger
    one on a tie), refit on train + validation for the test rows."""
    aligned, levels, medians = prepare_ridge(split_df, keep)
    aligned, design = written(aligned, "ridge-design"), ridge_design_of(levels)
    moments = design_moments(aligned, design)
    path = RidgePath(moments["train"])
    lambdas = path.lambdas(n_lambdas)
    fits = path.fits(lambdas)
    valid = aligned.where(F.col("split") == "validation")
    maes = mae_by_penalty(valid, design, fits)
    best = int(np.argmin(maes))
    both = moments["train"] + moments["validation"] if "validation" in moments else moments["train"]
    final = RidgePath(both).fit(lambdas[best])
    valid_pred = linear_predict(valid, design, fits[best])
    test_pred = linear_predict(aligned.where(F.col("split") == "test"), design, final)
    metrics = error_metrics(valid_pred.unionByName(test_pred).withColumn("model", F.lit(model_name)),
                            TARGET, PRED_RIDGE)
    model = {"best_lambda": lambdas[best], "intercept": final[0], "terms": dict(zip(ridge_terms(levels), final[1].tolist())),
             "levels": levels, "medians": medians}
    return RidgeResult(lambdas[best], valid_pred, test_pred, metrics, lambdas, maes, model)


#: what a stored prediction carries beside the two predictions
PREDICTION_KEYS = ("split", "sched_dep_tstz", "carrier", "origin", "dest", "pred_rolling_avg")


def stored_predictions(res: RidgeResult) -> DataFrame:
    """Validation and test rows: keys, truth, 90-day average, ridge prediction."""
    both = with_keys(res.valid_pred.unionByName(res.test_pred))
    return both.select("split", "sched_dep_tstz", "carrier", "origin", "dest", TARGET, "pred_rolling_avg", PRED_RIDGE)


def with_keys(pred: DataFrame) -> DataFrame:
    """Predictions with the flight's own keys in place of the aligned factors."""
    names = [c[4:] for c in pred.columns if c.startswith("key_")]
    return pred.withColumns({c: F.col(f"key_{c}") for c in names}).drop(*[f"key_{c}" for c in names])


# ---------------------------------------------------------------- elastic net recipe
def hour_spline_table(spark, train: DataFrame, col: str = "dep_hour_local", df: int = 5,
                      hours: Sequence[int] = range(24)) -> DataFrame:
    """(hour, ns_1..ns_df): natural spline basis with knots at train quantiles."""
    probs = [i / df for i in range(1, df)]
    q = exact_quantiles(train.withColumn("_g", F.lit(1)), ["_g"], col, probs).first()
    mm = train.agg(F.min(col), F.max(col)).first()
    knots = [q[f"q_{i}"] for i in range(len(probs))]
    basis = natural_spline_basis(list(hours), knots, (mm[0], mm[1]))
    rows = [(int(h), *[float(v) for v in basis[i]]) for i, h in enumerate(hours)]
    names = [f"{col}_ns_{j + 1}" for j in range(basis.shape[1])]
    return spark.createDataFrame(rows, ", ".join([f"{col} long"] + [f"{n} double" for n in names]))


# The recipe's predictors.
EN_NOMINAL = ["carrier", "origin", "dest"]
EN_NUMERIC = ["dow", "temp", "prcp", "wspd", "rhum", "coco"]


def recipe_levels_joined(rows: DataFrame, levels: DataFrame, names: dict[str, list[str]], hours: DataFrame,
                         medians: dict[str, float] | None) -> tuple[DataFrame, Design]:
    """The recipe's steps that learn nothing, on ``rows``: design column per nominal level
    (a level that train lacks gets the column of ``other``, which no train row has), hour
    basis joined, numerics imputed where medians are given."""
    spline = [c for c in hours.columns if c != "dep_hour_local"]
    numerics = EN_NUMERIC + spline
    out = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in EN_NOMINAL})
    out = pp.align_levels(out, levels, EN_NOMINAL, "other", index=PLACE)
    out, width = design_columns(out, names, EN_NOMINAL, 0)
    out = out.join(broadcast_if_bounded(hours, 10_000), "dep_hour_local", "left")
    out = out.withColumns({c: F.col(c).cast("double") for c in numerics})
    return (pp.impute_medians(out, medians) if medians else out), Design(EN_NOMINAL, numerics, width)


def recipe_frame(train: DataFrame, test: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, Design, dict]:
    """(rows of both parts with the recipe's columns, their design, what was learned).
    Recipe: unseen level -> ``other``, NULL -> ``unknown``, one indicator per level, natural
    spline (df 5) on the hour, train-median imputation."""
    cols = [*keep, *EN_NOMINAL, *EN_NUMERIC, "dep_hour_local", TARGET]
    both = train.select(*cols).withColumn("split", F.lit("train")).unionByName(test.select(*cols).withColumn("split", F.lit("test")))
    both = written(both, "recipe-rows")
    is_train = F.col("split") == "train"
    named = both.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in EN_NOMINAL})
    table = written(pp.category_levels(named.where(is_train), EN_NOMINAL, "other"), "recipe-levels")
    levels = pp.level_lists(table)
    hours = hour_spline_table(both.sparkSession, both.where(is_train))
    joined, design = recipe_levels_joined(both, table, levels, hours, None)
    joined = written(joined, "recipe-joined")
    medians = pp.median_values(pp.train_medians(joined.where(is_train), design.numerics))
    learned = {"levels": levels, "medians": medians, "hour_basis": [r.asDict() for r in hours.collect()]}
    return written(pp.impute_medians(joined, medians), "recipe-design"), design, learned


def elastic_net_fit(train: DataFrame, test: DataFrame, penalty: float = 0.01,
                    mixture: float = 0.5) -> tuple[DataFrame, dict]:
    """(one row with the test MAE and RMSE, the model as a dict): the recipe's columns, those
    that are constant in train left out, fitted by ``moments.elastic_net`` from one pass over
    the train rows. Rows without a target cannot be fitted; they still shape levels and medians."""
    both, design, learned = recipe_frame(train, test)
    fitted = both.where(F.col("split") == "train")
    moments = split_moments(fitted, [f"{c}{COLUMN}" for c in EN_NOMINAL], design.width, design.numerics, TARGET)["train"]
    intercept, coef = elastic_net(moments, penalty, mixture)
    pred = linear_predict(both.where(F.col("split") == "test"), design, (intercept, coef), "prediction")
    err = F.col("prediction") - F.col(TARGET)
    scores = pred.agg(F.round(F.avg(F.abs(err)), 6).alias(EN_MAE),
                      F.round(F.sqrt(F.avg(err * err)), 6).alias(EN_RMSE))
    terms = [f"{c}={lv}" for c in EN_NOMINAL for lv in learned["levels"][c]] + design.numerics
    return scores, {**learned, "penalty": penalty, "mixture": mixture, "intercept": intercept, "terms": dict(zip(terms, coef.tolist()))}


def elastic_net_predict(rows: DataFrame, model: dict, out_col: str = "prediction") -> DataFrame:
    """``rows`` with the prediction of a stored elastic-net model."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(c, lv, i) for c in EN_NOMINAL for i, lv in enumerate(model["levels"][c])],
                                  "feature string, level string, idx long")
    names = list(model["hour_basis"][0])
    hours = spark.createDataFrame([tuple(r[n] for n in names) for r in model["hour_basis"]],
                                  ", ".join(f"{n} {'long' if n == 'dep_hour_local' else 'double'}" for n in names))
    # the row's own values stand beside the recipe's
    own = [c for c in rows.columns if c in EN_NOMINAL + EN_NUMERIC]
    kept = rows.withColumns({f"_own_{c}": F.col(c) for c in own})
    joined, design = recipe_levels_joined(kept, table, model["levels"], hours, model["medians"])
    terms = [f"{c}={lv}" for c in EN_NOMINAL for lv in model["levels"][c]] + design.numerics
    out = linear_predict(joined, design, (model["intercept"], np.array([model["terms"][t] for t in terms])), out_col)
    return out.select(*[(F.col(f"_own_{c}") if c in own else F.col(c)).alias(c) for c in rows.columns], out_col)


def train_baseline(train: DataFrame, test: DataFrame, rolled: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """(one row: 30-day rolling baseline MAE, elastic-net MAE and RMSE; the model).
    ``rolled``: the 30-day predictions where they are at hand."""
    from tarmac.operators.baselines import rolling_30d_backfilled
    base = mean_absolute_error(rolling_30d_backfilled(train, test) if rolled is None else rolled, TARGET, "yhat_baseline")
    scores, model = elastic_net_fit(train, test)
    b = base.first()["mae"]
    return scores.select(F.lit(b).cast("double").alias(BASELINE_30D_MAE), EN_MAE, EN_RMSE), model


# ---------------------------------------------------------------- boosted trees
@dataclass
class TreeResult:
    best_iteration: int
    valid_pred: DataFrame
    test_pred: DataFrame
    metrics: DataFrame
    model: PipelineModel | None = None
    metadata: dict = field(default_factory=dict)


def prepare_tree(split_df: DataFrame):
    """Tree frame with levels aligned (``missing`` / ``other``), numerics
    imputed with train medians, factors indexed (``<col>__i``) over the
    sorted level lists, and the assembled ``features``; plus the level lists, the
    medians and the design stages."""
    tf = written(pp.tree_features(split_df), "tree-frame")
    train0 = tf.where(F.col("split") == "train")
    table = written(pp.category_levels(train0, pp.TREE_FACTORS, "missing"), "tree-levels")
    levels = pp.level_lists(table)
    medians = pp.median_values(pp.train_medians(train0, pp.TREE_NUMERICS))
    aligned = pp.impute_medians(pp.align_levels(tf, table, pp.TREE_FACTORS, "missing"), medians)
    idx = [StringIndexerModel.from_labels(levels[c], inputCol=c, outputCol=f"{c}__i")
           for c in pp.TREE_FACTORS]
    asm = VectorAssembler(inputCols=[f"{c}__i" for c in pp.TREE_FACTORS] + pp.TREE_NUMERICS,
                          outputCol="features")
    design = PipelineModel(stages=[*idx, asm])
    return design.transform(aligned), levels, medians, design


def gbt_run(split_df: DataFrame, max_rounds: int = 1000, patience: int = 40, seed: int = 42,
            model_name: str = MODEL_TREE, block: int = BLOCK, folder: str | None = None) -> TreeResult:
    """Boosted trees on train, their number chosen by the validation error. With ``folder`` a
    run that was stopped goes on where it was (see ``operators.boosting``)."""
    x, levels, medians, design = prepare_tree(split_df)
    keep = [c for c in ("flight_id",) if c in x.columns]
    x = written(x.select(*keep, "split", TARGET, "features"), "tree-design")
    train, valid, test = (x.where(F.col("split") == s) for s in ("train", "validation", "test"))
    max_levels = max(len(v) for v in levels.values())
    run = boost(train, valid, TARGET, max_rounds=max_rounds, patience=patience, seed=seed, block=block, folder=folder,
                maxDepth=6, minInstancesPerNode=100, subsamplingRate=0.8, featureSubsetStrategy="0.8", maxBins=max(32, max_levels))
    vp, tp = (run.predict(d, "pred") for d in (valid, test))
    metrics = error_metrics(vp.unionByName(tp).withColumn("model", F.lit(model_name)), TARGET, "pred")
    meta = {"target": TARGET, "levels": levels, "medians": medians, "categorical": pp.TREE_FACTORS, "numeric": pp.TREE_NUMERICS,
            "best_iteration": run.best, "best_score": run.curve[run.best - 1], "curve": run.curve, "seed": seed,
            "params": {"max_depth": 6, "step": run.step, "min_rows": 100, "row_share": 0.8, "column_share": 0.8}}
    return TreeResult(run.best, vp.drop("features"), tp.drop("features"), metrics,
                      PipelineModel(stages=[*design.stages, *run.model().stages]), meta)


def tree_predictions(res: TreeResult) -> DataFrame:
    """split, truth, pred, err rows (the optional predictions sink)."""
    both = res.valid_pred.unionByName(res.test_pred)
    return both.select("split", F.col(TARGET).alias("truth"), "pred",
                       (F.col("pred") - F.col(TARGET)).alias("err"))
