"""Model jobs (rows-only checks) and the SQL-checked design matrices."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.core import Ctx, query, r6
from tarmac.plans import queries_prep  # noqa: F401  (registers the SQL steps used here)
from tarmac.plans.oracle import compose, cte
from tarmac.operators import evaluate as ev
from tarmac.operators import models as mdl
from tarmac.operators import moments as mo
from tarmac.operators import prep as pp
from tarmac.operators.quantiles import exact_quantiles
from tarmac.operators.sizing import broadcast_if_bounded
from tarmac.plans.queries_baselines import _m1_parts, _ravg90, _split
from tarmac.session import scratch_path, written
from tarmac.sources import sinks


# ====================================================================== models (rows-only checks)

# The published round limit; 40-round patience stops the fixture runs far earlier.
GBT_MAX_ROUNDS = 1000


@query("ridge_metrics")
def _ridge_metrics(c: Ctx) -> DataFrame:
    """Ridge path on train, penalty chosen by validation MAE, refit on
    train+validation, metrics on validation and test."""
    return mdl.ridge_path(_split(c)).metrics


def _stored(c: Ctx) -> DataFrame:
    """Per row: the flight's keys, 90-day average and ridge predictions side by side."""
    train = (_split(c).where(F.col("split") == "train")
             .withColumn("pred_rolling_avg", F.lit(None).cast("double")))
    res = mdl.ridge_path(train.unionByName(_ravg90(c)), keep=mdl.PREDICTION_KEYS)
    return mdl.stored_predictions(res)


@query("predictions")
def _predictions(c: Ctx) -> DataFrame:
    return _stored(c)


# every column of the predictions but the ridge value
query("predictions_keys", compose("""
select split, sched_dep_tstz, carrier, origin, dest, dep_delay_min, round(pred_rolling_avg, 6) as pred_rolling_avg
from ravg90""", "ravg90"))(
    lambda c: _stored(c).drop(mdl.PRED_RIDGE).withColumn("pred_rolling_avg", r6(F.col("pred_rolling_avg"))))


@query("mae_by_candidate", compose("""
select split, s / 10.0::double as candidate, round(avg(abs(s / 10.0::double * pred_rolling_avg - dep_delay_min)), 6) as mae
from ravg90, range(11) r(s) group by all""", "ravg90"))
def _mae_by_candidate(c: Ctx) -> DataFrame:
    """MAE of every candidate over stored predictions in one pass: the 90-day
    average shrunk by 0, 0.1, ... 1."""
    return ev.mae_by_candidate(written(_ravg90(c).select("split", "dep_delay_min", "pred_rolling_avg"), "stored"),
                               {k / 10.0: F.lit(k / 10.0) * F.col("pred_rolling_avg") for k in range(11)},
                               "dep_delay_min", ["split"])


cte("recipe", """
select flight_id, split, dep_delay_min, dep_hour_local, dow, temp, prcp, wspd, rhum, coco, """ + ", ".join(
    f"coalesce({c}, 'unknown') as {c}" for c in mdl.EN_NOMINAL) + " from known_rows", ("known_rows",))

_en_terms = " union ".join(
    [f"select concat('{c}=', {c}) as term from recipe where split = 'train' and dep_delay_min is not null" for c in mdl.EN_NOMINAL]
    + [f"select '{t}' as term" for t in [*mdl.EN_NUMERIC, *(f"dep_hour_local_ns_{k}" for k in range(1, 6))]])


@query("elastic_net_optimality", compose(f"select term, cast(0 as double) as violation from ({_en_terms}) t", "recipe"))
def _en_optimality(c: Ctx) -> DataFrame:
    """The elastic net fitted from moments, tried on the train rows: the error's slope along a
    scaled column is the penalty's edge where the column is used, and below it elsewhere."""
    both, design, learned = mdl.recipe_frame(*_m1_parts(c), keep=["flight_id"])
    train = both.where((F.col("split") == "train") & F.col(mdl.TARGET).isNotNull())
    penalty, mixture = 0.01, 0.5
    moments = mo.split_moments(train, [f"{x}{mdl.COLUMN}" for x in mdl.EN_NOMINAL], design.width, design.numerics, mdl.TARGET)["train"]
    fit = mo.elastic_net(moments, penalty, mixture)
    terms = [f"{x}={lv}" for x in mdl.EN_NOMINAL for lv in learned["levels"][x]] + design.numerics
    rows = mdl.linear_predict(train, design, fit, "_pred").withColumn("_e", F.col(mdl.TARGET) - F.col("_pred"))
    entry = [F.struct(F.concat(F.lit(f"{x}="), F.col(x)).alias("term"), F.lit(1.0).alias("v")) for x in mdl.EN_NOMINAL]
    entry += [F.struct(F.lit(x).alias("term"), F.col(x).alias("v")) for x in design.numerics]
    v = F.col("x.v")
    sums = rows.select("_e", F.explode(F.array(*entry)).alias("x")).groupBy("x.term").agg(
        F.sum(v * F.col("_e")).alias("s"), F.sum(v).alias("a"), F.sum(v * v).alias("q"))
    n, y_sd = moments.n, float(np.sqrt((moments.diagonal[-1] - moments.sums[-1] ** 2 / moments.n) / (moments.n - 1)))
    coef = broadcast_if_bounded(c.spark.createDataFrame(list(zip(terms, fit[1].tolist())), "term string, coef double"))
    sd = F.sqrt((F.col("q") - F.col("a") * F.col("a") / n) / (n - 1))
    slope = F.col("s") / (n * y_sd) / F.col("sd") - F.lit(penalty / y_sd * (1 - mixture)) * F.col("coef") * F.col("sd") / y_sd
    edge = penalty / y_sd * mixture
    off = F.when(F.col("coef") != 0, F.abs(slope - edge * F.signum("coef"))).otherwise(F.greatest(F.lit(0.0), F.abs(slope) - edge))
    return sums.join(coef, "term").withColumn("sd", sd).select("term", r6(off).alias("violation"))


@query("elastic_net_metrics")
def _en_metrics(c: Ctx) -> DataFrame:
    """30-day baseline MAE plus elastic-net MAE / RMSE on the test month."""
    return mdl.train_baseline(*_m1_parts(c))[0]


@query("gbt_metrics")
def _gbt_metrics(c: Ctx) -> DataFrame:
    return mdl.gbt_run(_split(c), max_rounds=GBT_MAX_ROUNDS).metrics


@query("metrics_comparison")
def _metrics_cmp(c: Ctx) -> DataFrame:
    """Stored baseline metrics (90-day average, ridge) with the tree metrics appended."""
    sp = written(_split(c), "split")  # the average, the ridge and the trees all read it
    path = scratch_path(c.spark, f"metrics/{uuid.uuid4().hex}")
    base = ev.error_metrics(_ravg90(c, sp).withColumn("model", F.lit(mdl.MODEL_ROLLING_90D)), "dep_delay_min", "pred_rolling_avg")
    sinks.write_small_csv(base.unionByName(mdl.ridge_path(sp).metrics), path)
    return sinks.append_metrics(c.spark, mdl.gbt_run(sp, max_rounds=GBT_MAX_ROUNDS).metrics, path)


# ====================================================================== design matrices
def _med_sql(name: str, src: str, cols) -> None:
    cte(name, " union all ".join(
        f"select '{c}' as feature, coalesce(quantile_cont({c}, 0.5), 0) as median "
        f"from {src} where split = 'train'" for c in cols), (src,))


def _aligned_sql(name, src, lv, med, factors, numerics, missing):
    parts = []
    for col in factors:
        v = f"(case when {col} is null or {col} = '' then 'missing' else {col} end)" if missing else col
        parts.append(f"case when {v} in (select level from {lv} where feature = '{col}') "
                     f"then {v} else 'other' end as {col}")
    parts += [f"coalesce({c}, (select median from {med} where feature = '{c}')) as {c}"
              for c in numerics]
    cte(name, f"select flight_id, split, {', '.join(parts)} from {src}", (src, lv, med))


_med_sql("rmed", "rf", pp.RIDGE_NUMERICS)
_aligned_sql("ra", "rf", "lv_other", "rmed", pp.RIDGE_FACTORS, pp.RIDGE_NUMERICS, False)
_ridge_terms = " union all ".join(
    [f"select flight_id, split, concat('{c}=', {c}) as term, cast(1 as double) as value from ra "
     f"where {c} <> (select level from lv_other where feature = '{c}' and idx = 0)"
     for c in pp.RIDGE_FACTORS]
    + [f"select flight_id, split, '{c}' as term, round({c}, 6) as value from ra where {c} <> 0"
       for c in pp.RIDGE_NUMERICS])


@query("ridge_design", compose(_ridge_terms, "ra"))
def _ridge_design(c: Ctx) -> DataFrame:
    """Nonzero entries of the ridge design matrix (first level of each factor
    dropped, numerics imputed with train medians) as (term, value) rows."""
    aligned, levels, _ = mdl.prepare_ridge(_split(c))
    return mdl.design_entries(aligned, levels, ["flight_id", "split"]).withColumn("value", r6(F.col("value")))


# the moments by definition: every pair of nonzero entries of a row, averaged over the split's rows
cte("design_long", " union all ".join(
    [f"select flight_id, split, concat('{c}=', {c}) as term, cast(1 as double) as value from ra "
     f"where {c} <> (select level from lv_other where feature = '{c}' and idx = 0)" for c in pp.RIDGE_FACTORS]
    + [f"select flight_id, split, '{c}' as term, {c} as value from ra" for c in pp.RIDGE_NUMERICS]
    + ["select flight_id, split, '1' as term, 1 as value from ra",
       "select flight_id, split, 'dep_delay_min' as term, dep_delay_min as value from rf"]), ("ra", "rf", "lv_other"))


@query("ridge_moments", compose("""
select * from (
  select p.split, p.term as term, q.term as with_term,
    round(sum(p.value * q.value) / (select count(*) from ra where ra.split = p.split), 3) as mean_product
  from design_long p join design_long q on p.flight_id = q.flight_id and p.split = q.split and p.term <= q.term
  where p.split in ('train', 'validation') group by p.split, p.term, q.term) m
where mean_product <> 0""", "design_long"))
def _ridge_moments(c: Ctx) -> DataFrame:
    """Second moments of the ridge design (levels, numerics, constant, target) per split."""
    aligned, levels, _ = mdl.prepare_ridge(_split(c))
    design = mdl.ridge_design_of(levels)
    rows = aligned.where(F.col("split").isin("train", "validation"))
    table = written(mo.moment_entries(rows, [f"{f}{mdl.COLUMN}" for f in design.factors], design.width, design.numerics, mdl.TARGET), "moments")
    names = [*mdl.ridge_terms(levels), "1", mdl.TARGET]
    one = len(names) - 2
    n = table.where((F.col("i") == one) & (F.col("j") == one)).select("split", F.col("value").alias("n"))
    terms = broadcast_if_bounded(c.spark.createDataFrame(list(enumerate(names)), "k int, name string"))
    out = (table.join(F.broadcast(n), "split")  # one row per split
           .join(terms.select(F.col("k").alias("i"), F.col("name").alias("a")), "i")
           .join(terms.select(F.col("k").alias("j"), F.col("name").alias("b")), "j"))
    return out.select("split", F.least("a", "b").alias("term"), F.greatest("a", "b").alias("with_term"),
                      (F.round(F.col("value") / F.col("n"), 3) + F.lit(0.0)).alias("mean_product")).where("mean_product <> 0")


# coefficients of the scoring pass by a rule, so that SQL knows them: from a term's length and the fit's number
_N_FITS = 11


def _rule(term: str, k: int) -> float:
    return (len(term) % 7 - 3) / 10 + k / 100


cte("rule_scores", f"""
select p.flight_id, k, k + sum(p.value * ((length(p.term) % 7 - 3) / 10.0::double + k / 100.0::double)) as pred
from design_long p, range({_N_FITS}) r(k) where p.split = 'validation' and p.term not in ('1', 'dep_delay_min')
group by p.flight_id, k""", ("design_long",))


@query("mae_by_fit", compose("""
select cast(k as integer) as fit, round(avg(abs(pred - dep_delay_min)), 6) as mae
from rule_scores join rf using (flight_id) where rf.split = 'validation' group by k""", "rule_scores", "rf"))
def _mae_by_fit(c: Ctx) -> DataFrame:
    """The one-pass scoring of a path: mean absolute error of every fit over the validation rows."""
    aligned, levels, _ = mdl.prepare_ridge(_split(c))
    terms = mdl.ridge_terms(levels)
    fits = [(float(k), np.array([_rule(t, k) for t in terms])) for k in range(_N_FITS)]
    maes = mdl.mae_by_penalty(aligned.where(F.col("split") == "validation"), mdl.ridge_design_of(levels), fits)
    return c.spark.createDataFrame([(k, m) for k, m in enumerate(maes)], "fit int, mae double").withColumn("mae", r6(F.col("mae")))


@query("ridge_optimality", compose("""
select cast(k as integer) as fit, term, cast(0 as double) as slope
from (select distinct term from design_long where split = 'train' and value <> 0 and term not in ('1', 'dep_delay_min')) t,
  (values (0), (50), (99)) v(k)""", "design_long"))
def _ridge_optimality(c: Ctx) -> DataFrame:
    """Fits of the ridge path from the moments, tried on the train rows: at a fit the penalised
    error's slope along every scaled column is zero. The rows' errors come from the scoring
    code, the slopes from the long form of the design."""
    aligned, levels, _ = mdl.prepare_ridge(_split(c))
    aligned, design = written(aligned, "ridge-design"), mdl.ridge_design_of(levels)
    path = mdl.RidgePath(mdl.design_moments(aligned, design)["train"])
    lambdas, terms = path.lambdas(), mdl.ridge_terms(levels)
    train = aligned.where(F.col("split") == "train")
    entries = mdl.design_entries(train, levels, ["flight_id"])
    out = None
    for k in (0, 50, 99):
        fit = path.fit(lambdas[k])
        error = mdl.linear_predict(train.select("flight_id", mdl.TARGET, *design.columns), design, fit, "_pred").select(
            "flight_id", (F.col(mdl.TARGET) - F.col("_pred")).alias("_e"))
        scale = [(terms[j], float(sd), float(lambdas[k] / path.y_sd * fit[1][j] * sd / path.y_sd)) for j, sd in zip(path.live.tolist(), path.sd)]
        columns = broadcast_if_bounded(c.spark.createDataFrame(scale, "term string, sd double, pull double"))
        slope = F.col("s") / F.lit(path.n * path.y_sd) / F.col("sd") - F.col("pull")
        part = (entries.join(error, "flight_id").groupBy("term").agg(F.sum(F.col("value") * F.col("_e")).alias("s"))
                .join(columns, "term").select(F.lit(k).alias("fit"), "term", r6(slope).alias("slope")))
        out = part if out is None else out.unionByName(part)
    return out


_recipe_cols = ", ".join(
    [f"case when {c} in (select {c} from recipe where split = 'train') then {c} else 'other' end as {c}" for c in mdl.EN_NOMINAL]
    + [f"cast(coalesce({c}, (select quantile_cont({c}, 0.5) from recipe where split = 'train')) as double) as {c}" for c in mdl.EN_NUMERIC])
_knots = ", ".join(f"(select quantile_cont(dep_hour_local, {k / 5}) from recipe where split = 'train') as knot_{k}" for k in range(1, 5))


@query("recipe_columns", compose(f"select flight_id, split, dep_hour_local, {_recipe_cols}, {_knots} from recipe", "recipe"))
def _recipe(c: Ctx) -> DataFrame:
    """The elastic net's recipe per row: levels (unseen ones ``other``, NULL ``unknown``), imputed
    numerics, and the interior knots of the hour's spline."""
    train, test = _m1_parts(c)
    both, design, _ = mdl.recipe_frame(train, test, keep=["flight_id"])
    knots = exact_quantiles(both.where(F.col("split") == "train").withColumn("_g", F.lit(1)), ["_g"], "dep_hour_local",
                            [k / 5 for k in range(1, 5)], [f"knot_{k}" for k in range(1, 5)]).drop("_g")
    return both.select("flight_id", "split", "dep_hour_local", *mdl.EN_NOMINAL, *mdl.EN_NUMERIC,
                       *[knots.select(f"knot_{k}").scalar().alias(f"knot_{k}") for k in range(1, 5)])


_med_sql("tmed", "tf", pp.TREE_NUMERICS)
_aligned_sql("ta", "tf", "lv_missing", "tmed", pp.TREE_FACTORS, pp.TREE_NUMERICS, True)
_tree_cols = ", ".join(
    [f"cast((select idx from lv_missing l where l.feature = '{c}' and l.level = ta.{c}) as double) "
     f"as {c}_idx" for c in pp.TREE_FACTORS]
    + [f"round({c}, 6) as {c}" for c in pp.TREE_NUMERICS])


@query("tree_design", compose(f"select flight_id, split, {_tree_cols} from ta", "ta"))
def _tree_design(c: Ctx) -> DataFrame:
    """Tree inputs per row: level index of every factor (sorted levels with
    ``missing`` and ``other``) and the train-median-imputed numerics."""
    x = mdl.prepare_tree(_split(c))[0]
    return x.select("flight_id", "split",
                    *[F.col(f"{f}__i").alias(f"{f}_idx") for f in pp.TREE_FACTORS],
                    *[r6(F.col(n)).alias(n) for n in pp.TREE_NUMERICS])
