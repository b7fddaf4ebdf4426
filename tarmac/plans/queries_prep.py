"""Feature preparation: flags, wind components, level alignment, train medians."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.core import Ctx, query, r6
from tarmac.plans import queries_baselines  # noqa: F401  (registers the SQL steps used here)
from tarmac.plans.oracle import compose, cte
from tarmac.functions import flags as fl
from tarmac.operators import prep as pp
from tarmac.plans.queries_baselines import _split


# ====================================================================== prep

_SIN = "sin(wdir * pi() / 180)"
_COS = "cos(wdir * pi() / 180)"

query("precip_flag", compose("""
select flight_id,
  case when prcp is null then 'missing' when prcp > 0 then 'yes' else 'no' end as has_prcp,
  case when prcp is null then null else cast(prcp > 0 as double) end as has_prcp_num
from fx_history""", "fx_history"))(
    lambda c: c.history.select("flight_id", fl.precip_flag(F.col("prcp")).alias("has_prcp"),
                               fl.precip_indicator(F.col("prcp")).alias("has_prcp_num")))

query("wind_components", compose(f"""
select flight_id, round({_SIN}, 6) as wdir_sin, round({_COS}, 6) as wdir_cos from fx_history""",
                                 "fx_history"))(
    lambda c: c.history.select("flight_id", r6(fl.wind_sin(F.col("wdir"))).alias("wdir_sin"),
                               r6(fl.wind_cos(F.col("wdir"))).alias("wdir_cos")))

cte("rf", f"""
select flight_id, split, dep_delay_min, carrier, origin, dest,
  cast(dep_hour_local as varchar) as dep_hour_local, cast(dow as varchar) as dow,
  cast(month as varchar) as month, coalesce(cast(coco as varchar), 'missing') as coco,
  temp, wspd, rhum, pres, prcp,
  case when prcp is null then null else cast(prcp > 0 as double) end as has_prcp,
  {_SIN} as wdir_sin, {_COS} as wdir_cos
from sp""", ("sp",))


def _ridge(c: Ctx) -> DataFrame:
    return pp.ridge_features(_split(c))


query("ridge_features", compose("""
select flight_id, split, dep_delay_min, carrier, origin, dest, dep_hour_local, dow, month, coco,
  temp, wspd, rhum, pres, prcp, has_prcp, round(wdir_sin, 6) as wdir_sin,
  round(wdir_cos, 6) as wdir_cos from rf""", "rf"))(
    lambda c: _ridge(c).withColumn("wdir_sin", r6(F.col("wdir_sin")))
    .withColumn("wdir_cos", r6(F.col("wdir_cos"))))

_lv_other = " union all ".join(
    f"select '{col}' as feature, {col} as level from rf where split = 'train' and {col} is not null"
    for col in pp.RIDGE_FACTORS)
cte("lv_other", f"""
select feature, level, cast(row_number() over (partition by feature order by level) - 1 as bigint) as idx
from (select distinct feature, level from ({_lv_other}) u) d
union all
select feature, count(distinct level) as idx, 'other' as level
from ({_lv_other}) u2 group by feature""".replace(
    "select feature, count(distinct level) as idx, 'other' as level",
    "select feature, 'other' as level, count(distinct level) as idx"), ("rf",))

query("category_levels", compose("select feature, level, idx from lv_other", "lv_other"))(
    lambda c: pp.category_levels(_ridge(c).where(F.col("split") == "train"), pp.RIDGE_FACTORS))


def _align_sql(src: str, lv: str, cols, missing: bool) -> str:
    parts = []
    for col in cols:
        v = f"(case when {col} is null or {col} = '' then 'missing' else {col} end)" if missing else col
        parts.append(f"case when {v} in (select level from {lv} where feature = '{col}') "
                     f"then {v} else 'other' end as {col}")
    return f"select flight_id, split, {', '.join(parts)} from {src}"


query("align_levels_other", compose(_align_sql("rf", "lv_other", pp.RIDGE_FACTORS, False),
                                    "rf", "lv_other"))(
    lambda c: pp.align_levels(
        _ridge(c), pp.category_levels(_ridge(c).where(F.col("split") == "train"), pp.RIDGE_FACTORS),
        pp.RIDGE_FACTORS).select("flight_id", "split", *pp.RIDGE_FACTORS))

cte("tf", f"""
select flight_id, split, dep_delay_min, carrier, origin, dest,
  cast(dep_hour_local as varchar) as dep_hour_local, cast(dow as varchar) as dow,
  cast(month as varchar) as month, cast(coco as varchar) as coco,
  case when prcp is null then 'missing' when prcp > 0 then 'yes' else 'no' end as has_prcp,
  temp, wspd, rhum, pres, prcp, {_SIN} as wdir_sin, {_COS} as wdir_cos
from sp""", ("sp",))
_lv_missing = " union all ".join(
    f"select '{col}' as feature, case when {col} is null or {col} = '' then 'missing' else {col} end "
    f"as level from tf where split = 'train' union all select '{col}', 'missing' union all "
    f"select '{col}', 'other'" for col in pp.TREE_FACTORS)
cte("lv_missing", f"""
select feature, level, cast(row_number() over (partition by feature order by level) - 1 as bigint) as idx
from (select distinct feature, level from ({_lv_missing}) u) d""", ("tf",))


def _tree(c: Ctx) -> DataFrame:
    return pp.tree_features(_split(c))


query("align_levels_missing", compose(_align_sql("tf", "lv_missing", pp.TREE_FACTORS, True),
                                      "tf", "lv_missing"))(
    lambda c: pp.align_levels(
        _tree(c), pp.category_levels(_tree(c).where(F.col("split") == "train"), pp.TREE_FACTORS,
                                     "missing"),
        pp.TREE_FACTORS, "missing").select("flight_id", "split", *pp.TREE_FACTORS))

query("median_impute", compose(" union all ".join(
    f"select '{col}' as feature, coalesce(round(quantile_cont({col}, 0.5), 6), 0) as median "
    f"from rf where split = 'train'" for col in pp.RIDGE_NUMERICS), "rf"))(
    lambda c: pp.train_medians(_ridge(c).where(F.col("split") == "train"), pp.RIDGE_NUMERICS)
    .withColumn("median", r6(F.col("median"))))
