"""Exploratory aggregates over the feature-shaped history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.core import Ctx, query
from tarmac.plans import queries_features  # noqa: F401  (registers the SQL steps used here)
from tarmac.plans.oracle import compose, cte
from tarmac.operators import eda, profiles
from tarmac.session import written


# ====================================================================== EDA
# Fixture-scale parameters (the published run used 2022-01..2023-03 and n >= 5000).
EDA_START, EDA_END = "1995-01-01", "2001-08-01"
MIN_ORIGIN_FLIGHTS = 100


_EDA = f"select * from fx_history where sched_dep_tstz >= timestamp '{EDA_START}' " \
       f"and sched_dep_tstz < timestamp '{EDA_END}'"
_POS = "case when dep_delay_min < 0 then cast(0 as double) else dep_delay_min end"


def _cut_sql(col: str, lo: int, hi: int, w: int, include_lowest: bool) -> str:
    n = (hi - lo) // w
    k = f"ceil(({col} - ({lo})) / {w})"
    if include_lowest:
        k = f"(case when {col} = {lo} then 1 else {k} end)"
    first = "'['" if include_lowest else "'('"
    return (f"case when {k} between 1 and {n} then concat("
            f"case when {k} = 1 then {first} else '(' end, "
            f"cast(cast({lo} + ({k} - 1) * {w} as bigint) as varchar), ',', "
            f"cast(cast({lo} + {k} * {w} as bigint) as varchar), ']') end")


def _ctx_eda(c: Ctx) -> DataFrame:
    return eda.eda_window(c.history, EDA_START, EDA_END)


cte("ds_eda", _EDA, ("fx_history",))


cte("hist_counts", """
select cast(ceil((dep_delay_min - 2.5) / 5) * 5 as double) as bin_center, count(*) as n
from ds_eda where dep_delay_min >= -60 and dep_delay_min <= 360 group by 1""", ("ds_eda",))


def _eda_sql(body: str, *more: str) -> str:
    return compose(body, "ds_eda", "hist_counts") if "hist_counts" in body else compose(body, "ds_eda")


query("monthly_counts", compose("""
select cast(year(sched_dep_tstz) as integer) as year, cast(month(sched_dep_tstz) as integer) as month,
  count(*) as n from fx_history group by 1, 2 order by 1, 2""", "fx_history"))(
    lambda c: eda.monthly_counts(c.history))

query("missing_by_month", _eda_sql(
    "select cast(year(sched_dep_tstz) as integer) as year, cast(month(sched_dep_tstz) as integer) as month, "
    + ", ".join(f"round(avg(cast({col} is null as double)) * 100, 6) as {name}"
                for col, name in eda.MISSING_PROFILE)
    + " from ds_eda group by 1, 2 order by 1, 2"))(lambda c: eda.missing_by_month(_ctx_eda(c)))

query("missing_overall", _eda_sql(
    "select " + ", ".join(f"round(avg(cast({col} is null as double)) * 100, 6) as {col}"
                          for col in eda.UNUSED_WEATHER) + " from ds_eda"))(
    lambda c: eda.missing_overall(_ctx_eda(c)))

query("tail_stats", _eda_sql("""
select count(*) as n,
  round(avg(cast(dep_delay_min > 60 as double)) * 100, 6) as pct_gt_60,
  round(avg(cast(dep_delay_min > 120 as double)) * 100, 6) as pct_gt_120,
  round(avg(cast(dep_delay_min > 240 as double)) * 100, 6) as pct_gt_240
from ds_eda"""))(lambda c: eda.tail_stats(_ctx_eda(c)))

query("seasonality", _eda_sql(f"""
select dep_hour_local, dow, round(avg({_POS}), 6) as mean_pos_delay, count(*) as n
from ds_eda group by 1, 2"""))(lambda c: eda.seasonality(_ctx_eda(c)))

cte("origin_means", f"""
select origin, count(*) as n, avg({_POS}) as exact, round(avg({_POS}), 6) as mean_pos_delay,
  round(avg(cast(late_15 as double)) * 100, 6) as late_15_pct,
  row_number() over (order by avg({_POS}) desc nulls last, origin) as place
from ds_eda group by origin having count(*) >= {MIN_ORIGIN_FLIGHTS}""", ("ds_eda",))

query("top_origins", compose("select * exclude (exact, place) from origin_means where place <= 20", "origin_means"))(
    lambda c: eda.top_origins(_ctx_eda(c), MIN_ORIGIN_FLIGHTS, 20))

query("airport_summary", compose("select * exclude (exact, place), place <= 15 as top_label from origin_means", "origin_means"))(
    lambda c: eda.airport_summary_labeled(_ctx_eda(c), MIN_ORIGIN_FLIGHTS, 15))


def _bin_sql(col, lo, hi, w, inc, mean):
    m = f"round(avg({_POS}), 6) as mean_pos_delay, " if mean else ""
    return _eda_sql(f"select {_cut_sql(col, lo, hi, w, inc)} as {col}_bin, {m}count(*) as n "
                    f"from ds_eda group by 1")


query("delay_by_temp", _bin_sql("temp", -50, 50, 5, False, True))(
    lambda c: eda.delay_by_temp(_ctx_eda(c)))
query("delay_by_wind", _bin_sql("wspd", 0, 240, 10, True, True))(
    lambda c: eda.delay_by_wind(_ctx_eda(c)))
query("wind_bin_counts", _bin_sql("wspd", 0, 240, 10, True, False))(
    lambda c: eda.wind_bin_counts(_ctx_eda(c)))
query("delay_by_precip", _bin_sql("prcp", 0, 105, 5, True, True))(
    lambda c: eda.delay_by_precip(_ctx_eda(c)))
query("precip_bin_counts", _bin_sql("prcp", 0, 105, 5, True, False))(
    lambda c: eda.precip_bin_counts(_ctx_eda(c)))

query("delay_by_rain", _eda_sql(f"""
select case when prcp > 0 then 'Rain' when prcp is not null then 'No rain' end as rain,
  round(avg({_POS}), 6) as mean_pos_delay, count(*) as n
from ds_eda group by 1"""))(lambda c: eda.delay_by_rain(_ctx_eda(c)))

query("delay_histogram", _eda_sql("""
select g.bin_center, coalesce(c.n, 0) as n,
  case when c.n > 0 then round(log10(c.n), 6) end as log10_n
from (select cast(unnest(generate_series(cast(min(bin_center) as bigint),
                                         cast(max(bin_center) as bigint), 5)) as double) as bin_center
      from hist_counts) g
left join hist_counts c on c.bin_center = g.bin_center""", ))(
    lambda c: eda.delay_histogram(_ctx_eda(c)))

query("origin_sanity", compose("""
select origin, count(*) as n_rows, round(avg(dep_delay_min), 6) as avg_delay,
  round(avg(temp), 6) as avg_temp, round(avg(prcp), 6) as avg_prcp
from features_inner group by 1 order by 2 desc, 1 limit 10""", "features_inner"))(
    lambda c: eda.origin_sanity(c.features("inner")))

query("earliest_rows", compose("""
select sched_dep_tstz, origin, carrier, dep_delay_min, temp, prcp, wspd
from features_inner order by sched_dep_tstz nulls first, carrier nulls first,
  origin nulls first, dest nulls first limit 5""", "features_inner"))(
    lambda c: eda.earliest_rows(c.features("inner")))

query("features_seasonality", compose(f"""
select dep_hour_local, dow, round(avg({_POS}), 6) as mean_pos_delay, count(*) as n
from features_left group by 1, 2""", "features_left"))(
    lambda c: eda.seasonality(c.features("left")))


# every report as (report, key, measure, value) rows, straight from the rows of the window
_REPORTS = {
    "seasonality": ("concat_ws('|', dep_hour_local, dow)", ["mean_pos_delay", "n"], "group by dep_hour_local, dow"),
    "tail_stats": ("''", ["n", *[f"pct_gt_{t}" for t in profiles.TAILS]], ""),
    "delay_by_rain": ("case when prcp > 0 then 'Rain' when prcp is not null then 'No rain' else '' end", ["mean_pos_delay", "n"], "group by 2"),
    **{f"delay_by_{name}": (f"coalesce({_cut_sql(col, lo, hi, w, inc)}, '')", ["mean_pos_delay", "n"], "group by 2")
       for name, col, lo, hi, w, inc in (("temp", "temp", -50, 50, 5, False), ("wind", "wspd", 0, 240, 10, True), ("precip", "prcp", 0, 105, 5, True))},
    "missing_by_month": ("concat_ws('|', year(sched_dep_tstz), month(sched_dep_tstz))", [n for _, n in eda.MISSING_PROFILE],
                         "group by year(sched_dep_tstz), month(sched_dep_tstz)"),
    "airport_summary": ("origin", ["n", "mean_pos_delay", "late_15_pct"], f"group by origin having count(*) >= {MIN_ORIGIN_FLIGHTS}"),
}
_MEASURE_SQL = {
    "n": "count(*)", "mean_pos_delay": f"avg({_POS})", "late_15_pct": "100 * count_if(late_15) / nullif(count(late_15), 0)",
    **{f"pct_gt_{t}": f"100 * count_if(dep_delay_min > {t}) / nullif(count(dep_delay_min), 0)" for t in profiles.TAILS},
    **{name: f"100 * count_if({col} is null) / count(*)" for col, name in eda.MISSING_PROFILE}}
_long = " union all ".join(
    f"select '{report}' as report, {key} as key, unnest([{', '.join(repr(m) for m in measures)}]) as measure, "
    f"unnest([{', '.join(f'cast({_MEASURE_SQL[m]} as double)' for m in measures)}]) as value from ds_eda {tail}"
    for report, (key, measures, tail) in _REPORTS.items())


@query("eda_from_month_states", compose(f"select report, key, measure, round(value, 6) as value from ({_long}) l where value is not null",
                                        "ds_eda"))
def _eda_states(c: Ctx) -> DataFrame:
    """Reports from month states: one read of the rows gives states per month, the states
    add up to the reports."""
    states = written(profiles.month_states(c.history), "states")
    tables = profiles.reports(profiles.merged(states), EDA_START, EDA_END, MIN_ORIGIN_FLIGHTS)
    keys = {"seasonality": ["dep_hour_local", "dow"], "missing_by_month": ["year", "month"], "airport_summary": ["origin"], "tail_stats": [],
            "delay_by_rain": ["rain"], "delay_by_temp": ["temp_bin"], "delay_by_wind": ["wspd_bin"], "delay_by_precip": ["prcp_bin"]}
    out = None
    for report, (_, measures, _) in _REPORTS.items():
        pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])).alias("p")
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys[report]]) if keys[report] else F.lit("")
        part = tables[report].select(F.lit(report).alias("report"), key.alias("key"), pairs).select("report", "key", "p.*")
        out = part if out is None else out.unionByName(part)
    return out.where("value is not null").withColumn("value", F.round("value", 6) + F.lit(0.0))
