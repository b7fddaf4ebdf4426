"""Month ranges and pending months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.core import Ctx, query
from tarmac.plans.oracle import compose
from tarmac.plans import fixtures as fx
from tarmac.sources import months as mo


# ====================================================================== months


@query("month_range", compose("""
select cast(year(m) as integer) as year, cast(month(m) as integer) as month
from (select unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                    date_trunc('month', max(o_orderdate)), interval 1 month)) as m
      from orders) t"""))
def _month_range(c: Ctx) -> DataFrame:
    """Every month spanned by the order dates, first to last, inclusive."""
    o = fx.table(c.spark, c.sf_dir, "orders").agg(F.min("o_orderdate").alias("a"),
                                                  F.max("o_orderdate").alias("b"))
    return mo.months_frame(o, F.col("a").cast("date"), F.col("b").cast("date"))


@query("pending_months", compose("""
select r.year, r.month from (
  select cast(year(m) as integer) as year, cast(month(m) as integer) as month
  from (select unnest(generate_series(date_trunc('month', min(ts) - interval 2 month),
                                      date_trunc('month', max(ts) + interval 1 month),
                                      interval 1 month)) as m from events) t) r
where not exists (select 1 from fx_flights f where year(f.flight_date) = r.year
                  and month(f.flight_date) = r.month)""", "fx_flights"))
def _pending(c: Ctx) -> DataFrame:
    """Months from two before the first event to one after the last that no
    departure partition covers yet."""
    e = fx.table(c.spark, c.sf_dir, "events").agg(
        F.add_months(F.min("ts").cast("date"), -2).alias("a"),
        F.add_months(F.max("ts").cast("date"), 1).alias("b"))
    requested = mo.months_frame(e, F.col("a"), F.col("b"))
    existing = c.flights.select(F.year("flight_date").alias("year"),
                                F.month("flight_date").alias("month"))
    return mo.pending_months(requested, existing)
