"""Shared plumbing of the query registry: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
the matching DuckDB text ``ORACLE[name]``. Both sides alias every computed
column to the same name and round doubles to 6 digits."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import features as feat
from tarmac.operators import stations as st
from tarmac.plans import fixtures as fx
from tarmac.plans.oracle import canonical_rounding
from tarmac.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Ctx(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = canonical_rounding(sql)
        return run
    return deco


def r6(c) -> F.Column:
    """Round to 6 digits; ``+ 0.0`` keeps zero unsigned on every path."""
    return F.round(c, 6) + F.lit(0.0)


class Ctx:
    """Lazily built fixture frames and shared intermediate steps."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def flights(self) -> DataFrame:
        return fx.fx_flights(self.spark, self.sf_dir)

    @cached_property
    def airports(self) -> DataFrame:
        return fx.fx_airports(self.spark, self.sf_dir)

    @cached_property
    def stations(self) -> DataFrame:
        return fx.fx_stations(self.spark, self.sf_dir)

    @cached_property
    def weather(self) -> DataFrame:
        return fx.fx_weather(self.spark, self.sf_dir)

    @cached_property
    def history(self) -> DataFrame:
        return fx.fx_history(self.spark, self.sf_dir)

    @cached_property
    def smap(self) -> DataFrame:
        return st.station_map(st.airports_in_month(self.airports, self.flights), self.stations)

    @cached_property
    def xwalk(self) -> DataFrame:
        return st.airport_xwalk(self.airports, self.flights, self.stations)

    @cached_property
    def f(self) -> DataFrame:
        return feat.flights_to_station(self.flights, self.smap)

    @cached_property
    def fxc(self) -> DataFrame:
        return feat.calendar_features(self.f)

    def features(self, how: str = "left", keep_ids: bool = False, keep_month: bool = False) -> DataFrame:
        return feat.build_features(self.flights, self.smap, self.weather, how=how,
                                   keep_ids=keep_ids, keep_month=keep_month)
