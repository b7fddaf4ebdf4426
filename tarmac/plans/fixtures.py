"""Views of the generated test tables in the shape of the delay data model.

The test tables hold no flights or weather, so each logical table is derived
from them (the same derivations exist as SQL in ``plans.oracle``):

* ``fx_airports``  from ``nation``: IATA ``Ann``, ICAO ``KAnn``, zone by region,
  with a ``\\N`` ICAO (24), a ``\\N`` zone (23) and an empty zone (22)
* ``fx_stations``  from ``supplier``: id = zero-padded key, ICAO in mixed case
* ``fx_flights``   every row of ``events`` as a departure (January 2024)
* ``fx_weather``   every row of ``events`` as a reading, aggregated hourly per station
* ``fx_history``   from ``orders`` x ``customer``: a feature table over 1995-2001

No table is filtered: each derived table uses all rows of its source. NULLs
and special values come from modulo rules on the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.flags import SENTINEL, late_flag
from tarmac.functions.timeparts import dow_sunday0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(prefix: str, n) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), 2, "0"))


def fx_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    tz = (F.when(k == 23, F.lit(SENTINEL)).when(k == 22, F.lit(""))
          .when(r == 0, "America/New_York").when(r == 1, "America/Chicago")
          .when(r == 2, "America/Denver").when(r == 3, "America/Los_Angeles")
          .otherwise("Pacific/Honolulu"))
    return n.select(_code("A", k).alias("iata"),
                    F.when(k == 24, F.lit(SENTINEL)).otherwise(_code("KA", k)).alias("icao"),
                    tz.alias("tz"))


def fx_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("id"),
        F.concat(F.when(F.col("s_suppkey") % 2 == 0, F.lit("KA")).otherwise(F.lit("ka")),
                 F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("icao"))


def fx_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    hhmm = (F.hour("ts") * 100 + F.minute("ts")).cast("string")
    crs = (F.when(eid % 1000 == 0, F.lit(None).cast("string"))
           .when(eid % 998 == 0, F.lit("2400"))
           .when(eid % 14 == 0, F.lpad(hhmm, 4, " "))
           .otherwise(F.lpad(hhmm, 4, "0")))
    return e.select(
        eid.alias("flight_id"),
        F.col("ts").cast("date").alias("flight_date"),
        crs.alias("crs_dep_time"),
        F.col("event_type").alias("carrier"),
        _code("A", F.col("user_id") % 25).alias("origin"),
        _code("A", (eid * 7) % 25).alias("dest"),
        F.when(eid % 202 == 0, F.lit(None).cast("double"))
         .otherwise((F.floor("value") - 20).cast("double")).alias("dep_delay"),
        F.when(eid % 50 == 0, F.lit(1.0)).when(eid % 52 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(0.0)).alias("cancelled"))


def fx_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly observations (time is a UTC instant). dwpt, snow, wpgt and tsun
    are absent, as in the real files, and get NULL-padded downstream."""
    e = table(spark, sf_dir, "events")
    m = (fx_stations(spark, sf_dir)
         .groupBy(F.substring("icao", 3, 2).alias("nk")).agg(F.min("id").alias("station_id")))
    j = e.join(m, m.nk == F.lpad((F.col("user_id") % 25).cast("string"), 2, "0"))
    lo, hi = F.min("value"), F.max("value")
    first, last = F.min("event_id"), F.max("event_id")
    return (j.groupBy("station_id", F.date_trunc("hour", F.col("ts")).alias("time"))
            .agg((F.floor(lo / 4) - 10).cast("double").alias("temp"),
                 F.floor(hi / 4).cast("double").alias("wspd"),
                 F.when(F.count(F.lit(1)) > 2, F.lit(None).cast("double"))
                  .otherwise((F.floor(lo) % 7).cast("double")).alias("prcp"),
                 (30 + last % 70).cast("double").alias("rhum"),
                 ((first * 37) % 360).cast("double").alias("wdir"),
                 (990 + first % 50).cast("double").alias("pres"),
                 (first % 27).cast("int").alias("coco")))


def fx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature-shaped history (one row per order) with flight_id."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    minutes = (5 + k % 19) * 60 + (k * 13) % 60
    sched = F.timestamp_add("MINUTE", minutes, F.col("o_orderdate"))
    null_d = F.lit(None).cast("double")
    delay = F.when(k % 101 == 0, null_d).otherwise(
        (F.floor(F.col("o_totalprice") / 2000.0) - 30).cast("double"))
    return j.select(
        k.alias("flight_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("carrier"),
        _code("A", F.col("c_nationkey")).alias("origin"),
        _code("A", (k * 7) % 25).alias("dest"),
        sched.alias("sched_dep_tstz"),
        (5 + k % 19).cast("bigint").alias("dep_hour_local"),
        dow_sunday0(sched).alias("dow"),
        null_d.alias("dwpt"),
        F.when(k % 7 == 0, null_d).otherwise((30 + (k * 11) % 70).cast("double")).alias("rhum"),
        F.when(k % 11 == 0, null_d).when(k % 3 == 0, ((k * 7) % 110).cast("double"))
         .otherwise(F.lit(0.0)).alias("prcp"),
        null_d.alias("snow"),
        F.when(k % 13 == 0, null_d).otherwise(((k * 37) % 360).cast("double")).alias("wdir"),
        F.when(k % 23 == 0, null_d).otherwise(((k * 3) % 250).cast("double")).alias("wspd"),
        null_d.alias("wpgt"),
        F.when(k % 29 == 0, null_d).otherwise((990 + (k * 17) % 50).cast("double")).alias("pres"),
        null_d.alias("tsun"),
        F.when(k % 17 == 0, null_d).otherwise(((k * 31) % 101 - 50).cast("double")).alias("temp"),
        F.when(k % 9 == 0, F.lit(None).cast("int")).otherwise((k % 27).cast("int")).alias("coco"),
        delay.alias("dep_delay_min"),
        late_flag(delay).alias("late_15"))
