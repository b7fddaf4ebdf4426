"""Flight-weather feature build.

The nearest-observation join (each departure gets the weather row of its
station closest to the departure hour, within +/-30 minutes) is planned as an
equi-join: the distance ranking depends only on (station, hour bin), so the
weather side is first reduced to one row per (station, bin) and then joined on
equality. No range predicate, no flight x observation pairs.

Ties: equal distance -> earlier observation; flights sharing
(carrier, origin, dest, schedule) collapse to one row -> non-NULL delay first,
smaller delay, smaller flight id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.flags import is_present, late_flag
from tarmac.functions.timeparts import (
    crs_dep_hour, dow_sunday0, gap_seconds, hour_bin, hour_of, sched_dep_utc, to_ntz,
)
from tarmac.operators.sizing import broadcast_if_bounded
from tarmac.session import scratch_path

# Weather measures of an hourly observation, in output order.
MEASURES = ["dwpt", "rhum", "prcp", "snow", "wdir", "wspd", "wpgt", "pres", "tsun", "temp"]
FLIGHT_KEY = ["carrier", "origin", "dest", "sched_dep_tstz"]
FEATURE_COLUMNS = (["carrier", "origin", "dest", "sched_dep_tstz", "dep_hour_local", "dow"]
                   + MEASURES + ["coco", "dep_delay_min", "late_15"])


def pad_measures(weather: DataFrame) -> DataFrame:
    """Add absent measure columns as NULL doubles (and ``coco`` as NULL int)."""
    cols = set(weather.columns)
    for m in MEASURES:
        if m not in cols:
            weather = weather.withColumn(m, F.lit(None).cast("double"))
    if "coco" not in cols:
        weather = weather.withColumn("coco", F.lit(None).cast("int"))
    return weather


def operated_flights(flights: DataFrame) -> DataFrame:
    """Scheduled time present and not cancelled (NULL cancelled counts as flown)."""
    return flights.where(F.col("crs_dep_time").isNotNull()
                         & (F.col("cancelled").isNull() | (F.col("cancelled") == 0)))


def flights_to_station(flights: DataFrame, smap: DataFrame) -> DataFrame:
    """Operated flights joined to their origin's station; schedule as UTC instant."""
    m = broadcast_if_bounded(smap.where(is_present(F.col("tz")))
                             .select("iata", "tz", "station_id"), materialize=True)
    f = operated_flights(flights)
    return (f.join(m, f.origin == m.iata, "inner")
            .select(F.year("flight_date").alias("year"), F.month("flight_date").alias("month"), "flight_id", "carrier", "origin", "dest", "station_id", "tz",
                    sched_dep_utc(F.col("flight_date"), F.col("crs_dep_time"), F.col("tz"))
                    .alias("sched_dep_tstz"),
                    F.col("dep_delay").cast("double").alias("dep_delay_min")))


def calendar_features(f: DataFrame, hour_basis: str = "session") -> DataFrame:
    """Hour bin, hour and day of week (0 = Sunday) of ``sched_dep_tstz``.

    ``hour_basis="session"`` takes the parts in the session zone (UTC);
    ``"airport"`` takes them on the airport's wall clock (needs ``tz``).
    """
    ts = F.col("sched_dep_tstz")
    local = ts if hour_basis == "session" else F.from_utc_timestamp(ts, F.col("tz"))
    return (f.withColumn("dep_hr_bin", hour_bin(ts))
            .withColumn("dep_hour_local", hour_of(local))
            .withColumn("dow", dow_sunday0(local)))


def flight_dedup(f: DataFrame) -> DataFrame:
    """One row per (carrier, origin, dest, sched_dep_tstz)."""
    w = Window.partitionBy(*FLIGHT_KEY).orderBy(
        F.col("dep_delay_min").isNull(), F.col("dep_delay_min"), F.col("flight_id"))
    return f.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _candidate_bins(t: Column, radius_minutes: int) -> Column:
    """Whole-hour bins b with |t - b| <= radius."""
    r = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(radius_minutes))
    top = F.date_trunc("hour", t + r)
    n = 2 * radius_minutes // 60 + 1
    cands = F.array(*[top - F.make_dt_interval(F.lit(0), F.lit(i)) for i in range(n)])
    return F.filter(cands, lambda b: b >= t - r)


def nearest_weather(weather: DataFrame, radius_minutes: int = 30) -> DataFrame:
    """One observation per (station_id, bin): the closest to the bin, the
    earlier one on equal distance. Columns: station_id, bin, wx_ts, measures."""
    w = pad_measures(weather).where(F.col("time").isNotNull() & F.col("station_id").isNotNull())
    t = F.col("time").cast("timestamp")
    exploded = w.select("station_id", t.alias("wx_ts"), *MEASURES, "coco",
                        F.explode(_candidate_bins(t, radius_minutes)).alias("bin"))
    ranked = exploded.withColumn("_gap", gap_seconds(F.col("wx_ts"), F.col("bin")))
    win = Window.partitionBy("station_id", "bin").orderBy("_gap", "wx_ts")
    return (ranked.withColumn("_rn", F.row_number().over(win)).where("_rn = 1")
            .drop("_rn", "_gap"))


def attach_weather(fx: DataFrame, weather: DataFrame, how: str = "left",
                   radius_minutes: int = 30) -> DataFrame:
    """Equi-join deduplicated flights to the reduced weather on (station, bin)."""
    wx = nearest_weather(weather, radius_minutes).withColumnRenamed("station_id", "wx_station")
    cond = (fx.station_id == wx.wx_station) & (fx.dep_hr_bin == wx.bin)
    return fx.join(wx, cond, how)


def build_features(flights: DataFrame, smap: DataFrame, weather: DataFrame,
                   how: str = "left", hour_basis: str = "session",
                   radius_minutes: int = 30, keep_ids: bool = False, keep_month: bool = False) -> DataFrame:
    """Feature rows in the published column order. ``how="left"`` keeps flights
    without weather (NULL measures), ``how="inner"`` drops them.

    Flights are deduplicated first (map-side top-1), then joined; AQE may split a
    hot (station, hour). ``keep_month`` adds year and month of the flight's date."""
    fx = calendar_features(flights_to_station(flights, smap), hour_basis)
    j = attach_weather(flight_dedup(fx), weather, how, radius_minutes)
    out = (j.withColumn("late_15", late_flag(F.col("dep_delay_min")))
           .withColumn("sched_dep_tstz", to_ntz(F.col("sched_dep_tstz"))))
    cols = FEATURE_COLUMNS + (["flight_id", "station_id", "wx_ts"] if keep_ids else []) + (
        ["year", "month"] if keep_month else [])
    if keep_ids:
        out = out.withColumn("wx_ts", to_ntz(F.col("wx_ts")))
    return out.select(*cols)


def bucketed(df: DataFrame, cols: list[str], buckets: int, name: str) -> DataFrame:
    """``df`` as a table in ``buckets`` buckets by ``cols``, sorted inside, in the shared scratch
    folder: one shuffle when it is written, none in later joins on those columns."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *cols).write.format("parquet").bucketBy(buckets, *cols).sortBy(*cols)
     .option("path", scratch_path(spark, table)).saveAsTable(table))
    return spark.table(table)


def bucketed_sides(flights: DataFrame, smap: DataFrame, weather: DataFrame, buckets: int, hour_basis: str = "session",
                   radius_minutes: int = 30) -> tuple[DataFrame, DataFrame]:
    """Deduplicated departures and reduced weather, bucketed alike by (station, hour bin). The
    weather side serves every later build of the same months."""
    fx = flight_dedup(calendar_features(flights_to_station(flights, smap), hour_basis))
    wx = nearest_weather(weather, radius_minutes).withColumnRenamed("station_id", "wx_station")
    return (bucketed(fx, ["station_id", "dep_hr_bin"], buckets, "departures"), bucketed(wx, ["wx_station", "bin"], buckets, "hourly_weather"))


def join_bucketed(fx: DataFrame, wx: DataFrame, how: str = "left") -> DataFrame:
    """Feature rows from two bucketed sides: a merge join of equal buckets, no exchange."""
    j = fx.join(wx.hint("merge"), (fx.station_id == wx.wx_station) & (fx.dep_hr_bin == wx.bin), how)
    return (j.withColumn("late_15", late_flag(F.col("dep_delay_min")))
            .withColumn("sched_dep_tstz", to_ntz(F.col("sched_dep_tstz"))).select(*FEATURE_COLUMNS))


def weather_coverage(flights: DataFrame, xwalk: DataFrame, weather: DataFrame,
                     dedupe: bool = False) -> DataFrame:
    """Flights (all, cancelled too) against every crosswalk station of the origin and that
    station's observation at the exact scheduled hour (local schedule read as UTC).
    Counts combinations, so an airport with several stations counts its flights several
    times; ``dedupe=True`` counts each flight (by ``flight_id``) once, with weather when
    any station has it.

    Both sides are counted before they meet: flights per (origin, hour), readings per
    (station, hour), stations per airport. The counts are multiplied after the joins, so
    the rows that are joined are airport hours, however many flights an hour has."""
    hour = crs_dep_hour(F.col("flight_date"), F.col("crs_dep_time")).alias("hour")
    stations = broadcast_if_bounded(xwalk.groupBy(F.col("iata").alias("origin"), "meteostat_id")
                                    .agg(F.count(F.lit(1)).alias("times")), materialize=True)
    readings = (pad_measures(weather).groupBy(F.col("station_id").alias("meteostat_id"), to_ntz(F.col("time")).alias("hour"))
                .agg(F.count(F.lit(1)).alias("readings"), F.count("temp").alias("known")))

    def met(slots: DataFrame) -> DataFrame:
        return slots.join(stations, "origin", "left").join(readings, ["meteostat_id", "hour"], "left")

    if dedupe:
        rows = flights.select("flight_id", "origin", hour).distinct()
        has = met(rows.select("origin", "hour").distinct()).where("known > 0").select("origin", "hour").distinct()
        per_flight = (rows.join(has.withColumn("_has", F.lit(True)), ["origin", "hour"], "left")
                      .groupBy("flight_id").agg(F.max("_has").alias("_has")))
        return per_flight.agg(F.count(F.lit(1)).alias("total_flights"), F.count("_has").alias("with_weather"))
    per_hour = met(flights.select("origin", hour).groupBy("origin", "hour").agg(F.count(F.lit(1)).alias("n")))
    pairs = F.col("n") * F.coalesce("times", F.lit(1))
    total = F.sum(pairs * F.coalesce("readings", F.lit(1)))
    return per_hour.agg(F.coalesce(total, F.lit(0)).alias("total_flights"),
                        F.coalesce(F.sum(pairs * F.coalesce("known", F.lit(0))), F.lit(0)).alias("with_weather"))
