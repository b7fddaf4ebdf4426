"""Station resolution, schedule parsing and the nearest-weather feature build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.core import Ctx, query
from tarmac.plans.oracle import compose, cte
from tarmac.functions import flags as fl
from tarmac.functions import timeparts as tp
from tarmac.operators import features as feat
from tarmac.operators import stations as st


# ====================================================================== stations
query("distinct_origins", compose("select iata from origins", "origins"))(
    lambda c: st.distinct_origins(c.flights))
query("sentinel_filter", compose("select iata, icao, tz from airports_ok", "airports_ok"))(
    lambda c: st.sentinel_filter(c.airports))
query("airports_in_month", compose("select iata, icao, tz from airports_in_month",
                                   "airports_in_month"))(
    lambda c: st.airports_in_month(c.airports, c.flights))
query("airport_xwalk", compose("select iata, icao, meteostat_id from xwalk", "xwalk"))(
    lambda c: c.xwalk)
query("station_map", compose("select iata, icao, tz, station_id from station_map",
                             "station_map"))(lambda c: c.smap)

# ====================================================================== flights
query("operated_flights", compose("""
select * from fx_flights
where crs_dep_time is not null and (cancelled is null or cancelled = 0)""", "fx_flights"))(
    lambda c: feat.operated_flights(c.flights))


@query("hhmm_to_ts", compose("""
select flight_id, crs_dep_time,
  cast(floor(cast(trim(crs_dep_time) as bigint) / 100) as bigint) * 60
    + cast(trim(crs_dep_time) as bigint) % 100 as dep_minutes,
  flight_date + to_minutes(cast(floor(cast(trim(crs_dep_time) as bigint) / 100) as bigint) * 60
    + cast(trim(crs_dep_time) as bigint) % 100) as sched_local
from fx_flights""", "fx_flights"))
def _hhmm(c: Ctx) -> DataFrame:
    """HHMM text -> minutes and local wall-clock schedule (2400 -> next day)."""
    return c.flights.select(
        "flight_id", "crs_dep_time",
        tp.hhmm_minutes(F.col("crs_dep_time")).cast("bigint").alias("dep_minutes"),
        tp.local_schedule(F.col("flight_date"), F.col("crs_dep_time")).alias("sched_local"))


query("sched_dep_utc", compose(
    "select flight_id, origin, station_id, tz, sched_dep_tstz from departures", "departures"))(
    lambda c: c.f.select("flight_id", "origin", "station_id", "tz",
                         tp.to_ntz(F.col("sched_dep_tstz")).alias("sched_dep_tstz")))

query("flights_to_station", compose(
    "select flight_id, carrier, origin, dest, station_id, dep_delay_min from departures", "departures"))(
    lambda c: c.f.select("flight_id", "carrier", "origin", "dest", "station_id", "dep_delay_min"))


@query("crs_dep_hour", compose("""
select flight_id,
  date_trunc('hour', try_strptime(strftime(flight_date, '%Y-%m-%d') || ' '
    || lpad(trim(crs_dep_time), 4, '0'), '%Y-%m-%d %H%M')) as crs_dep_hour
from fx_flights""", "fx_flights"))
def _crs_hour(c: Ctx) -> DataFrame:
    return c.flights.select("flight_id", tp.crs_dep_hour(F.col("flight_date"),
                                                         F.col("crs_dep_time")).alias("crs_dep_hour"))


query("calendar_features", compose(
    "select flight_id, sched_dep_tstz, dep_hr_bin, dep_hour_local, dow from clocked", "clocked"))(
    lambda c: c.fxc.select("flight_id", tp.to_ntz(F.col("sched_dep_tstz")).alias("sched_dep_tstz"),
                           tp.to_ntz(F.col("dep_hr_bin")).alias("dep_hr_bin"),
                           "dep_hour_local", "dow"))


@query("late_flag", compose("""
select flight_id, dep_delay, (dep_delay >= 15) as late_15,
  case when dep_delay < 0 then cast(0 as double) else dep_delay end as delay_pos
from fx_flights""", "fx_flights"))
def _late(c: Ctx) -> DataFrame:
    d = F.col("dep_delay")
    return c.flights.select("flight_id", "dep_delay", fl.late_flag(d).alias("late_15"),
                            fl.positive_part(d).alias("delay_pos"))


query("flight_dedup", compose("""
select pick.id as flight_id, carrier, origin, dest, sched_dep_tstz, pick.delay as dep_delay_min
from single""", "single"))(
    lambda c: feat.flight_dedup(c.f).select(
        "flight_id", "carrier", "origin", "dest",
        tp.to_ntz(F.col("sched_dep_tstz")).alias("sched_dep_tstz"), "dep_delay_min"))

# ====================================================================== features
query("features_left", compose("select * from features_left", "features_left"))(
    lambda c: c.features("left"))
query("features_inner", compose("select * from features_inner", "features_inner"))(
    lambda c: c.features("inner"))
query("features_left_ids", compose("select * exclude (year, month) from features_left_ids", "features_left_ids"))(
    lambda c: c.features("left", keep_ids=True))

query("features_bucketed", compose("select * from features_left", "features_left"))(
    lambda c: feat.join_bucketed(*feat.bucketed_sides(c.flights, c.smap, c.weather, 8)))

# airport hours with their flights, times the airport's stations, times the readings of that hour
cte("airport_hours", """
select origin, case when hhmm // 100 < 24 and hhmm % 100 < 60 then flight_date + to_hours(cast(hhmm // 100 as bigint)) end as hour,
  count(*) as departures
from (select origin, flight_date, cast(trim(crs_dep_time) as bigint) as hhmm from fx_flights) t group by all""", ("fx_flights",))
cte("airport_stations", "select iata, meteostat_id, count(*) as listed from xwalk group by all", ("xwalk",))
cte("station_hours", "select station_id, time, count(*) as seen, count(temp) as warm from fx_weather group by all", ("fx_weather",))

query("weather_coverage", compose("""
select cast(sum(departures * coalesce(listed, 1) * coalesce(seen, 1)) as bigint) as total_flights,
  cast(coalesce(sum(departures * listed * warm), 0) as bigint) as with_weather
from airport_hours h
left join airport_stations on iata = origin
left join station_hours on station_id = meteostat_id and time = hour""", "airport_hours", "airport_stations", "station_hours"))(
    lambda c: feat.weather_coverage(c.flights, c.xwalk, c.weather))

query("weather_coverage_once", compose("""
select count(distinct flight_id) as total_flights, count(distinct flight_id) filter (covered) as with_weather
from (select f.flight_id, exists (
        select 1 from airport_stations s, station_hours r
        where s.iata = f.origin and r.station_id = s.meteostat_id and r.warm > 0 and r.time = case
          when cast(trim(f.crs_dep_time) as bigint) // 100 < 24
          then f.flight_date + to_hours(cast(cast(trim(f.crs_dep_time) as bigint) // 100 as bigint)) end) as covered
      from fx_flights f) t""", "fx_flights", "airport_stations", "station_hours"))(
    lambda c: feat.weather_coverage(c.flights, c.xwalk, c.weather, dedupe=True))

query("feature_count", compose("select count(*) as n from features_inner", "features_inner"))(
    lambda c: c.features("inner").agg(F.count(F.lit(1)).alias("n")))
