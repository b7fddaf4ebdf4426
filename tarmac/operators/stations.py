"""Airport -> weather-station resolution.

* ``sentinel_filter``    airports with IATA, ICAO and zone present (P5)
* ``distinct_origins``   origins flown in the input (P21)
* ``airports_in_month``  sentinel-filtered airports semi-joined to origins (J11)
* ``airport_xwalk``      IATA -> ICAO -> station id, case-sensitive, fan-out kept (J3)
* ``station_map``        one station per IATA via case-insensitive ICAO, lowest id (J2 + W1)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.flags import SENTINEL, is_present


def sentinel_filter(airports: DataFrame) -> DataFrame:
    return airports.where(is_present(F.col("iata")) & is_present(F.col("icao"))
                          & is_present(F.col("tz")))


def distinct_origins(flights: DataFrame) -> DataFrame:
    return flights.select(F.col("origin").alias("iata")).distinct()


def airports_in_month(airports: DataFrame, flights: DataFrame) -> DataFrame:
    return sentinel_filter(airports).join(distinct_origins(flights), "iata", "left_semi")


def airport_xwalk(airports: DataFrame, flights: DataFrame, stations: DataFrame) -> DataFrame:
    """Crosswalk rows (iata, icao, meteostat_id). Station ICAO must equal the
    airport ICAO exactly; NULL never matches; airports without a station are
    dropped; several stations per airport are all kept."""
    a = (airports.join(distinct_origins(flights), "iata", "left_semi")
         .where(F.col("icao") != F.lit(SENTINEL))
         .select("iata", "icao"))
    s = stations.select(F.col("icao").alias("s_icao"), F.col("id").alias("meteostat_id"))
    return (a.join(s, a.icao == s.s_icao, "inner")
            .select("iata", "icao", "meteostat_id"))


def station_map(airports: DataFrame, stations: DataFrame) -> DataFrame:
    """(iata, icao, tz, station_id): the lowest station id whose ICAO matches
    the airport ICAO ignoring case. ``airports`` is already filtered to the
    airports of interest (``airports_in_month``)."""
    a = airports.where(is_present(F.col("tz"))).select("iata", "icao", "tz")
    s = stations.select(F.lower("icao").alias("s_icao_lc"), F.col("id").alias("station_id"))
    joined = a.join(s, F.lower(a.icao) == s.s_icao_lc, "inner")
    w = Window.partitionBy("iata").orderBy("station_id", "icao", "tz")
    return (joined.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select("iata", "icao", "tz", "station_id"))
