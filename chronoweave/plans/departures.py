"""Feature table for departures: cleaning, vehicle history, site congestion, rates and weather.

Every step is a function from tables to a table; :func:`build_features` runs them over a stage store
so that a rerun continues after the last committed stage.  Column names follow the public on-time
performance and hourly weather files.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions import scalars as s
from chronoweave.operators import clean, enrich, temporal
from chronoweave.sources.stages import StageStore, input_version

# Source columns, their types and their names in the feature table.
FLIGHT_COLUMNS = {
    "DepDel15": ("DEP_DEL15", "double"),
    "FlightDate": ("FL_DATE", "date"),
    "Year": ("YEAR", "int"),
    "Quarter": ("QUARTER", "int"),
    "Month": ("MONTH", "int"),
    "DayofMonth": ("DAY_OF_MONTH", "int"),
    "DayOfWeek": ("DAY_OF_WEEK", "int"),
    "CRSDepTime": ("CRS_DEP_TIME", "int"),
    "DepTimeBlk": ("DEP_TIME_BLK", "string"),
    "Reporting_Airline": ("OP_UNIQUE_CARRIER", "string"),
    "Flight_Number_Reporting_Airline": ("OP_CARRIER_FL_NUM", "int"),
    "Tail_Number": ("TAIL_NUM", "string"),
    "Origin": ("ORIGIN", "string"),
    "OriginCityName": ("ORIGIN_CITY_NAME", "string"),
    "OriginState": ("ORIGIN_STATE_ABR", "string"),
    "Dest": ("DEST", "string"),
    "DestCityName": ("DEST_CITY_NAME", "string"),
    "DestState": ("DEST_STATE_ABR", "string"),
    "OriginAirportID": ("ORIGIN_AIRPORT_ID", "int"),
    "DestAirportID": ("DEST_AIRPORT_ID", "int"),
    "OriginWac": ("ORIGIN_WAC", "int"),
    "DestWac": ("DEST_WAC", "int"),
    "Distance": ("DISTANCE", "double"),
    "DistanceGroup": ("DISTANCE_GROUP", "int"),
    "CRSElapsedTime": ("CRS_ELAPSED_TIME", "double"),
    "ARR_DELAY": ("ARR_DELAY", "double"),
    "TAXI_IN": ("TAXI_IN", "double"),
    "TAXI_OUT": ("TAXI_OUT", "double"),
    "ARR_TIME": ("ARR_TIME", "int"),
    "DEP_TIME": ("DEP_TIME", "int"),
    "CRS_ARR_TIME": ("CRS_ARR_TIME", "int"),
    "CANCELLED": ("CANCELLED", "double"),
}
# Hourly readings that are averaged, and those taken from the earliest reading.
AVERAGED = [
    "HourlyWindSpeed",
    "HourlyWindGustSpeed",
    "HourlyVisibility",
    "HourlyDryBulbTemperature",
    "HourlyWetBulbTemperature",
    "HourlyDewPointTemperature",
    "HourlyRelativeHumidity",
    "HourlySeaLevelPressure",
]
EARLIEST = ["HourlySkyConditions", "HourlyPresentWeatherType", "HourlyPrecipitation"]
# Names of the columns a vehicle's previous departure contributes.
PREVIOUS = {
    "TAXI_IN": "Prev_TaxiIn",
    "TAXI_OUT": "Prev_TaxiOut",
    "ARR_DELAY": "Prev_ArrDelay",
    "ARR_TIME": "Prev_ArrTime",
    "FlightDate": "Prev_FlightDate",
}
# Names of the rate columns, per frame and flag.
RATE_NAMES = {
    f"{frame}_{flag}_pct": f"{frame}_ontime_{flag}_pct"
    for frame in temporal.HISTORY
    for flag in ("arrival", "departure")
}
OLD_RATE_NAMES = {
    "OntimeArrivalPct": "historical_ontime_arrival_pct",
    "OntimeDeparturePct": "historical_ontime_departure_pct",
}

#: Orders two departures of one vehicle at the same scheduled minute.
TIEBREAK = ["Flight_Number_Reporting_Airline", "Origin", "Dest"]


def clean_flights(raw: DataFrame) -> DataFrame:
    typed = clean.typed_projection(raw, FLIGHT_COLUMNS)
    return clean.dedup_rows(clean.require_not_null(typed, ["FlightDate", "Origin", "Dest", "CRSDepTime"]))


def clean_weather(raw: DataFrame) -> DataFrame:
    """Readings with their exact time kept, so that "earliest in the hour" means something."""
    numeric = [*AVERAGED, "HourlyPrecipitation"]
    pinned = {"STATION": ("STATION", "string")}
    pinned |= {c: (c, "double" if c in numeric else "string") for c in [*AVERAGED, *EARLIEST]}
    stamped = raw.withColumn("_ts", F.try_to_timestamp(F.col("DATE").cast("string")))
    typed = clean.typed_projection(stamped, pinned | {"reading_ts": ("_ts", "timestamp")})
    present = clean.require_not_null(typed, ["STATION", "reading_ts"])
    return clean.dedup_rows(present.withColumn("hour_ts", F.date_trunc("HOUR", "reading_ts")))


def clean_stations(raw: DataFrame, prefix: str = "K") -> DataFrame:
    """Station to site map with distance; site codes carry a country prefix that is removed."""
    pinned = {
        "STATION": ("station_id", "string"),
        "airport_code": ("neighbor_call", "string"),
        "distance": ("distance_to_neighbor", "double"),
    }
    typed = clean.require_not_null(clean.typed_projection(raw, pinned), ["STATION", "airport_code"])
    mapped = clean.prefix_filter(typed, "airport_code", prefix)
    # A pair listed twice keeps its shortest distance.
    return mapped.groupBy("STATION", "airport_code").agg(F.min("distance").alias("distance"))


def vehicle_features(flights: DataFrame, mode: str = "minutes", horizon_s: int | None = None) -> DataFrame:
    """Previous departure of the same vehicle and the turnaround after it.

    With ``horizon_s`` it is the last departure that had arrived so many seconds before the scheduled one.
    """
    day, clock, order = F.col("FlightDate"), F.col("CRSDepTime"), ["FlightDate", "CRSDepTime"]
    if horizon_s is None:
        lagged = temporal.entity_lag(flights, "Tail_Number", order, TIEBREAK, PREVIOUS)
    else:
        departs = s.to_epoch_seconds(s.hhmm_to_timestamp(day, clock))
        arrived = s.to_epoch_seconds(s.arrival_timestamp(day, clock, F.col("ARR_TIME")))
        clocked = flights.withColumns({"_departs": departs, "_arrived": arrived})
        lagged = temporal.entity_lag_known(
            clocked, "Tail_Number", order, TIEBREAK, PREVIOUS, "_departs", "_arrived", horizon_s
        ).drop("_departs", "_arrived")
    gap = s.turnaround(day, clock, F.col("Prev_FlightDate"), F.col("Prev_ArrTime"), mode)
    return lagged.withColumn("Turnaround_Time", gap)


def timed(flights: DataFrame) -> DataFrame:
    """Add scheduled timestamps, epochs and 0/1 flags; rows without a valid departure clock go."""
    day, dep, arr = F.col("FlightDate"), F.col("CRSDepTime"), F.col("CRS_ARR_TIME")
    stamped = flights.withColumns(
        {
            "departure_datetime": s.hhmm_to_timestamp(day, dep),
            "arrival_datetime": s.arrival_timestamp(day, dep, arr),
            "delay_flag": s.indicator_flag(F.col("DepDel15") == 1),
            "cancel_flag": s.indicator_flag(F.col("CANCELLED") == 1),
        }
    ).filter(F.col("departure_datetime").isNotNull())
    return stamped.withColumns(
        {
            "departure_epoch": s.to_epoch_seconds(F.col("departure_datetime")),
            "arrival_epoch": s.to_epoch_seconds(F.col("arrival_datetime")),
        }
    )


def congestion_features(flights: DataFrame, horizon_s: int = 1, arrival_horizon_s: int = 0) -> DataFrame:
    """Delays, cancellations and arrivals at the origin in the last two hours, up to a horizon before departure."""
    flags = {"Num_airport_wide_delays": F.col("delay_flag"), "Num_airport_wide_cancelations": F.col("cancel_flag")}
    counted = temporal.trailing_count(flights, "Origin", "departure_epoch", flags, horizon_s=horizon_s)
    arrivals = flights.select(F.col("Dest").alias("Origin"), F.col("arrival_epoch").alias("departure_epoch")).dropna()
    return temporal.trailing_arrivals(
        counted, arrivals, "Origin", "departure_epoch", out="Oncoming_flights", horizon_s=arrival_horizon_s
    )


def history_features(flights: DataFrame, skip_null: bool = False) -> DataFrame:
    """On-time shares of the vehicle over all history, two weeks and ninety days."""
    label = F.col("DepDel15")
    on_time_departure = F.when(label == 0, 1).otherwise(0)
    flags = {
        "arrival": temporal.on_time_flag(F.col("ARR_DELAY"), 15, skip_null),
        "departure": F.when(label.isNotNull(), on_time_departure) if skip_null else on_time_departure,
    }
    rated = temporal.history_rates(flights, "Tail_Number", "departure_epoch", flags)
    return temporal.legacy_alias(rated.withColumnsRenamed(RATE_NAMES), OLD_RATE_NAMES)


def weather_features(flights: DataFrame, weather: DataFrame, stations: DataFrame) -> DataFrame:
    """Reading of the nearest station in the hour that starts two hours before the departure hour."""
    days = flights.withColumn("_day", F.to_date("departure_datetime"))
    seen = clean.range_filter(weather.withColumn("_day", F.to_date("hour_ts")), "_day", days, "_day").drop("_day")
    bucket = s.lookup_bucket(F.col("departure_datetime"))
    wanted = flights.select(F.col("Origin").alias("airport_code"), bucket.alias("hour_ts")).distinct()
    served = enrich.semi_join_keys(stations, wanted, ["airport_code"])
    useful = enrich.semi_join_keys(seen, served, ["STATION"])
    hourly = enrich.hourly_dedup_avg(
        useful, ["STATION", "hour_ts"], AVERAGED, EARLIEST, ["reading_ts", *EARLIEST, *AVERAGED]
    )
    nearest = enrich.nearest_reading(
        wanted, hourly, served, "STATION", "airport_code", "hour_ts", "distance", [*AVERAGED, *EARLIEST]
    ).drop("STATION")
    return enrich.bucket_lookup_join(flights, nearest, {"Origin": "airport_code"}, bucket, "hour_ts")


# The selected feature columns in their published order.
FINAL_COLUMNS = [
    "DepDel15",
    "FlightDate",
    "Year",
    "Quarter",
    "Month",
    "DayofMonth",
    "DayOfWeek",
    "CRSDepTime",
    "DepTimeBlk",
    "departure_datetime",
    "arrival_datetime",
    "Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "Tail_Number",
    "Origin",
    "OriginCityName",
    "OriginState",
    "Dest",
    "DestCityName",
    "DestState",
    "OriginAirportID",
    "DestAirportID",
    "OriginWac",
    "DestWac",
    "Distance",
    "DistanceGroup",
    "CRSElapsedTime",
    "ARR_DELAY",
    "TAXI_IN",
    "TAXI_OUT",
    "ARR_TIME",
    "DEP_TIME",
    "CRS_ARR_TIME",
    "CANCELLED",
    "delay_flag",
    "cancel_flag",
    "HourlyWindSpeed",
    "HourlyWindGustSpeed",
    "HourlyVisibility",
    "HourlySkyConditions",
    "HourlyPrecipitation",
    "HourlyPresentWeatherType",
    "HourlyDryBulbTemperature",
    "HourlyWetBulbTemperature",
    "HourlyDewPointTemperature",
    "HourlyRelativeHumidity",
    "HourlySeaLevelPressure",
    "Prev_TaxiIn",
    "Prev_TaxiOut",
    "Prev_ArrDelay",
    "Prev_ArrTime",
    "Prev_FlightDate",
    "Turnaround_Time",
    "Num_airport_wide_delays",
    "Num_airport_wide_cancelations",
    "Oncoming_flights",
    "historical_ontime_arrival_pct",
    "historical_ontime_departure_pct",
    "recent_ontime_arrival_pct",
    "recent_ontime_departure_pct",
    "short_term_ontime_arrival_pct",
    "short_term_ontime_departure_pct",
    "OntimeArrivalPct",
    "OntimeDeparturePct",
]


def final_features(flights: DataFrame, weekend: tuple[int, ...] = (6, 7)) -> DataFrame:
    """Select the feature columns and add calendar flags."""
    selected, missing = clean.project_available(flights, FINAL_COLUMNS)
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    hour = F.hour("departure_datetime")
    flags = s.calendar_flags(F.col("DayOfWeek"), hour, F.col("Month"), weekend)
    return selected.withColumns({"Hour": hour, **flags})


@dataclass(frozen=True)
class Switches:
    """Choices of the workflow; each one is an argument of the step that it belongs to."""

    prefix: str = "K"
    turnaround_mode: str = "minutes"
    vehicle_horizon_s: int | None = None
    congestion_horizon_s: int = 1
    arrival_horizon_s: int = 0
    skip_null: bool = False
    weekend: tuple[int, ...] = (6, 7)


def build_features(
    store: StageStore,
    flights: DataFrame,
    weather: DataFrame,
    stations: DataFrame,
    version: str = "1",
    switches: Switches = Switches(),
    inputs: Sequence[str] = (),
) -> DataFrame:
    """Run all steps over a stage store and return the stored feature table, one folder per year.

    ``inputs`` are the paths that the three tables come from: stages built before one of their files changed
    are not picked up.  Without them ``version`` tells the input apart; other switches give other stages.
    """
    version = input_version(store.spark, *inputs) if inputs else version
    built = version if switches == Switches() else f"{version}-{zlib.crc32(repr(switches).encode()):08x}"

    def stage(name, build, **kw):
        return store.stage(name, build, built, **kw)

    cleaned = stage("flights", lambda: clean_flights(flights))
    readings = stage("readings", lambda: clean_weather(weather))
    sites = stage("sites", lambda: clean_stations(stations, switches.prefix))
    lagged = stage("vehicles", lambda: vehicle_features(cleaned, switches.turnaround_mode, switches.vehicle_horizon_s))
    crowded = stage(
        "congestion",
        lambda: congestion_features(timed(lagged), switches.congestion_horizon_s, switches.arrival_horizon_s),
    )
    rated = stage("rates", lambda: history_features(crowded, switches.skip_null))
    weathered = stage("weathered", lambda: weather_features(rated, readings, sites), partition_by=["Year"])
    # In order of time inside a year, so that a span of days reads few row groups.
    return stage(
        "features", lambda: final_features(weathered, switches.weekend), partition_by=["Year"], cluster_by=["departure_datetime"]
    )
