"""Whole workflows on departure-like tables derived from events, and on the line-item model table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.registry import q6, query, r6
from bindings.tables import LINE_COLUMNS, LINE_KEYS, NUMERICS, with_views
from chronoweave.functions import scalars as s
from chronoweave.plans import delay_model as dm
from chronoweave.plans import departures as dp
from chronoweave.scratch import scratch_root
from chronoweave.sources.stages import ModelStore, StageStore


def _folder(x) -> str:
    return f"{scratch_root(x.spark).rstrip('/')}/workflow-{uuid.uuid4().hex}"


def raw_flights(x):
    """Departures from all events but errors: vehicle and site come from the user."""
    parts = s.calendar_parts(F.col("ts"))
    eid, user = F.col("event_id"), F.col("user_id")
    site = F.concat(F.lit("S"), user % 10)
    target = F.concat(F.lit("S"), (user + eid) % 10)
    columns = {
        "DEP_DEL15": F.when(eid % 23 != 0, F.col("flag")),
        "FL_DATE": F.col("d").cast("string"),
        "YEAR": parts["year"],
        "QUARTER": parts["quarter"],
        "MONTH": parts["month"],
        "DAY_OF_MONTH": parts["day"],
        "DAY_OF_WEEK": parts["iso_weekday"],
        "CRS_DEP_TIME": F.col("dep"),
        "DEP_TIME_BLK": F.lit("0000-0059"),
        "OP_UNIQUE_CARRIER": F.col("event_type"),
        "OP_CARRIER_FL_NUM": eid,
        "TAIL_NUM": F.when(eid % 50 != 0, F.concat(F.lit("T"), user)),
        "ORIGIN": site,
        "ORIGIN_CITY_NAME": site,
        "ORIGIN_STATE_ABR": F.lit("XX"),
        "DEST": target,
        "DEST_CITY_NAME": target,
        "DEST_STATE_ABR": F.lit("XX"),
        "ORIGIN_AIRPORT_ID": user % 10,
        "DEST_AIRPORT_ID": (user + eid) % 10,
        "ORIGIN_WAC": F.lit(1),
        "DEST_WAC": F.lit(1),
        "DISTANCE": F.col("value"),
        "DISTANCE_GROUP": F.lit(1),
        "CRS_ELAPSED_TIME": F.lit(180),
        "ARR_DELAY": F.when(eid % 7 != 0, F.col("value") - 40),
        "TAXI_IN": F.col("h"),
        "TAXI_OUT": F.col("h") + 1,
        "ARR_TIME": F.col("arr"),
        "DEP_TIME": F.col("dep"),
        "CRS_ARR_TIME": F.col("arr"),
        "CANCELLED": F.when(eid % 31 == 0, 1).otherwise(0),
    }
    return x.clock.filter("event_type <> 'error'").select(*(c.alias(n) for n, c in columns.items()))


def raw_weather(x):
    """Readings from error events; every eleventh has a token that is no number."""
    text = F.col("value").cast("string")
    reading = F.when(F.col("event_id") % 11 == 0, F.concat(text, F.lit("s"))).otherwise(text)
    numeric = [reading.alias(c) for c in [*dp.AVERAGED, "HourlyPrecipitation"]]
    return x.obs.select(
        F.col("station").cast("string").alias("STATION"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        *numeric,
        F.col("props").alias("HourlySkyConditions"),
        F.lit("").alias("HourlyPresentWeatherType"),
    )


def raw_stations(x):
    return x.stations.select(
        F.col("station").alias("station_id"),
        F.concat(F.lit("KS"), "site").alias("neighbor_call"),
        F.col("distance").alias("distance_to_neighbor"),
    )


def _rate(flag: str, start: str) -> str:
    frame = f"(PARTITION BY tail ORDER BY dep_sec RANGE BETWEEN {start} PRECEDING AND 7200 PRECEDING)"
    return f"CASE WHEN tail IS NOT NULL AND count({flag}) OVER {frame} >= 3 THEN {q6(f'100 * avg({flag}) OVER {frame}')} END"


def _flights(arrivals: int = 0, skip_null: bool = False) -> str:
    """Views of the feature workflow; the arguments are switches."""
    views = _FLIGHTS.replace("AND a.dep_sec GROUP", f"AND a.dep_sec - {arrivals} GROUP")
    if skip_null:
        views = views.replace("CASE WHEN coalesce(delay, 0) <= 15", "CASE WHEN delay IS NULL THEN NULL WHEN delay <= 15")
        views = views.replace("CASE WHEN late = 0 THEN 1 ELSE 0 END AS on_dep", "CASE WHEN late IS NOT NULL THEN CASE WHEN late = 0 THEN 1 ELSE 0 END END AS on_dep")
    return views


_FLIGHTS = """f AS (
  SELECT event_id AS num, d, dep, arr, h, CASE WHEN event_id % 50 <> 0 THEN 'T' || user_id END AS tail,
    'S' || (user_id % 10) AS origin, 'S' || ((user_id + event_id) % 10) AS dest, ts,
    CASE WHEN event_id % 23 <> 0 THEN flag END AS late, CASE WHEN event_id % 7 <> 0 THEN value - 40 END AS delay,
    CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END AS cancelled,
    CAST(epoch(CAST(d AS TIMESTAMP)) AS BIGINT) + ((dep // 100) * 60 + dep % 100) * 60 AS dep_sec,
    CAST(epoch(CAST(d AS TIMESTAMP)) AS BIGINT) + ((arr // 100) * 60 + arr % 100) * 60
      + CASE WHEN arr < dep THEN 86400 ELSE 0 END AS arr_sec
  FROM clock WHERE event_type <> 'error'),
lagged AS (
  SELECT *, lag(delay) OVER w AS prev_delay, lag(d) OVER w AS pd, lag(arr) OVER w AS pa
  FROM f WINDOW w AS (PARTITION BY tail ORDER BY d, dep, num, origin, dest)),
crowd AS (
  SELECT a.num, count(b.num) AS oncoming FROM f a LEFT JOIN f b
    ON a.origin = b.dest AND b.arr_sec BETWEEN a.dep_sec - 7200 AND a.dep_sec GROUP BY a.num),
rates AS (
  SELECT *, CASE WHEN coalesce(delay, 0) <= 15 THEN 1 ELSE 0 END AS on_arr, CASE WHEN late = 0 THEN 1 ELSE 0 END AS on_dep FROM f),
readings AS (
  SELECT station, site, hour_ts, ts, props,
    try_cast(CASE WHEN event_id % 11 = 0 THEN value || 's' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS v FROM obs),
hourly AS (
  SELECT station, site, hour_ts, avg(v) AS wind, arg_min(props, (date_trunc('second', ts), props)) AS sky,
    max(CASE WHEN first THEN v END) AS rain
  FROM (SELECT *, row_number() OVER (PARTITION BY station, hour_ts ORDER BY date_trunc('second', ts), props) = 1 AS first FROM readings)
  GROUP BY station, site, hour_ts),
nearest AS (
  SELECT h.* FROM hourly h JOIN stations s ON h.station = s.station
  QUALIFY row_number() OVER (PARTITION BY h.site, hour_ts ORDER BY distance, CAST(h.station AS VARCHAR)) = 1)"""

_ZERO = "CAST(coalesce(sum({}) OVER (PARTITION BY origin ORDER BY dep_sec RANGE BETWEEN 7200 PRECEDING AND {} PRECEDING), 0) AS BIGINT)"
_MIN = "(({0} // 100) * 60 + {0} % 100)"


def departure_features(x, switches: dp.Switches = dp.Switches()):
    """The complete feature workflow over a fresh stage store, versioned by the files of the events."""
    store = StageStore(x.spark, _folder(x))
    events = f"{x.folder}/events.parquet"
    final = dp.build_features(store, raw_flights(x), raw_weather(x), raw_stations(x), switches=switches, inputs=[events])
    names = {
        "Flight_Number_Reporting_Airline": "num",
        "Num_airport_wide_delays": "delays",
        "Num_airport_wide_cancelations": "cancels",
        "Oncoming_flights": "oncoming",
        "HourlySkyConditions": "sky",
        "SeasonQuarter": "season",
        "IsWeekend": "weekend",
    }
    rounded = {
        "Prev_ArrDelay": "prev_delay",
        "historical_ontime_arrival_pct": "hist_arr",
        "recent_ontime_departure_pct": "recent_dep",
        "short_term_ontime_arrival_pct": "short_arr",
        "OntimeDeparturePct": "old_dep",
        "HourlyWindSpeed": "wind",
        "HourlyPrecipitation": "rain",
    }
    return final.select(
        *(F.col(c).alias(n) for c, n in names.items()),
        *(r6(c).alias(n) for c, n in rounded.items()),
        F.col("Turnaround_Time").cast("long").alias("turnaround"),
    )


def _features_sql(weekend: str = "6, 7", congestion: int = 1, arrivals: int = 0, skip_null: bool = False) -> str:
    return with_views("clock", "obs", "stations", extra=_flights(arrivals, skip_null)) + f"""SELECT CAST(f.num AS INTEGER) AS num, k.delays, k.cancels, c.oncoming, n.sky,
  CASE WHEN month(f.d) IN (12, 1, 2) THEN 'Winter' WHEN month(f.d) IN (3, 4, 5) THEN 'Spring'
       WHEN month(f.d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  CASE WHEN isodow(f.d) IN ({weekend}) THEN 1 ELSE 0 END AS weekend,
  CASE WHEN f.tail IS NOT NULL THEN {q6('l.prev_delay')} END AS prev_delay, hist_arr, recent_dep, short_arr, old_dep,
  {q6('n.wind')} AS wind, {q6('n.rain')} AS rain,
  CAST(CASE WHEN f.tail IS NOT NULL THEN CASE datediff('day', l.pd, f.d) WHEN 0 THEN {_MIN.format('f.dep')} - {_MIN.format('l.pa')}
    WHEN 1 THEN {_MIN.format('f.dep')} + 1440 - {_MIN.format('l.pa')} END END AS BIGINT) AS turnaround
FROM f JOIN lagged l ON f.num = l.num JOIN crowd c ON f.num = c.num
JOIN (SELECT num, {_ZERO.format('CASE WHEN late = 1 THEN 1 ELSE 0 END', congestion)} AS delays, {_ZERO.format('cancelled', congestion)} AS cancels FROM f) k ON f.num = k.num
JOIN (SELECT num, {_rate('on_arr', 'UNBOUNDED')} AS hist_arr, {_rate('on_dep', '1209600')} AS recent_dep,
  {_rate('on_arr', '7776000')} AS short_arr, {_rate('on_dep', 'UNBOUNDED')} AS old_dep FROM rates) r ON f.num = r.num
LEFT JOIN nearest n ON f.origin = 'S' || n.site AND date_trunc('hour', f.ts) - INTERVAL 2 HOUR = n.hour_ts"""


query("departure_features", _features_sql())(departure_features)


@query("departure_features_strict", _features_sql("5, 6", 900, 600, True))
def _(x):
    """The same with nothing counted before it can be known: ten minutes for arrivals, a quarter of an hour for congestion, unknown delays skipped."""
    strict = dp.Switches(congestion_horizon_s=900, arrival_horizon_s=600, skip_null=True, weekend=(5, 6))
    return departure_features(x, strict)


LINE_SPEC = dm.ModelSpec(
    label="label",
    keys=LINE_COLUMNS,
    hash_keys=LINE_KEYS,
    period="y",
    month="m",
    numeric=NUMERICS,
    order=["label"],
    blocks=[1995, 1996, 1997, 1998],
    test_period=1999,
    features=["m", "scaled_features"],
)


@query("delay_model")
def _(x):
    """Rows, balance, blocked search of both families, stored winners and runs, cut-offs, vote and report."""
    inputs = [f"{x.folder}/lineitem.parquet"]
    train, test = dm.prepare_tables(StageStore(x.spark, _folder(x)), x.li, LINE_SPEC, inputs=inputs)
    store, runs = ModelStore(x.spark, _folder(x)), _folder(x)
    found = dm.fit_models(train, test, LINE_SPEC, store)
    fitted = {name: store.load(name) for name in ("logreg", "mlp")}
    cuts = dm.choose_thresholds(fitted, train, LINE_SPEC)
    dm.log_runs(x.spark, runs, "delay", found, cuts)
    report, _ = dm.ensemble_report(dm.ensemble_predictions(fitted, test, LINE_SPEC, thresholds=cuts))
    return report
