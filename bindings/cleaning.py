"""Projection, filtering, deduplication, sampling, ordering and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bindings.registry import q6, query, r6
from bindings.tables import LINE_COLUMNS, NUMERICS, hash_sql, with_views
from chronoweave.functions import scalars as s
from chronoweave.operators import clean
from chronoweave.operators import temporal as t
from chronoweave.ordering import positions

EV = with_views("ev")
EV_NULL = with_views("ev_null")
EV_DUP = with_views("ev_dup")
CLOCK = with_views("clock")

# A text form of the value column with tokens that do not parse, as raw sensor feeds have.
_RAW_SQL = """raw AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 11 = 0 THEN value || 'T'
  WHEN event_id % 13 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS reading,
  regexp_extract(props, '([0-9]+)', 1) AS k FROM ev)"""


def _raw(x):
    text = F.col("value").cast("string")
    reading = F.when(F.col("event_id") % 11 == 0, F.concat(text, F.lit("T"))).when(F.col("event_id") % 13 == 0, "")
    return x.ev.select(
        "event_id", "event_type", "ts", reading.otherwise(text).alias("reading"), F.regexp_extract("props", "([0-9]+)", 1).alias("k")
    )


@query(
    "typed_projection",
    with_views("ev", extra=_RAW_SQL)
    + """SELECT event_id, event_type AS kind, try_cast(reading AS DOUBLE) AS reading,
       CAST(try_cast(k AS INTEGER) AS INTEGER) AS k FROM raw""",
)
def _(x):
    pinned = {
        "event_id": ("event_id", "long"),
        "kind": ("event_type", "string"),
        "reading": ("reading", "double"),
        "k": ("k", "int"),
    }
    return clean.typed_projection(_raw(x), pinned)


@query(
    "require_not_null",
    with_views("ev_null", extra="""named AS (SELECT *, CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END AS kind FROM ev_null)""")
    + "SELECT event_id, user_id, kind, value FROM named WHERE user_id IS NOT NULL AND value IS NOT NULL AND kind <> ''",
)
def _(x):
    named = x.ev_null.withColumn("kind", F.when(F.col("event_id") % 9 == 0, "").otherwise(F.col("event_type")))
    return clean.require_not_null(named, ["user_id", "value", "kind"]).select("event_id", "user_id", "kind", "value")


@query("drop_missing_required", EV_NULL + "SELECT event_id, user_id, value FROM ev_null WHERE user_id IS NOT NULL AND value IS NOT NULL")
def _(x):
    return clean.drop_missing_required(x.ev_null.select("event_id", "user_id", "value"))


@query(
    "null_safe_filter",
    EV_NULL + "SELECT event_id, user_id FROM ev_null WHERE user_id <> 7 OR user_id IS NULL",
)
def _(x):
    return clean.null_safe_filter(x.ev_null, "user_id", 7).select("event_id", "user_id")


@query("fill_constant", EV_NULL + "SELECT event_id, coalesce(user_id, -1) AS user_id, coalesce(value, CAST(0 AS DOUBLE)) AS value FROM ev_null")
def _(x):
    return clean.fill_constant(x.ev_null.select("event_id", "user_id", "value"), {"user_id": -1, "value": 0.0})


@query("dedup_rows", EV_DUP + "SELECT DISTINCT event_id, sec, user_id, event_type, value FROM ev_dup")
def _(x):
    return clean.dedup_rows(x.ev_dup.select("event_id", "sec", "user_id", "event_type", "value"))


@query(
    "dedup_keys",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(c for c in LINE_COLUMNS)}) = 1""",
)
def _(x):
    first = clean.dedup_keys(x.lineitem, ["l_orderkey", "l_linenumber"], LINE_COLUMNS)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(x):
    return clean.distinct_rows(x.lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"])


# A column that is null in six of ten rows.
_SPARSE_SQL = "sparse AS (SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 10 < 4 THEN h END AS mostly FROM ev_null)"


def sparse(x):
    return x.ev_null.select(
        "event_id", "user_id", "event_type", "value", F.when(F.col("event_id") % 10 < 4, F.col("h")).alias("mostly")
    )


SPARSE = with_views("ev_null", extra=_SPARSE_SQL)


@query("drop_sparse_columns", SPARSE + "SELECT event_id, user_id, event_type, value FROM sparse")
def _(x):
    return clean.drop_sparse_columns(sparse(x))


@query(
    "wide_to_long",
    SPARSE
    + """SELECT event_id, 'value' AS feature, value FROM sparse UNION ALL
SELECT event_id, 'mostly', CAST(mostly AS DOUBLE) FROM sparse""",
)
def _(x):
    wide = sparse(x).withColumn("mostly", F.col("mostly").cast("double"))
    return clean.wide_to_long(wide, ["event_id"], ["value", "mostly"])


@query("project_available", "SELECT c_custkey, c_mktsegment, 'c_phone' AS missing FROM customer")
def _(x):
    found, missing = clean.project_available(x.customer, ["c_custkey", "c_phone", "c_mktsegment"])
    return found.withColumn("missing", F.lit(",".join(missing)))


MEDIAN_SQL = f"""SELECT event_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM sparse)) AS value,
  coalesce(CAST(mostly AS DOUBLE), (SELECT quantile_cont(mostly, 0.5) FROM sparse)) AS mostly FROM sparse"""


@query("fill_median", SPARSE + f"SELECT event_id, {q6('value')} AS value, {q6('mostly')} AS mostly FROM ({MEDIAN_SQL})")
def _(x):
    filled = clean.fill_median(sparse(x), ["value", "mostly"], exact=True)
    return filled.select("event_id", r6("value").alias("value"), r6("mostly").alias("mostly"))


@query("fill_median_approx")
def _(x):
    """The one-aggregate variant with an approximate median."""
    return clean.fill_median(sparse(x), ["value", "mostly"]).select("event_id", "value", "mostly")


@query(
    "split_by_period",
    with_views("li")
    + """SELECT CASE WHEN y = 1999 THEN 'test' ELSE 'train' END AS part, y, count(*) AS n
FROM li WHERE y >= 1995 AND y <= 1999 GROUP BY ALL""",
)
def _(x):
    train, test = clean.split_by_period(x.li, "y", 1995, 1999, 1999)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "y").agg(F.count("*").alias("n"))


@query(
    "range_filter",
    """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) - 1 AS lo, CAST(max(o_orderdate) AS DATE) + 1 AS hi
  FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem, b
WHERE CAST(l_shipdate AS DATE) BETWEEN lo AND hi""",
)
def _(x):
    lines = x.lineitem.withColumn("day", F.to_date("l_shipdate"))
    bounds = x.orders.filter("o_orderstatus = 'P' AND o_totalprice > 400000").withColumn("od", F.to_date("o_orderdate"))
    kept = clean.range_filter(lines, "day", bounds, "od")
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("day").cast("string").alias("day"))


@query("prefix_filter", "SELECT p_partkey, substr(p_brand, 8) AS code FROM part WHERE p_brand LIKE 'Brand#1%'")
def _(x):
    return clean.prefix_filter(x.part, "p_brand", "Brand#1", "code").select("p_partkey", "code")


@query("point_lookup", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 1234")
def _(x):
    return clean.point_lookup(x.orders, "o_orderkey", 1234).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "sample_fraction",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE {hash_sql('o_orderkey')} < {int(0.2 * 2**32)}",
)
def _(x):
    return clean.sample_fraction(x.orders, 0.2, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("sample_n_rows", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_sql('o_orderkey')}, o_orderkey LIMIT 500")
def _(x):
    return clean.sample_n_rows(x.orders, 500, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("select_by_type", "SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey_d, o_totalprice, o_orderstatus, o_orderpriority FROM orders")
def _(x):
    numbers = clean.columns_of_type(x.orders, exclude=["o_orderkey"])
    texts = clean.columns_of_type(x.orders, StringType)
    as_double = clean.select_by_type(x.orders.select(*numbers), cast="double").columns
    return x.orders.select(
        "o_orderkey", *(F.col(c).cast("double").alias(f"{c}_d" if c == "o_custkey" else c) for c in as_double), *texts
    )


@query("drop_columns", "SELECT o_orderkey AS order_id, o_custkey, o_totalprice FROM orders")
def _(x):
    return clean.drop_columns(x.orders, ["o_orderdate", "o_orderpriority", "o_orderstatus"], {"o_orderkey": "order_id"})


@query("except_keys", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def _(x):
    big = x.orders.filter("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    return clean.except_keys(x.customer, big, "c_custkey")


@query(
    "global_sort",
    "SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS position FROM events",
)
def _(x):
    """The sort itself is order-insensitive to a hash, so the position in the order is what is compared."""
    return positions(x.events, ["value", "event_id"]).select("event_id", "position")


@query("global_sort_rows", EV + "SELECT sec, event_id, event_type FROM ev")
def _(x):
    """The sorted rows themselves; only their content is compared."""
    return clean.global_sort(x.ev, ["sec", "event_id"]).select("sec", "event_id", "event_type")


@query("preview", "SELECT event_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 10")
def _(x):
    return clean.preview(x.events, ["ts", "event_id"], 10).select("event_id", "event_type", "value")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(x):
    return clean.top_k(x.orders, "o_totalprice", "o_orderkey", 10).select("o_orderkey", "o_totalprice")


@query("rank_slice", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 20")
def _(x):
    return clean.rank_slice(x.orders, "o_totalprice", "o_orderkey", 20, 20).select("o_orderkey", "o_totalprice")


def _stamp(day: str, clock: str) -> str:
    return (
        f"epoch(CAST({day} AS TIMESTAMP) + to_minutes(CAST(({clock} // 100) * 60 + {clock} % 100 AS BIGINT)))"
    )


@query(
    "hhmm_to_timestamp",
    CLOCK
    + f"""SELECT event_id, CAST({_stamp('d', 'dep')} AS BIGINT) AS dep_sec, CAST({_stamp('d', 'arr')} AS BIGINT) AS arr_sec,
  CAST({_stamp('d', 'arr')} AS BIGINT) + CASE WHEN arr < dep THEN 86400 ELSE 0 END AS rolled_sec FROM clock""",
)
def _(x):
    d, dep, arr = F.col("d"), F.col("dep"), F.col("arr")
    return x.clock.select(
        "event_id",
        F.unix_timestamp(s.hhmm_to_timestamp(d, dep)).alias("dep_sec"),
        F.unix_timestamp(s.hhmm_to_timestamp(d, arr)).alias("arr_sec"),
        F.unix_timestamp(s.arrival_timestamp(d, dep, arr)).alias("rolled_sec"),
    )


_GAP = """SELECT event_id,
  CAST(CASE datediff('day', pd, d) WHEN 0 THEN {now} - {before} WHEN 1 THEN {now} + {day} - {before} END AS BIGINT) AS gap
FROM (SELECT event_id, d, dep, lag(d) OVER w AS pd, lag(arr) OVER w AS pa FROM clock
      WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id))"""


def _gaps(x, mode):
    lagged = t.entity_lag(x.clock, "user_id", ["sec"], ["event_id"], {"d": "pd", "arr": "pa"})
    gap = s.turnaround(F.col("d"), F.col("dep"), F.col("pd"), F.col("pa"), mode)
    return lagged.select("event_id", gap.cast("long").alias("gap"))


@query(
    "turnaround",
    CLOCK + _GAP.format(now="((dep // 100) * 60 + dep % 100)", before="((pa // 100) * 60 + pa % 100)", day=1440),
)
def _(x):
    return _gaps(x, "minutes")


@query("turnaround_hhmm", CLOCK + _GAP.format(now="dep", before="pa", day=2400))
def _(x):
    return _gaps(x, "hhmm")


@query(
    "lookup_bucket",
    EV + "SELECT event_id, CAST(epoch(date_trunc('hour', ts) - INTERVAL 2 HOUR) AS BIGINT) AS bucket_sec FROM ev",
)
def _(x):
    return x.ev.select("event_id", F.unix_timestamp(s.lookup_bucket(F.col("ts"))).alias("bucket_sec"))


@query(
    "date_shift",
    EV
    + """SELECT event_id, CAST(d + 1 AS VARCHAR) AS next_day, CAST(d - 1 AS VARCHAR) AS day_before,
  CAST(datediff('day', DATE '2024-01-01', d) AS INTEGER) AS days_in FROM ev""",
)
def _(x):
    return x.ev.select(
        "event_id",
        s.date_shift(F.col("d"), 1).cast("string").alias("next_day"),
        s.date_shift(F.col("d"), -1).cast("string").alias("day_before"),
        F.datediff("d", F.lit("2024-01-01").cast("date")).alias("days_in"),
    )


@query("to_epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events")
def _(x):
    return x.events.select("event_id", s.to_epoch_seconds(F.col("ts")).alias("sec"))


@query("indicator_flag", EV_NULL + "SELECT event_id, CASE WHEN value > 100 THEN 1 ELSE 0 END AS flag FROM ev_null")
def _(x):
    return x.ev_null.select("event_id", s.indicator_flag(F.col("value") > 100).alias("flag"))


_PARTS_SQL = """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
  CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(isodow(ts) AS INTEGER) AS iso_weekday,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events"""


@query("calendar_parts", _PARTS_SQL)
def _(x):
    parts = s.calendar_parts(F.col("ts"))
    parts["date"] = parts["date"].cast("string")
    return x.events.select("event_id", *(c.alias(n) for n, c in parts.items()))


@query(
    "calendar_flags",
    """SELECT o_orderkey, CASE WHEN isodow(o_orderdate) IN (6, 7) THEN 1 ELSE 0 END AS "IsWeekend",
  CASE WHEN o_orderkey % 24 BETWEEN 6 AND 22 THEN 1 ELSE 0 END AS "IsBusinessHours",
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
       WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS "SeasonQuarter",
  CASE WHEN month(o_orderdate) IN (11, 12, 1) THEN 1 ELSE 0 END AS "IsHolidayMonth" FROM orders""",
)
def _(x):
    parts = s.calendar_parts(F.col("o_orderdate"))
    hour = (F.col("o_orderkey") % 24).cast("int")  # order dates carry no clock
    flags = s.calendar_flags(parts["iso_weekday"], hour, parts["month"])
    return x.orders.select("o_orderkey", *(c.alias(n) for n, c in flags.items()))


BAND_SQL = """CASE WHEN h < 6 THEN '1.Early Morning' WHEN h < 12 THEN '2.Morning' WHEN h < 18 THEN '3.Afternoon'
  ELSE '4. Night' END"""


@query("time_band", EV + f"SELECT event_id, {BAND_SQL} AS band, h AS block_hour FROM ev")
def _(x):
    block = F.concat(F.lpad(F.col("h").cast("string"), 2, "0"), F.lit("00-"), F.lpad(F.col("h").cast("string"), 2, "0"), F.lit("59"))
    return x.ev.select("event_id", s.time_band(F.col("h")).alias("band"), s.block_hour(block).alias("block_hour"))


@query(
    "cyclic_encode",
    EV
    + f"""SELECT event_id, {q6("sin(2 * pi() * h / 24)")} AS hour_sin, {q6("cos(2 * pi() * h / 24)")} AS hour_cos,
  {q6("sin(2 * pi() * isodow(ts) / 7)")} AS weekday_sin, {q6("cos(2 * pi() * isodow(ts) / 7)")} AS weekday_cos FROM ev""",
)
def _(x):
    hour = s.cyclic_encode(F.col("h"), 24)
    weekday = s.cyclic_encode(s.calendar_parts(F.col("ts"))["iso_weekday"], 7)
    names = ["hour_sin", "hour_cos", "weekday_sin", "weekday_cos"]
    return x.ev.select("event_id", *(r6(c).alias(n) for c, n in zip((*hour, *weekday), names, strict=True)))


@query("log_transform", f"SELECT event_id, {q6('ln(1 + value)')} AS log_value FROM events")
def _(x):
    return x.events.select("event_id", r6(s.log_transform(F.col("value"))).alias("log_value"))


@query(
    "coalesce_greatest",
    EV_NULL
    + f"SELECT event_id, coalesce(value, CAST(0 AS DOUBLE)) AS filled, {q6('greatest(coalesce(value, 0) - 50, 0)')} AS excess FROM ev_null",
)
def _(x):
    filled = s.coalesce_zero(F.col("value"))
    return x.ev_null.select("event_id", filled.alias("filled"), r6(s.floor_at_zero(filled - 50)).alias("excess"))


@query(
    "string_concat_pad",
    EV + "SELECT event_id, lpad(CAST(h AS VARCHAR), 2, '0') || '-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS code, substr(event_type, 1, 3) AS short FROM ev",
)
def _(x):
    code = s.concat_pad((F.col("h"), 2), (F.col("user_id"), 6))
    return x.ev.select("event_id", code.alias("code"), F.substring("event_type", 1, 3).alias("short"))
