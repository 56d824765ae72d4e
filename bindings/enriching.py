"""Lookup joins and point-in-time enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import q6, query, r6
from bindings.tables import LINE_COLUMNS, with_views
from chronoweave.functions import scalars as s
from chronoweave.operators import enrich as e
from chronoweave.operators import graph as g
from chronoweave.operators import metrics as m

LINE_LIST = ", ".join(LINE_COLUMNS)


@query(
    "broadcast_equi_join",
    "SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def _(x):
    nations = x.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    return e.broadcast_equi_join(x.customer, nations, ["c_nationkey"]).select("c_custkey", "n_name", "n_regionkey")


@query(
    "semi_join_keys",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def _(x):
    big = x.orders.filter("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    return e.semi_join_keys(x.customer, big, ["c_custkey"]).select("c_custkey", "c_acctbal")


@query(
    "anti_join_keys",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def _(x):
    big = x.orders.filter("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    return e.anti_join_keys(x.customer, big, ["c_custkey"]).select("c_custkey", "c_acctbal")


HOURLY = """hourly AS (
  SELECT station, site, hour_ts, avg(value) AS value, arg_min(props, (ts, event_id)) AS props
  FROM obs GROUP BY station, site, hour_ts)"""


def _hourly(x):
    return e.hourly_dedup_avg(x.obs, ["station", "site", "hour_ts"], ["value"], ["props"], ["ts", "event_id"])


@query(
    "hourly_dedup_avg",
    with_views("obs", extra=HOURLY)
    + f"SELECT station, CAST(epoch(hour_ts) AS BIGINT) AS hour_sec, {q6('value')} AS value, props FROM hourly",
)
def _(x):
    return _hourly(x).select("station", F.unix_timestamp("hour_ts").alias("hour_sec"), r6("value").alias("value"), "props")


NEAREST = """nearest AS (
  SELECT h.site, hour_ts, h.station, value, props FROM hourly h JOIN stations s ON h.station = s.station
  QUALIFY row_number() OVER (PARTITION BY h.site, hour_ts ORDER BY distance, h.station) = 1)"""


def _nearest(x):
    readings = _hourly(x).drop("site")
    return e.nearest_station_lookup(readings, x.stations, "station", ["site", "hour_ts"], "distance", ["value", "props"])


@query(
    "nearest_station_lookup",
    with_views("obs", "stations", extra=HOURLY + ",\n" + NEAREST)
    + f"SELECT site, CAST(epoch(hour_ts) AS BIGINT) AS hour_sec, station, {q6('value')} AS value, props FROM nearest",
)
def _(x):
    return _nearest(x).select("site", F.unix_timestamp("hour_ts").alias("hour_sec"), "station", r6("value").alias("value"), "props")


@query(
    "nearest_reading",
    with_views("obs", "stations", extra=HOURLY + ",\n" + NEAREST)
    + f"""SELECT site, CAST(epoch(hour_ts) AS BIGINT) AS hour_sec, station, {q6('value')} AS value, props FROM nearest
WHERE (site, hour_ts) IN (SELECT (user_id % 10, date_trunc('hour', ts) - INTERVAL 2 HOUR) FROM ev WHERE event_type = 'purchase')""",
)
def _(x):
    """The same choice for the pairs purchases ask for, trying stations ring by ring."""
    purchases = x.ev.filter("event_type = 'purchase'")
    wanted = purchases.select((F.col("user_id") % 10).alias("site"), s.lookup_bucket(F.col("ts")).alias("hour_ts"))
    readings = _hourly(x).drop("site")
    found = e.nearest_reading(
        wanted, readings, x.stations, "station", "site", "hour_ts", "distance", ["value", "props"], first=8, max_fan_out=0
    )
    return found.select("site", F.unix_timestamp("hour_ts").alias("hour_sec"), "station", r6("value").alias("value"), "props")


def bucket_lookup(x):
    """Purchases with the reading of the site's nearest station two hours earlier."""
    purchases = x.ev.filter("event_type = 'purchase'").withColumn("site", F.col("user_id") % 10)
    bucket = s.lookup_bucket(F.col("ts"))
    lookup = _nearest(x).withColumnsRenamed({"value": "seen", "props": "seen_props"})
    joined = e.bucket_lookup_join(purchases, lookup, {"site": "site"}, bucket, "hour_ts")
    return joined.select("event_id", "site", "station", r6("seen").alias("seen"), "seen_props")


query(
    "bucket_lookup_join",
    with_views("obs", "stations", extra=HOURLY + ",\n" + NEAREST)
    + f"""SELECT p.event_id, p.user_id % 10 AS site, n.station, {q6('n.value')} AS seen, n.props AS seen_props
FROM ev p LEFT JOIN nearest n ON p.user_id % 10 = n.site AND date_trunc('hour', p.ts) - INTERVAL 2 HOUR = n.hour_ts
WHERE p.event_type = 'purchase'""",
)(bucket_lookup)


@query(
    "bucket_lookup_join_by_type",
    with_views("ev", extra="""errors AS (SELECT date_trunc('hour', ts) AS hour_ts, avg(value) AS value FROM ev
  WHERE event_type = 'error' GROUP BY 1)""")
    + f"""SELECT p.event_id, {q6('e.value')} AS error_value FROM ev p
LEFT JOIN errors e ON date_trunc('hour', p.ts) - INTERVAL 2 HOUR = e.hour_ts WHERE p.event_type = 'purchase'""",
)
def _(x):
    errors = x.ev.filter("event_type = 'error'").groupBy(F.date_trunc("HOUR", "ts").alias("hour_ts"))
    hourly = errors.agg(F.avg("value").alias("error_value"))
    purchases = x.ev.filter("event_type = 'purchase'")
    joined = e.bucket_lookup_join(purchases, hourly, {}, s.lookup_bucket(F.col("ts")), "hour_ts")
    return joined.select("event_id", r6("error_value").alias("error_value"))


PAIRED = f"""paired AS (SELECT {LINE_LIST}, label, pred_a, pred_b FROM preds)"""


def paired(x):
    keys = LINE_COLUMNS
    first = x.preds.select(*keys, "label", "pred_a")
    second = x.preds.select(*keys, "pred_b")
    return e.prediction_join([first, second], keys)


SHORT = "l_orderkey, l_partkey, l_suppkey, l_linenumber, label, pred_a, pred_b"


@query("prediction_join", with_views("preds") + f"SELECT {SHORT} FROM preds")
def _(x):
    return paired(x).select(*SHORT.split(", "))


@query(
    "ensemble_vote",
    with_views("preds")
    + """SELECT label, pred_a, pred_b,
  CASE WHEN pred_a + pred_b >= 1 THEN CAST(1 AS DOUBLE) ELSE 0 END AS vote_any,
  CASE WHEN pred_a + pred_b >= 2 THEN CAST(1 AS DOUBLE) ELSE 0 END AS vote_majority,
  CASE WHEN pred_a + pred_b >= 2 THEN CAST(1 AS DOUBLE) ELSE 0 END AS vote_all,
  CASE WHEN pred_a + pred_b >= 1 THEN CAST(1 AS DOUBLE) ELSE 0 END AS vote_half, count(*) AS n
FROM preds GROUP BY ALL""",
)
def _(x):
    votes = [F.col("pred_a"), F.col("pred_b")]
    voted = paired(x).select(
        "label", "pred_a", "pred_b",
        *(m.ensemble_vote(votes, rule).alias(f"vote_{rule}") for rule in ("any", "majority", "all")),
        m.threshold_vote(votes).alias("vote_half"),
    )
    return voted.groupBy(*voted.columns).agg(F.count("*").alias("n"))


FREQ = "FROM documents d LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) c ON d.source = c.source"


@query("frequency_join", f"SELECT doc_id, d.source, n AS source_n {FREQ}")
def _(x):
    return e.frequency_join(x.documents.select("doc_id", "source"), "source", "source_n")


DEGREE = """deg AS (SELECT id, CAST(sum(i) AS BIGINT) AS i, CAST(sum(o) AS BIGINT) AS o FROM (
  SELECT src AS id, 0 AS i, 1 AS o FROM nat UNION ALL SELECT dst, 1, 0 FROM nat) GROUP BY id),
n AS (SELECT count(*) AS n FROM deg)"""


@query(
    "attach_vertex_feature",
    with_views("nat", extra=DEGREE)
    + f"""SELECT c_custkey, {q6('(i + o) / CAST(n - 1 AS DOUBLE)')} AS nation_degree
FROM customer LEFT JOIN (SELECT * FROM deg, n) ON c_nationkey = id""",
)
def _(x):
    scores = g.degree_centrality(x.nat)
    attached = e.attach_vertex_feature(
        x.customer.withColumn("nation", F.col("c_nationkey").cast("long")), scores, "id", "nation", "centrality", "nation_degree"
    )
    return attached.select("c_custkey", r6("nation_degree").alias("nation_degree"))


@query(
    "dict_lookup_join",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS status_code FROM orders""",
)
def _(x):
    coded = e.dict_lookup_join(x.orders, {"F": 1, "O": 2}, "o_orderstatus", "status_code", default=0)
    return coded.select("o_orderkey", F.col("status_code").cast("int").alias("status_code"))
