"""Window features on the events timeline and on orders per customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import q6, query, r6
from bindings.tables import with_views
from chronoweave.operators import temporal as t

EV = with_views("ev")
EV_NULL = with_views("ev_null")


@query(
    "entity_lag",
    EV_NULL
    + """SELECT event_id, lag(value) OVER w AS prev_value, lag(event_type) OVER w AS prev_type,
       lag(sec) OVER w AS prev_sec, lag(CAST(d AS VARCHAR)) OVER w AS prev_day, lag(h) OVER w AS prev_hour
FROM ev_null WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)
UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL FROM ev_null WHERE user_id IS NULL""",
)
def _(x):
    columns = {"value": "prev_value", "event_type": "prev_type", "sec": "prev_sec", "d": "prev_day", "h": "prev_hour"}
    rows = x.ev_null.withColumn("d", F.col("d").cast("string"))
    return t.entity_lag(rows, "user_id", ["sec"], ["event_id"], columns).select("event_id", *columns.values())


@query(
    "entity_lag_known",
    EV_NULL
    + """SELECT event_id, k.value AS known_value, k.sec AS known_sec FROM (
  SELECT e.event_id AS event_id, max_by(struct_pack(value := p.value, sec := p.sec), p.sec::HUGEINT * 10000000000 + p.event_id) AS k
  FROM ev_null e LEFT JOIN ev_null p ON e.user_id = p.user_id AND p.sec + 60 * p.h <= e.sec - 7200 GROUP BY e.event_id
)""",
)
def _(x):
    rows = x.ev_null.withColumn("known_at", F.col("sec") + 60 * F.col("h"))
    columns = {"value": "known_value", "sec": "known_sec"}
    return t.entity_lag_known(rows, "user_id", ["sec"], ["event_id"], columns, "sec", "known_at").select(
        "event_id", *columns.values()
    )


@query(
    "entity_lag_with_ties",
    with_views("li")
    + """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(epoch(l_shipdate) AS BIGINT) AS ship_sec,
       lag(l_quantity) OVER w AS prev_quantity, lag(l_returnflag) OVER w AS prev_flag
FROM li WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber, l_quantity,
                     l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)""",
)
def _(x):
    ties = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ties += ["l_returnflag", "l_linestatus"]
    lagged = t.entity_lag(
        x.lineitem, "l_suppkey", ["l_shipdate"], ties, {"l_quantity": "prev_quantity", "l_returnflag": "prev_flag"}
    )
    ship = F.unix_timestamp("l_shipdate").alias("ship_sec")
    return lagged.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", ship, "prev_quantity", "prev_flag")


@query(
    "first_event_flag",
    EV_NULL
    + """SELECT event_id, CASE WHEN user_id IS NOT NULL THEN
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) = 1 THEN 1 ELSE 0 END END AS is_first
FROM ev_null""",
)
def _(x):
    return t.first_event_flag(x.ev_null, "user_id", ["sec"], ["event_id"]).select("event_id", "is_first")


def trailing_count(x):
    """Large values and errors at the site in the two hours before each event."""
    flags = {"n_flagged": F.col("flag"), "n_early": (F.col("h") < 6).cast("int")}
    return t.trailing_count(x.ev, "event_type", "sec", flags).select("event_id", "event_type", "sec", *flags)


query(
    "trailing_count",
    EV
    + """SELECT event_id, event_type, sec,
       CAST(coalesce(sum(flag) OVER w, 0) AS BIGINT) AS n_flagged,
       CAST(coalesce(sum(CASE WHEN h < 6 THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS n_early
FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY sec RANGE BETWEEN 7200 PRECEDING AND 1 PRECEDING)""",
)(trailing_count)


@query(
    "trailing_count_strict_horizon",
    EV
    + """SELECT event_id, CAST(coalesce(sum(flag) OVER (PARTITION BY event_type ORDER BY sec
       RANGE BETWEEN 14400 PRECEDING AND 7200 PRECEDING), 0) AS BIGINT) AS n_flagged FROM ev""",
)
def _(x):
    counted = t.trailing_count(x.ev, "event_type", "sec", {"n_flagged": F.col("flag")}, horizon_s=7200, span_s=14400)
    return counted.select("event_id", "n_flagged")


@query(
    "trailing_mean",
    EV_NULL
    + f"""SELECT event_id, {q6("avg(value) OVER w")} AS mean_value, {q6("avg(flag) OVER w")} AS share_flagged
FROM ev_null WINDOW w AS (PARTITION BY event_type ORDER BY sec RANGE BETWEEN 7200 PRECEDING AND 1 PRECEDING)""",
)
def _(x):
    values = {"mean_value": F.col("value"), "share_flagged": F.col("flag").cast("double")}
    means = t.trailing_mean(x.ev_null, "event_type", "sec", values)
    return means.select("event_id", r6("mean_value").alias("mean_value"), r6("share_flagged").alias("share_flagged"))


ARRIVALS = """SELECT a.event_id, a.site, CAST(count(b.event_id) AS BIGINT) AS arrivals
FROM (SELECT event_id, user_id % 10 AS site, sec FROM ev WHERE event_type = 'click') a
LEFT JOIN (SELECT event_id, user_id % 10 AS site, sec FROM ev WHERE event_type = 'view') b
  ON a.site = b.site AND b.sec BETWEEN a.sec - 7200 AND a.sec
GROUP BY a.event_id, a.site"""


def _arrivals(x):
    sited = x.ev.withColumn("site", F.col("user_id") % 10)
    return sited.filter("event_type = 'click'"), sited.filter("event_type = 'view'")


@query("trailing_arrivals", EV + ARRIVALS)
def _(x):
    departures, arrivals = _arrivals(x)
    return t.trailing_arrivals(departures, arrivals, "site", "sec").select("event_id", "site", "arrivals")


@query("self_enrich_join", EV + ARRIVALS)
def _(x):
    """The same feature by computing it per distinct (site, second) and joining it back."""
    departures, arrivals = _arrivals(x)
    per_moment = t.trailing_arrivals(departures.select("site", "sec").distinct(), arrivals, "site", "sec")
    joined = departures.join(per_moment, ["site", "sec"], "left")
    return joined.select("event_id", "site", F.coalesce("arrivals", F.lit(0)).alias("arrivals"))


def _rate_sql(start: str, view="ev_null", entity="user_id", key="event_id", flag="flag") -> str:
    frame = f"(PARTITION BY {entity} ORDER BY sec RANGE BETWEEN {start} PRECEDING AND 7200 PRECEDING)"
    return f"""SELECT {key}, CASE WHEN {entity} IS NOT NULL AND count({flag}) OVER w >= 3
       THEN {q6(f"100 * avg({flag}) OVER w")} END AS rate
FROM {view} WINDOW w AS {frame}"""


@query("expanding_rate", EV_NULL + _rate_sql("UNBOUNDED"))
def _(x):
    return t.expanding_rate(x.ev_null, "user_id", "sec", F.col("flag")).select("event_id", r6("rate").alias("rate"))


@query("rolling_rate_14d", EV_NULL + _rate_sql("1209600"))
def _(x):
    return t.rolling_rate(x.ev_null, "user_id", "sec", F.col("flag"), 14).select("event_id", r6("rate").alias("rate"))


@query("rolling_rate_90d", EV_NULL + _rate_sql("7776000"))
def _(x):
    return t.rolling_rate(x.ev_null, "user_id", "sec", F.col("flag"), 90).select("event_id", r6("rate").alias("rate"))


ORDER_LINE = """WITH ol AS (SELECT *, CAST(epoch(o_orderdate) AS BIGINT) AS sec,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done FROM orders)
"""


def _orders(x):
    return x.orders.withColumns(
        {"sec": F.unix_timestamp("o_orderdate"), "done": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)}
    )


@query(
    "rolling_rate_90d_orders",
    ORDER_LINE + _rate_sql("7776000", view="ol", entity="o_custkey", key="o_orderkey", flag="done"),
)
def _(x):
    rated = t.rolling_rate(_orders(x), "o_custkey", "sec", F.col("done"), 90)
    return rated.select("o_orderkey", r6("rate").alias("rate"))


def _all_rates_sql() -> str:
    out = []
    for name, start in (("historical", "UNBOUNDED"), ("recent", "1209600"), ("short_term", "7776000")):
        frame = f"(PARTITION BY o_custkey ORDER BY sec RANGE BETWEEN {start} PRECEDING AND 7200 PRECEDING)"
        out += [
            f"CASE WHEN count({flag}) OVER {frame} >= 3 THEN {q6(f'100 * avg({flag}) OVER {frame}')} END AS {name}_{flag}_pct"
            for flag in ("done", "big")
        ]
    return (
        """WITH ol AS (SELECT *, CAST(epoch(o_orderdate) AS BIGINT) AS sec,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done,
  CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS big FROM orders)
SELECT o_orderkey, """
        + ",\n  ".join(out)
        + "\nFROM ol"
    )


def history_rates(x):
    """Six rates in one pass over each customer's orders."""
    orders = _orders(x).withColumn("big", F.when(F.col("o_totalprice") > 250000, 1).otherwise(0))
    rated = t.history_rates(orders, "o_custkey", "sec", {"done": F.col("done"), "big": F.col("big")})
    names = [f"{f}_{k}_pct" for f in t.HISTORY for k in ("done", "big")]
    return rated.select("o_orderkey", *(r6(n).alias(n) for n in names))


query("history_rates", _all_rates_sql())(history_rates)


@query(
    "min_support_gate",
    EV
    + f"""SELECT user_id, count(*) AS n, CASE WHEN count(*) >= 70 THEN {q6("avg(value)")} END AS gated_mean
FROM ev GROUP BY user_id""",
)
def _(x):
    counted = x.ev.groupBy("user_id").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    return counted.select("user_id", "n", r6(t.min_support_gate(F.col("mean"), F.col("n"), 70)).alias("gated_mean"))


@query(
    "legacy_alias",
    EV_NULL
    + f"""SELECT event_id, rate, rate AS old_rate FROM ({_rate_sql("UNBOUNDED")}) r""",
)
def _(x):
    rated = t.expanding_rate(x.ev_null, "user_id", "sec", F.col("flag")).select("event_id", r6("rate").alias("rate"))
    return t.legacy_alias(rated, {"old_rate": "rate"})


@query(
    "on_time_flag",
    EV_NULL
    + """SELECT event_id, CASE WHEN coalesce(value, 0) <= 15 THEN 1 ELSE 0 END AS on_time,
       CASE WHEN value IS NULL THEN NULL WHEN value <= 15 THEN 1 ELSE 0 END AS known_on_time FROM ev_null""",
)
def _(x):
    return x.ev_null.select(
        "event_id",
        t.on_time_flag(F.col("value")).alias("on_time"),
        t.on_time_flag(F.col("value"), skip_null=True).alias("known_on_time"),
    )
