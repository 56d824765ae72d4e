"""The driver's tables and the views derived from them, in Spark and as SQL common table expressions."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.scalars import to_epoch_seconds
from chronoweave.operators.graph import weighted_edges
from chronoweave.operators.temporal import entity_lag
from chronoweave.sources.scan import scan_parquet

#: Row key of the model table; the order key alone repeats.
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_COLUMNS = [*LINE_KEYS, *NUMERICS, "l_returnflag", "l_linestatus", "l_shipdate"]
HREF = 'href="([^"]+)"'


class Tables:
    """Readers for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return scan_parquet(self.spark, f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def ev(self) -> DataFrame:
        return self.events.select(
            "*",
            to_epoch_seconds(F.col("ts")).alias("sec"),
            F.to_date("ts").alias("d"),
            F.hour("ts").alias("h"),
            F.when(F.col("value") > 100, 1).otherwise(0).alias("flag"),
        )

    @cached_property
    def ev_null(self) -> DataFrame:
        return self.ev.withColumns(
            {
                "value": F.when(F.col("event_id") % 7 != 0, F.col("value")),
                "user_id": F.when(F.col("event_id") % 50 != 0, F.col("user_id")),
            }
        )

    @cached_property
    def ev_dup(self) -> DataFrame:
        return self.ev.unionByName(self.ev.filter("event_id % 10 = 0"))

    @cached_property
    def clock(self) -> DataFrame:
        minute = F.minute("ts")
        late = F.when(F.col("event_id") % 97 == 0, 2400).otherwise(100 * ((F.col("h") + 3) % 24) + minute)
        return self.ev.select("*", (100 * F.col("h") + minute).alias("dep"), late.alias("arr"))

    @cached_property
    def obs(self) -> DataFrame:
        return self.ev.filter("event_type = 'error'").select(
            F.col("user_id").alias("station"),
            (F.col("user_id") % 10).alias("site"),
            F.date_trunc("HOUR", "ts").alias("hour_ts"),
            "ts",
            "event_id",
            "value",
            "props",
        )

    @cached_property
    def stations(self) -> DataFrame:
        """Station map: each station reports for one site at a distance."""
        users = self.events.filter("event_type = 'error'").select(F.col("user_id").alias("station")).distinct()
        return users.select("station", (F.col("station") % 10).alias("site"), (F.col("station") * 7 % 11).alias("distance"))

    @cached_property
    def li(self) -> DataFrame:
        return self.lineitem.select(
            "*",
            F.year("l_shipdate").alias("y"),
            F.month("l_shipdate").alias("m"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
            ((F.col("l_quantity") + 10 * F.col("l_tax")) / 60).alias("score"),
        )

    @cached_property
    def preds(self) -> DataFrame:
        """Two rule-based predictions per line, keyed by all columns of the line."""
        return self.li.select(
            *LINE_COLUMNS,
            "y",
            "label",
            F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0).alias("pred_a"),
            F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("pred_b"),
        )

    @cached_property
    def nat(self) -> DataFrame:
        """Customer nation to supplier nation, weighted by lines."""
        # Merging lines per (customer, supplier) before the nation lookups keeps the joins small.
        lines = self.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
        bought = lines.join(self.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        pairs = bought.groupBy("o_custkey", "l_suppkey").agg(F.count("*").alias("lines"))
        cust = self.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("a"))
        supp = self.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("b"))
        return weighted_edges(pairs.join(cust, "o_custkey").join(supp, "l_suppkey"), "a", "b", F.col("lines"))

    @cached_property
    def trans(self) -> DataFrame:
        """Event type to the user's next event type."""
        steps = entity_lag(self.ev, "user_id", ["sec"], ["event_id"], {"event_type": "src"})
        return weighted_edges(steps.filter("src IS NOT NULL"), "src", "event_type")

    @cached_property
    def hops(self) -> DataFrame:
        """Event type and hour to the user's next event type and hour, from all events."""
        states = self.ev.withColumn("dst", F.concat_ws("-", "event_type", "h"))
        steps = entity_lag(states, "user_id", ["sec"], ["event_id"], {"dst": "src"})
        return weighted_edges(steps.filter("src IS NOT NULL"), "src", "dst")

    @cached_property
    def web(self) -> DataFrame:
        """Page to link target."""
        links = F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)))
        found = self.pages.select(F.concat(F.lit("page:"), "page_id").alias("src"), links.alias("dst"))
        return weighted_edges(found, "src", "dst")


_VIEWS = {
    "ev": """ev AS (
  SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h,
         CASE WHEN value > 100 THEN 1 ELSE 0 END AS flag
  FROM events)""",
    "ev_null": """ev_null AS (
  SELECT event_id, ts, CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id, event_type,
         CASE WHEN event_id % 7 <> 0 THEN value END AS value, props, sec, d, h, flag
  FROM ev)""",
    "ev_dup": """ev_dup AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 10 = 0)""",
    "clock": """clock AS (
  SELECT *, CAST(100 * h + minute(ts) AS INTEGER) AS dep,
         CAST(CASE WHEN event_id % 97 = 0 THEN 2400 ELSE 100 * ((h + 3) % 24) + minute(ts) END AS INTEGER) AS arr
  FROM ev)""",
    "obs": """obs AS (
  SELECT user_id AS station, user_id % 10 AS site, date_trunc('hour', ts) AS hour_ts, ts, event_id, value, props
  FROM ev WHERE event_type = 'error')""",
    "stations": """stations AS (
  SELECT DISTINCT user_id AS station, user_id % 10 AS site, user_id * 7 % 11 AS distance
  FROM events WHERE event_type = 'error')""",
    "li": """li AS (
  SELECT *, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, (l_quantity + 10 * l_tax) / 60 AS score
  FROM lineitem)""",
    "preds": """preds AS (
  SELECT *, CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN CAST(1 AS DOUBLE) ELSE 0 END AS pred_a,
         CASE WHEN l_quantity > 25 THEN CAST(1 AS DOUBLE) ELSE 0 END AS pred_b
  FROM li)""",
    "nat": """nat AS (
  SELECT CAST(c_nationkey AS BIGINT) AS src, CAST(s_nationkey AS BIGINT) AS dst, count(*) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL)""",
    "trans": """trans AS (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS src, event_type AS dst FROM ev)
  WHERE src IS NOT NULL GROUP BY ALL)""",
    "hops": """hops AS (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT lag(event_type || '-' || h) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS src, event_type || '-' || h AS dst FROM ev)
  WHERE src IS NOT NULL GROUP BY ALL)""",
    "web": f"""web AS (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT 'page:' || page_id AS src, unnest(regexp_extract_all(html, '{HREF}', 1)) AS dst FROM pages)
  GROUP BY ALL)""",
}
_NEEDS = {
    "ev_null": ["ev"], "ev_dup": ["ev"], "clock": ["ev"], "obs": ["ev"], "preds": ["li"], "trans": ["ev"], "hops": ["ev"],
}


def with_views(*names: str, extra: str = "", recursive: bool = False) -> str:
    """``WITH`` clause for the named views, what they build on, and any further expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [_VIEWS[n] for n in ordered] + ([extra] if extra else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


def hash_sql(*keys: str) -> str:
    """SQL twin of ``key_hash``."""
    folded = "CAST(0 AS BIGINT)"
    for key in keys:
        folded = f"(({folded} * 1000003 + CAST({key} AS BIGINT) % 2147483648) % 2147483648)"
    return f"({folded} * 2654435761 % 4294967296)"
