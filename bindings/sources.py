"""Readers, writers, stages and set operations."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bindings.registry import q6, query, r6
from bindings.tables import LINE_COLUMNS, NUMERICS, with_views
from chronoweave.functions import scalars as s
from chronoweave.operators import clean
from chronoweave.operators import graph as g
from chronoweave.operators import metrics as m
from chronoweave.operators.models import model_table
from chronoweave.operators.prep import prep_pipeline
from chronoweave.scratch import scratch_root
from chronoweave.sources import scan
from chronoweave.sources.stages import ModelStore, StageStore

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _folder(x) -> str:
    return f"{scratch_root(x.spark).rstrip('/')}/sink-{uuid.uuid4().hex}"


@query(
    "scan_parquet",
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES),
)
def _(x):
    counts = [x.read(t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t in TABLES]
    return scan.merge_parts(counts)


@query(
    "table_shape",
    "SELECT 'lineitem' AS table_name, count(*) AS n_rows, 11 AS n_columns FROM lineitem\n"
    "UNION ALL SELECT 'events', count(*), 6 FROM events",
)
def _(x):
    rows = [(t, *clean.table_shape(x.read(t))) for t in ("lineitem", "events")]
    return x.spark.createDataFrame(rows, "table_name string, n_rows long, n_columns int")


_TYPES = {"l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
_TYPES |= {c: "bigint" for c in ("l_orderkey", "l_partkey", "l_suppkey")} | {c: "double" for c in NUMERICS}


@query(
    "schema_report",
    "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS name, '{_TYPES[c]}' AS type, count({c}) AS present FROM lineitem"
        for i, c in enumerate(LINE_COLUMNS, 1)
    ),
)
def _(x):
    present = x.lineitem.agg(*(F.count(c).alias(c) for c in LINE_COLUMNS)).unpivot([], LINE_COLUMNS, "name", "present")
    return clean.schema_report(x.lineitem).join(F.broadcast(present), "name")  # one row per column


EDGES = "SELECT src, dst, weight FROM nat"


@query("scan_adjacency", with_views("nat") + EDGES)
def _(x):
    folder = _folder(x)
    g.adjacency_lines(x.nat).write.text(folder)
    return scan.scan_adjacency(x.spark, folder)


@query("parse_map_literal", with_views("nat") + "SELECT src, count(*) AS links, CAST(sum(weight) AS BIGINT) AS weight FROM nat GROUP BY src")
def _(x):
    parts = F.split("value", "\t")
    parsed = g.adjacency_lines(x.nat).select(parts[0].cast("long").alias("src"), s.parse_map_literal(parts[1]).alias("links"))
    total = F.aggregate(F.map_values("links"), F.lit(0).cast("long"), lambda acc, w: acc + w)
    return parsed.select("src", F.size(F.map_keys("links")).cast("long").alias("links"), total.alias("weight"))


@query(
    "expand_multiplicity",
    with_views("trans") + "SELECT src, dst FROM trans, LATERAL (SELECT unnest(range(weight))) r",
)
def _(x):
    return clean.expand_rows(x.trans, F.col("weight"), block=100).select("src", "dst")


SHIPPED = f"""SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS y, count(*) AS n,
  {q6("sum(l_quantity)")} AS quantity FROM lineitem GROUP BY ALL"""


def _shipped(df):
    return df.groupBy("l_returnflag", "y").agg(F.count("*").alias("n"), r6(F.sum("l_quantity")).alias("quantity"))


@query("sink_parquet", SHIPPED)
def _(x):
    folder = _folder(x)
    scan.sink_parquet(x.li, folder, partition_by=["y"])
    return _shipped(scan.scan_parquet(x.spark, folder))


@query("sink_parquet_repartitioned", SHIPPED)
def _(x):
    folder = _folder(x)
    scan.sink_parquet(x.li, folder, files=16)
    return _shipped(scan.scan_parquet(x.spark, folder))


@query(
    "stage_store",
    "SELECT 'orders_stage' AS stage, true AS present, count(*) AS saved_rows, 6 AS saved_columns, count(*) AS loaded FROM orders",
)
def _(x):
    store = StageStore(x.spark, _folder(x))
    rows, columns = store.save(x.orders, "orders_stage")
    loaded = store.load("orders_stage").agg(F.count("*").alias("loaded"))
    found = F.lit(store.exists("orders_stage") and not store.exists("orders_stage", "2"))
    return loaded.select(
        F.lit(store.list()[0]).alias("stage"), found.alias("present"), F.lit(rows).cast("long").alias("saved_rows"),
        F.lit(columns).alias("saved_columns"), "loaded",
    )


@query("stage_or_compute", SHIPPED)
def _(x):
    store = StageStore(x.spark, _folder(x))
    store.stage("lines", lambda: x.li, version="a")
    # The second call must find the first one's rows and not build again.
    return _shipped(store.stage("lines", lambda: x.li.limit(0), version="a"))


@query("merge_yearly_stages", SHIPPED)
def _(x):
    store = StageStore(x.spark, _folder(x))
    years = [r["y"] for r in x.li.select("y").distinct().collect()]  # one row per year
    for year in years:
        store.save(x.li.filter(F.col("y") == year), f"lines_{year}")
    return _shipped(store.merge([f"lines_{y}" for y in years], "lines"))


@query("union_by_name", SHIPPED)
def _(x):
    early, late = x.li.filter("y < 1998"), x.li.filter("y >= 1998")
    return _shipped(clean.union_by_name([early, late.select(*reversed(late.columns))]))


@query("union_all", SHIPPED)
def _(x):
    return _shipped(clean.union_all([x.li.filter("y < 1998"), x.li.filter("y >= 1998")]))


@query(
    "model_store",
    with_views("li", extra="b AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM li)")
    + f"""SELECT y AS block, CAST(label AS DOUBLE) AS label, count(*) AS n, {q6('avg((l_quantity - lo) / (hi - lo))')} AS quantity
FROM li, b GROUP BY y, label""",
)
def _(x):
    """Save a fitted preparation pipeline, load it and apply it."""
    store = ModelStore(x.spark, _folder(x))
    store.save(prep_pipeline(NUMERICS).fit(x.li), "prep")
    scaled = model_table(store.load("prep").transform(x.li), ["scaled_features"], "label", period="y")
    quantity = r6(F.avg(vector_to_array("features")[0])).alias("quantity")
    return scaled.groupBy("block", "label").agg(F.count("*").alias("n"), quantity)


@query(
    "metrics_table",
    """SELECT 'run1' AS run, 'metric' AS kind, 'rows' AS name, CAST(NULL AS VARCHAR) AS text, CAST(count(*) AS DOUBLE) AS value FROM orders
UNION ALL SELECT 'run1', 'param', 'table', 'orders', NULL
UNION ALL SELECT 'run2', 'metric', 'rows', NULL, CAST(count(*) AS DOUBLE) FROM customer
UNION ALL SELECT 'run2', 'param', 'table', 'customer', NULL""",
)
def _(x):
    folder = _folder(x)
    for run, table in (("run1", "orders"), ("run2", "customer")):
        m.log_metrics(x.spark, folder, run, {"table": table}, {"rows": x.read(table).count()})
    return m.metrics_table(x.spark, folder)


@query(
    "dev_slice",
    """WITH mine AS (SELECT * FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders))
SELECT o_orderkey, o_custkey, o_totalprice FROM mine
WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', min(o_orderdate)) FROM mine)""",
)
def _(x):
    return clean.dev_slice(x.orders, "o_custkey", "o_orderdate").select("o_orderkey", "o_custkey", "o_totalprice")


@query("first_distinct", "SELECT min(c_name) AS first_name, count(*) AS n FROM customer WHERE c_name <> ''")
def _(x):
    first = clean.first_distinct(x.customer, "c_name")
    return x.customer.filter("c_name <> ''").agg(F.lit(first).alias("first_name"), F.count("*").alias("n"))
