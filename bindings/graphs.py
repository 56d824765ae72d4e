"""Graph analytics on nation, web and transition graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.enriching import DEGREE
from bindings.registry import q6, query, r6
from bindings.tables import with_views
from chronoweave.operators import clean
from chronoweave.operators import graph as g

WEB, NAT, TRANS = (with_views(v) for v in ("web", "nat", "trans"))
NODES = "SELECT src AS id FROM {0} UNION SELECT dst FROM {0}"


@query("node_count", WEB + f"SELECT count(*) AS nodes FROM ({NODES.format('web')})")
def _(x):
    return g.node_count(x.web)


@query("dangling_nodes", WEB + "SELECT DISTINCT dst AS id FROM web WHERE dst NOT IN (SELECT src FROM web)")
def _(x):
    return g.dangling_nodes(x.web)


@query("out_degree", WEB + "SELECT src, count(DISTINCT dst) AS degree FROM web GROUP BY src")
def _(x):
    return g.out_degree(x.web)


@query(
    "out_degree_summary",
    WEB
    + f"""SELECT {q6('avg(degree)')} AS avg_degree, count(*) AS nodes FROM
  (SELECT src, count(DISTINCT dst) AS degree FROM web GROUP BY src)""",
)
def _(x):
    return g.out_degree_summary(x.web).withColumn("avg_degree", r6("avg_degree"))


@query(
    "out_degree_top",
    WEB + "SELECT src, count(DISTINCT dst) AS degree FROM web GROUP BY src ORDER BY degree DESC, src LIMIT 10",
)
def _(x):
    return clean.top_k(g.out_degree(x.web), "degree", "src", 10)


@query("route_graph", "SELECT DISTINCT o_custkey AS src, o_orderpriority AS dst FROM orders")
def _(x):
    return g.route_graph(x.orders, "o_custkey", "o_orderpriority")


INIT = f"""nodes AS ({NODES.format('web')}), n AS (SELECT count(*) AS n FROM nodes)"""


@query(
    "init_graph",
    with_views("web", extra=INIT)
    + f"""SELECT id, {q6('1 / CAST(n AS DOUBLE)')} AS rank, id NOT IN (SELECT src FROM web) AS dangling FROM nodes, n""",
)
def _(x):
    return g.initial_ranks(g.init_graph(x.web)).select("id", r6("rank").alias("rank"), "dangling")


#: Fixed values of events' types.
STATES = ("click", "error", "purchase", "signup", "view")


@query(
    "adjacency_matrix",
    TRANS
    + "SELECT src AS id, "
    + ", ".join(
        f"CAST(max(CASE WHEN dst = '{k}' THEN 1 ELSE 0 END) AS INTEGER) AS \"{k}\""
        for k in STATES
    )
    + " FROM trans GROUP BY src",
)
def _(x):
    return g.adjacency_matrix(x.trans, STATES)


@query("adjacency_matrix_sparse", TRANS + "SELECT DISTINCT src AS id, dst AS other, 1 AS link FROM trans")
def _(x):
    return g.adjacency_matrix(x.trans)


@query(
    "adjacency_list",
    with_views("nat", extra=f"nodes AS ({NODES.format('nat')})")
    + """SELECT id, 0 AS part, coalesce(string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst), '') AS neighbours
FROM nodes LEFT JOIN nat ON id = src GROUP BY id""",
)
def _(x):
    return g.adjacency_list(x.nat).withColumn("neighbours", F.array_join("neighbours", ","))


SHARES = "shares AS MATERIALIZED (SELECT src, dst, weight / CAST(sum(weight) OVER (PARTITION BY src) AS DOUBLE) AS share FROM {0})"


@query("transition_matrix", with_views("trans", extra=SHARES.format("trans")) + f"SELECT src, dst, {q6('share')} AS share FROM shares")
def _(x):
    return g.transition_matrix(x.trans).withColumn("share", r6("share"))


def _walk_sql(view: str, steps: int) -> str:
    parts = [
        SHARES.format(view),
        f"nodes AS MATERIALIZED ({NODES.format(view)})",
        "x0 AS MATERIALIZED (SELECT id, 1 / CAST((SELECT count(*) FROM nodes) AS DOUBLE) AS p FROM nodes)",
    ]
    for k in range(1, steps + 1):
        parts.append(
            f"x{k} AS MATERIALIZED (SELECT n.id, coalesce(sum(p * share), 0) AS p FROM nodes n "
            f"LEFT JOIN shares ON dst = n.id LEFT JOIN x{k - 1} x ON x.id = src GROUP BY n.id)"
        )
    return with_views(view, extra=",\n".join(parts))


@query("markov_steady_state", _walk_sql("trans", 10) + f"SELECT id, {q6('p')} AS p FROM x10")
def _(x):
    return g.markov_steady_state(x.trans, steps=10, atol=None).withColumn("p", r6("p"))


@query("markov_steady_state_doubling", _walk_sql("trans", 8) + f"SELECT id, {q6('p')} AS p FROM x8")
def _(x):
    """Three squarings are eight plain steps."""
    return g.markov_steady_state(x.trans, steps=3, doubling=True).withColumn("p", r6("p"))


@query(
    "mass_leak_report",
    _walk_sql("web", 10)
    + "\nUNION ALL ".join(f"SELECT {k} AS step, {q6('sum(p)')} AS mass FROM x{k}" for k in range(11)),
)
def _(x):
    return g.mass_leak_report(x.web, steps=10).withColumn("mass", r6("mass"))


def _rank_sql(view: str, iterations: int, alpha: float = 0.15) -> str:
    parts = [
        SHARES.format(view),
        f"""nodes AS MATERIALIZED (SELECT id, NOT EXISTS (SELECT 1 FROM shares WHERE src = id) AS dangling
  FROM ({NODES.format(view)}))""",
        "n AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)",
        "r0 AS MATERIALIZED (SELECT id, dangling, 1 / n AS rank FROM nodes, n)",
    ]
    a, d = f"CAST({alpha} AS DOUBLE)", f"CAST({1 - alpha} AS DOUBLE)"
    for k in range(1, iterations + 1):
        parts.append(
            f"r{k} AS MATERIALIZED (SELECT r.id, r.dangling, {a} / n + {d} * ((SELECT coalesce(sum(rank), 0) FROM r{k - 1} "
            f"WHERE dangling) / n + coalesce(c.c, 0)) AS rank FROM r{k - 1} r CROSS JOIN n LEFT JOIN "
            f"(SELECT dst, sum(rank * share) AS c FROM shares JOIN r{k - 1} ON src = id GROUP BY dst) c ON c.dst = r.id)"
        )
    return with_views(view, extra=",\n".join(parts))


def _r10(column: str):
    return (F.round(column, 10) + F.lit(0.0)).alias(column)


@query("pagerank", _rank_sql("nat", 10) + "SELECT id, round(rank, 10) AS rank FROM r10")
def _(x):
    return g.pagerank(x.nat).select("id", _r10("rank"))


@query("pagerank_web", _rank_sql("web", 10) + "SELECT id, round(rank, 10) AS rank FROM r10")
def _(x):
    return g.pagerank(x.web).select("id", _r10("rank"))


@query(
    "graph_outer_join",
    _rank_sql("web", 1) + "SELECT id, round(rank, 10) AS rank FROM r1",
)
def _(x):
    """One iteration by hand: all vertices with what they received, 0 where nothing arrived."""
    graph = g.init_graph(x.web)
    ranks = g.initial_ranks(graph)
    shares = g.transition_matrix(x.web).withColumnRenamed("src", "id")
    received = ranks.join(shares, "id").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("received"))
    hanging = ranks.filter("dangling").agg(F.sum("rank")).first()[0] or 0.0
    base = (0.15 + 0.85 * hanging) / graph.size
    joined = g.graph_outer_join(ranks.select("id"), received)
    return joined.select("id", (F.lit(base) + 0.85 * F.col("received")).alias("rank")).select("id", _r10("rank"))


@query(
    "pagerank_trace",
    _rank_sql("web", 10)
    + "\nUNION ALL ".join(
        f"""SELECT {k} AS step, {q6(f'(SELECT sum(rank) FROM r{k})')} AS total_mass,
  {q6(f'(SELECT coalesce(sum(rank), 0) FROM r{k - 1} WHERE dangling)')} AS dangling_mass"""
        for k in range(1, 11)
    ),
)
def _(x):
    found = g.pagerank_trace(x.web, iterations=10)
    return found.select("step", r6("total_mass").alias("total_mass"), r6("dangling_mass").alias("dangling_mass"))


@query(
    "degree_centrality",
    with_views("nat", extra=DEGREE)
    + f"""SELECT id, {q6('i / CAST(n - 1 AS DOUBLE)')} AS in_centrality, {q6('o / CAST(n - 1 AS DOUBLE)')} AS out_centrality,
  {q6('(i + o) / CAST(n - 1 AS DOUBLE)')} AS centrality FROM deg, n""",
)
def _(x):
    found = g.degree_centrality(x.nat)
    return found.select("id", *(r6(c).alias(c) for c in ("in_centrality", "out_centrality", "centrality")))


_PATHS = f"""nodes AS (SELECT DISTINCT id FROM ({NODES.format('hops')})),
walks AS (
  SELECT id AS s, id AS v, 0 AS dist, CAST(1 AS DOUBLE) AS sigma FROM nodes
  UNION ALL
  SELECT w.s, e.dst, w.dist + 1, sum(w.sigma) FROM walks w JOIN hops e ON e.src = w.v WHERE w.dist < 12 AND e.src <> e.dst
  GROUP BY w.s, e.dst, w.dist + 1),
near AS MATERIALIZED (SELECT s, v, dist, sigma FROM walks QUALIFY dist = min(dist) OVER (PARTITION BY s, v)),
through AS (
  SELECT a.v AS id, sum(a.sigma * b.sigma / st.sigma) AS score FROM near a JOIN near b ON a.v = b.s
  JOIN near st ON st.s = a.s AND st.v = b.v AND st.dist = a.dist + b.dist
  WHERE a.s <> a.v AND b.v <> a.v AND a.s <> b.v GROUP BY a.v)"""


@query(
    "betweenness_centrality",
    with_views("hops", extra=_PATHS, recursive=True)
    + f"""SELECT nodes.id, {q6('coalesce(score, 0) / ((SELECT count(*) FROM nodes) - 1) / ((SELECT count(*) FROM nodes) - 2)')} AS betweenness
FROM nodes LEFT JOIN through ON nodes.id = through.id""",
)
def _(x):
    return g.betweenness_centrality(x.hops).withColumn("betweenness", r6("betweenness"))
