"""Graph analytics on an edge table ``(src, dst, weight)``.

Iterations write the vertex table of each step to the shared checkpoint folder, so lineage stays
one step long and scalars of a step (masses, largest change) are read from written rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.scalars import key_hash
from chronoweave.ordering import positions
from chronoweave.scratch import ScratchTable, write_scratch
from chronoweave.skew import small_side

#: Links of one vertex kept together; a vertex with more is cut into parts.
MAX_LINKS = 1_000_000
#: Plain steps that stand for squares of a large transition table, at most.
MOST_STEPS = 4_096
#: Pairs of a source and a vertex that one batch of sources may reach.
BATCH_PAIRS = 50_000_000


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Every vertex that occurs at either end of an edge."""
    return edges.select(F.col("src").alias("id")).union(edges.select("dst")).dropna().distinct()


def node_count(edges: DataFrame) -> DataFrame:
    return graph_nodes(edges).agg(F.count("*").alias("nodes"))


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """Vertices without outgoing edges."""
    targets = edges.select(F.col("dst").alias("id")).dropna().distinct()
    return targets.join(edges.select(F.col("src").alias("id")), "id", "left_anti")


def out_degree(edges: DataFrame) -> DataFrame:
    """Distinct neighbours per vertex that has any; repeated edges count once."""
    return edges.select("src", "dst").distinct().groupBy("src").agg(F.count("*").alias("degree"))


def out_degree_summary(edges: DataFrame) -> DataFrame:
    """Average out-degree and the number of vertices it is taken over."""
    return out_degree(edges).agg(F.avg("degree").alias("avg_degree"), F.count("*").alias("nodes"))


def sample_degrees(edges: DataFrame, n: int) -> DataFrame:
    """Degrees of ``n`` vertices chosen by key hash."""
    return out_degree(edges).orderBy(key_hash(F.col("src")), "src").limit(n)


def route_graph(df: DataFrame, origin: str, target: str) -> DataFrame:
    """Distinct routes with both ends known."""
    return df.select(F.col(origin).alias("src"), F.col(target).alias("dst")).dropna().distinct()


def weighted_edges(df: DataFrame, src: str, dst: str, weight: Column | None = None) -> DataFrame:
    """Merge repeated edges into weights."""
    total = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(total.alias("weight"))


def adjacency_matrix(edges: DataFrame, columns: Sequence | None = None) -> DataFrame:
    """0/1 matrix of the graph: its cells that hold 1, as (id, other, link).

    With ``columns``, ids chosen by the caller, one row per vertex and a 0/1 column for each of them.
    """
    if columns is None:
        cells = edges.select(F.col("src").alias("id"), F.col("dst").alias("other")).dropna().distinct()
        return cells.withColumn("link", F.lit(1))
    nodes = graph_nodes(edges)
    pivoted = edges.groupBy("src").pivot("dst", list(columns)).agg(F.first(F.lit(1)))
    return nodes.join(pivoted, nodes["id"] == pivoted["src"], "left").drop("src").fillna(0)


def _parted(edges: DataFrame, max_links: int) -> DataFrame:
    """Add ``part`` so that no (src, part) holds much more than ``max_links`` edges."""
    large = edges.groupBy("src").agg(F.count("*").alias("_links")).filter(F.col("_links") > max_links)
    parts = large.select("src", F.ceil(F.col("_links") / max_links).alias("_parts"))
    spread = F.pmod(F.xxhash64("dst"), F.coalesce("_parts", F.lit(1)))
    return edges.join(small_side(parts), "src", "left").withColumn("part", spread.cast("int")).drop("_parts")


def _lists(edges: DataFrame, entry: Column, parts: int) -> DataFrame:
    part = F.pmod(F.xxhash64("dst"), F.lit(parts)).cast("int").alias("part")
    return edges.groupBy("src", part).agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def adjacency_list(edges: DataFrame, parts: int = 1) -> DataFrame:
    """Sorted neighbours per vertex and ``part``, empty where there are none.

    Every vertex has ``parts`` rows, whatever its size; its neighbours are dealt to them by hash.  With
    one part a row is a vertex.  More parts keep a value small where a vertex has very many neighbours.
    """
    lists = _lists(edges.select("src", "dst").dropna().distinct(), F.col("dst"), parts)
    places = graph_nodes(edges).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    empty = F.array().cast(lists.schema["entries"].dataType)
    same = (places["id"] == lists["src"]) & (places["part"] == lists["part"])
    return places.join(lists, same, "left").select("id", places["part"], F.coalesce("entries", empty).alias("neighbours"))


def adjacency_lines(edges: DataFrame, parts: int = 1) -> DataFrame:
    """Render edges as ``src<TAB>{'dst': weight, ...}`` lines, at most ``parts`` lines a vertex, one by default."""
    entry = F.concat(F.lit("'"), F.col("dst").cast("string"), F.lit("': "), F.col("weight").cast("string"))
    body = F.array_join("entries", ", ")
    return _lists(edges, entry, parts).select(F.concat(F.col("src").cast("string"), F.lit("\t{"), body, F.lit("}")).alias("value"))


def transition_matrix(edges: DataFrame) -> DataFrame:
    """Share of each edge in its source's weight; dangling vertices have no row."""
    whole = edges.dropna(subset=["src", "dst"])
    return _shares(whole.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def _shares(merged: DataFrame) -> DataFrame:
    totals = merged.groupBy("src").agg(F.sum("weight").alias("_total"))
    # A source whose weights add up to nothing is dangling.  A negative weight is no share of anything.
    merged = merged.filter(F.when(F.col("weight") < 0, F.raise_error(F.lit("negative weight")).cast("boolean")).otherwise(True))
    return merged.join(totals.filter(F.col("_total") != 0), "src").select("src", "dst", (F.col("weight") / F.col("_total")).alias("share"))


@dataclass
class WalkGraph:
    """Vertices ``(id, parts, dangling)`` and links ``(src, part, dst, share)`` ready for iterations."""

    vertices: DataFrame
    links: DataFrame
    size: int
    tables: tuple[ScratchTable, ...] = ()

    def release(self, keep_tables: bool = False) -> None:
        """Free the cached links, and the written tables unless a result still reads them."""
        self.links.unpersist()
        for table in () if keep_tables else self.tables:
            table.discard()


def init_graph(edges: DataFrame, max_links: int = MAX_LINKS) -> WalkGraph:
    """Prepare a graph for random-walk iterations, dangling vertices included.

    Links stay hash-partitioned by (src, part) in executor storage, so an iteration shuffles vertex
    rows and merged contributions but never the links.  A hot source is spread over its parts.
    """
    # Edges are read for totals, parts and vertices, so whatever they are computed from runs once.
    # A link without an end carries no weight: its share would reach no vertex.
    edges = edges.dropna(subset=["src", "dst"])
    stored = write_scratch(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "edges")
    merged = stored.df
    # Sources whose weights add up to nothing lose their links and count as dangling, so no rank is lost.
    shares = _shares(merged)
    links = _parted(shares, max_links)
    parts = shares.groupBy(F.col("src").alias("id")).agg(F.ceil(F.count("*") / max_links).cast("int").alias("parts"))
    vertices = graph_nodes(merged).join(parts, "id", "left")
    vertices = vertices.select("id", F.coalesce("parts", F.lit(0)).alias("parts"), F.col("parts").isNull().alias("dangling"))
    vertices = write_scratch(vertices, "vertices")
    # Sorted as the iterations' merge joins want them.
    placed = links.repartition("src", "part").sortWithinPartitions("src", "part").persist(StorageLevel.MEMORY_AND_DISK)
    return WalkGraph(vertices.df, placed, vertices.df.count(), (stored, vertices))


def initial_ranks(graph: WalkGraph) -> DataFrame:
    """Every vertex with rank 1/N."""
    return graph.vertices.withColumn("rank", F.lit(1.0 / graph.size) if graph.size else F.lit(0.0))


def _received(state: DataFrame, graph: WalkGraph, value: str) -> DataFrame:
    """Mass each vertex receives along links: ``(id, received)``."""
    sending = state.filter(~F.col("dangling")).select(
        F.col("id").alias("src"), value, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    return (
        sending.join(graph.links, ["src", "part"])
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.col(value) * F.col("share")).alias("received"))
    )


def graph_outer_join(state: DataFrame, received: DataFrame) -> DataFrame:
    """All vertices with what they received, 0 where nothing arrived."""
    return state.join(received, "id", "left").withColumn("received", F.coalesce("received", F.lit(0.0)))


def _iterate_pagerank(edges: DataFrame, alpha: float, iterations: int, max_links: int):
    graph = init_graph(edges, max_links)
    n = graph.size
    trace: list[tuple[int, float, float]] = []
    state = ScratchTable(initial_ranks(graph), "")
    hanging = F.sum(F.when(F.col("dangling"), F.col("rank")).otherwise(0.0)).alias("dangling")
    masses = state.df.agg(F.sum("rank").alias("total"), hanging).first() if n else None
    for step in range(1, (iterations if n else 0) + 1):
        share = alpha / n + (1 - alpha) * masses["dangling"] / n
        joined = graph_outer_join(state.df, _received(state.df, graph, "rank"))
        ranked = joined.select("id", "parts", "dangling", (F.lit(share) + (1 - alpha) * F.col("received")).alias("rank"))
        written = write_scratch(ranked, "ranks")
        if state.path:
            state.discard()
        state = written
        before = masses["dangling"]
        masses = state.df.agg(F.sum("rank").alias("total"), hanging).first()
        trace.append((step, masses["total"], before))
    graph.release(keep_tables=not state.path)
    return state.df.select("id", "rank"), trace


def pagerank(edges: DataFrame, alpha: float = 0.15, iterations: int = 10, max_links: int = MAX_LINKS) -> DataFrame:
    """PageRank with teleport share ``alpha`` and dangling mass spread over all vertices."""
    return _iterate_pagerank(edges, alpha, iterations, max_links)[0]


def pagerank_trace(edges: DataFrame, alpha: float = 0.15, iterations: int = 10, max_links: int = MAX_LINKS) -> DataFrame:
    """Total mass after each iteration (always 1) and the dangling mass it redistributed."""
    trace = _iterate_pagerank(edges, alpha, iterations, max_links)[1]
    return edges.sparkSession.createDataFrame(trace, "step int, total_mass double, dangling_mass double")


def _start_state(graph: WalkGraph, start) -> DataFrame:
    p = F.lit(1.0 / max(graph.size, 1)) if start is None else (F.col("id") == F.lit(start)).cast("double")
    return graph.vertices.withColumn("p", p)


def _walk(edges: DataFrame, steps: int, start, atol: float | None, max_links: int):
    """Apply x -> x T; masses per step are read from the written vertex tables."""
    graph = init_graph(edges, max_links)
    state = ScratchTable(_start_state(graph, start), "")
    masses = [(0, state.df.agg(F.sum("p")).first()[0] or 0.0)]
    for step in range(1, steps + 1):
        joined = graph_outer_join(state.df, _received(state.df, graph, "p"))
        moved = F.abs(F.col("received") - F.col("p")).alias("moved")
        written = write_scratch(joined.select("id", "parts", "dangling", moved, F.col("received").alias("p")), "walk")
        if state.path:
            state.discard()
        state = written
        seen = state.df.agg(F.sum("p").alias("mass"), F.max("moved").alias("moved")).first()
        masses.append((step, seen["mass"] or 0.0))
        if atol is not None and (seen["moved"] or 0.0) <= atol:
            break
    graph.release(keep_tables=not state.path)
    return state.df.select("id", "p"), masses


def markov_steady_state(
    edges: DataFrame,
    steps: int = 100,
    start=None,
    atol: float | None = 1e-6,
    doubling: bool = False,
    max_states: int = 2_000,
    max_links: int = MAX_LINKS,
) -> DataFrame:
    """State distribution after repeated transitions, stopping early once no state moves by ``atol``.

    ``doubling`` squares the transition table each step, so ``k`` steps give ``x T^(2^k)``.  Squares
    fill up, so beyond ``max_states`` states the same distribution comes from as many plain steps; more
    than ``MOST_STEPS`` of them are refused, as they would not end.
    """
    if not doubling:
        return _walk(edges, steps, start, atol, max_links)[0]
    nodes = write_scratch(graph_nodes(edges), "states").df
    size = nodes.count()
    if size > max_states:
        if 2**steps > MOST_STEPS:
            raise ValueError(f"{size} states allow 2^{steps} plain steps only up to {MOST_STEPS}; use doubling=False with atol")
        return _walk(edges, 2**steps, start, None, max_links)[0]
    table = write_scratch(transition_matrix(edges), "power").df
    for _ in range(steps):
        left = table.select("src", F.col("dst").alias("mid"), F.col("share").alias("first"))
        right = table.select(F.col("src").alias("mid"), "dst", F.col("share").alias("second"))
        squared = left.join(right, "mid").groupBy("src", "dst").agg(F.sum(F.col("first") * F.col("second")).alias("share"))
        table = write_scratch(squared, "power").df
    weight = F.lit(1.0 / size) if start is None else (F.col("src") == F.lit(start)).cast("double")
    received = table.groupBy(F.col("dst").alias("id")).agg(F.sum(weight * F.col("share")).alias("p"))
    return nodes.join(received, "id", "left").fillna(0.0, ["p"])


def mass_leak_report(edges: DataFrame, steps: int = 10, start=None, max_links: int = MAX_LINKS) -> DataFrame:
    """Total probability after each step; it shrinks when dangling vertices swallow mass."""
    masses = _walk(edges, steps, start, None, max_links)[1]
    return edges.sparkSession.createDataFrame(masses, "step int, mass double")


def degree_centrality(edges: DataFrame) -> DataFrame:
    """Distinct in-, out- and total degree, each divided by ``n - 1``."""
    pairs = edges.select("src", "dst").dropna().distinct()
    ends = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(0).alias("in"), F.lit(1).alias("out")),
                F.struct(F.col("dst").alias("id"), F.lit(1).alias("in"), F.lit(0).alias("out")),
            )
        )
    )
    degrees = ends.groupBy("id").agg(F.sum("in").alias("in"), F.sum("out").alias("out"))
    others = graph_nodes(pairs).count() - 1
    return degrees.select(
        "id",
        F.try_divide("in", F.lit(others)).alias("in_centrality"),
        F.try_divide("out", F.lit(others)).alias("out_centrality"),
        F.try_divide(F.col("in") + F.col("out"), F.lit(others)).alias("centrality"),
    )


def betweenness_centrality(
    edges: DataFrame, sources: DataFrame | None = None, normalized: bool = True, batch: int | None = None
) -> DataFrame:
    """Share of shortest directed paths through each vertex, end points excluded.

    Paths are counted level by level from a batch of sources at once, then each level hands its
    dependency back to the level before, so pairs of vertices are visited but never triples.  Scores are
    added up batch by batch; the state is ``batch`` times the vertices, by default at most
    ``BATCH_PAIRS``, whatever the graph's size.  With ``sources`` (a column ``id``) only those start
    points are used and scores are scaled up to all vertices.
    """
    routes = write_scratch(route_graph(edges, "src", "dst").filter("src != dst"), "routes")
    nodes = write_scratch(graph_nodes(edges), "nodes").df
    n = nodes.count()
    starts = nodes if sources is None else nodes.join(sources.select("id").distinct(), "id", "left_semi")
    starts = write_scratch(positions(starts, ["id"], "place"), "starts")
    used = starts.df.count()
    batch = batch or max(1, BATCH_PAIRS // max(n, 1))
    total = None
    for first in range(0, used, batch):
        some = starts.df.filter((F.col("place") > first) & (F.col("place") <= first + batch))
        found = _dependencies(routes.df, some)
        if found is None:
            continue
        summed = found if total is None else found.unionByName(total.df)
        summed = write_scratch(summed.groupBy("id").agg(F.sum("score").alias("score")), "scores")
        if total is not None:
            total.discard()
        total = summed
    for table in (routes, starts):
        table.discard()
    scale = n / used if used else 1.0
    if normalized and n > 2:
        scale /= (n - 1) * (n - 2)
    scores = nodes.withColumn("score", F.lit(0.0)).limit(0) if total is None else total.df
    return nodes.join(scores, "id", "left").select("id", (F.coalesce("score", F.lit(0.0)) * scale).alias("betweenness"))


def _dependencies(links: DataFrame, starts: DataFrame) -> DataFrame | None:
    """(id, score): the paths from ``starts`` that each vertex carries; None where no path has an inner vertex."""
    level = write_scratch(starts.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(1.0).alias("sigma")), "level")
    levels = [level]
    reached = level.df
    while True:
        grown = (
            levels[-1].df.join(links, F.col("v") == F.col("src"))
            .groupBy("s", F.col("dst").alias("v"))
            .agg(F.sum("sigma").alias("sigma"))
            .join(reached.select("s", "v"), ["s", "v"], "left_anti")
        )
        level = write_scratch(grown, "level")
        if level.df.isEmpty():
            level.discard()
            break
        levels.append(level)
        reached = reached.unionByName(level.df)
    scores, deeper, held = None, None, []
    # The last level carries nothing on.
    for level in reversed(levels[1:]):
        if deeper is None:
            owed = level.df.withColumn("delta", F.lit(0.0))
        else:
            handed = deeper.df.select("s", F.col("v").alias("dst"), ((1 + F.col("delta")) / F.col("sigma")).alias("unit"))
            handed = handed.join(links, "dst").groupBy("s", F.col("src").alias("v")).agg(F.sum("unit").alias("unit"))
            owed = level.df.join(handed, ["s", "v"], "left").select(
                "s", "v", "sigma", (F.col("sigma") * F.coalesce("unit", F.lit(0.0))).alias("delta")
            )
        deeper = write_scratch(owed, "dependency")
        held.append(deeper)
        found = deeper.df.groupBy(F.col("v").alias("id")).agg(F.sum("delta").alias("score"))
        scores = found if scores is None else scores.unionByName(found)
    if scores is not None:
        scores = write_scratch(scores.groupBy("id").agg(F.sum("score").alias("score")), "batch-scores").df
    for table in (*levels, *held):
        table.discard()
    return scores
