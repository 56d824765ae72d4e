"""Published ranks and states of small graphs, and invariants."""

import itertools

import pytest

from chronoweave.operators import graph as g
from chronoweave.sources.scan import adjacency_edges

ELEVEN = {
    2: {3: 1}, 3: {2: 1}, 4: {1: 1, 2: 1}, 5: {4: 3, 2: 1, 6: 1}, 6: {2: 1, 5: 2},
    7: {2: 1, 5: 1}, 8: {2: 1, 5: 1}, 9: {2: 1, 5: 1}, 10: {5: 1}, 11: {5: 1},
}
RANKS = {
    2: 0.3620640495978871, 3: 0.333992700474142, 5: 0.08506399429624555, 4: 0.06030963508473455,
    1: 0.04255740809817991, 6: 0.03138662354831139, **{n: 0.01692511778009981 for n in range(7, 12)},
}
CLOSED = "AB AD BC BE CD DE EA EB EC".split()
LEAKING = "AB AC AD BD BE CA CE DB".split()


def _letters(spark, pairs):
    return spark.createDataFrame([(p[0], p[1], 1) for p in pairs], "src string, dst string, weight long")


@pytest.fixture(scope="module")
def eleven(spark):
    rows = [(s, d, w) for s, links in ELEVEN.items() for d, w in links.items()]
    return spark.createDataFrame(rows, "src long, dst long, weight long")


@pytest.mark.parametrize("max_links", [10**6, 1])
def test_published_ranks(eleven, max_links):
    found = {r["id"]: r["rank"] for r in g.pagerank(eleven, iterations=20, max_links=max_links).collect()}
    assert found == pytest.approx(RANKS, abs=1e-12)


def test_mass_stays_one(eleven):
    assert [r["total_mass"] for r in g.pagerank_trace(eleven, iterations=4).collect()] == pytest.approx([1.0] * 4)


def test_average_out_degree(eleven):
    assert g.out_degree_summary(eleven).first()["avg_degree"] == pytest.approx(1.7)


def test_adjacency_lines_round_trip(eleven, same_rows):
    same_rows(adjacency_edges(g.adjacency_lines(eleven)), eleven)
    same_rows(adjacency_edges(g.adjacency_lines(eleven, parts=3)), eleven)


@pytest.mark.parametrize("parts", [1, 3])
def test_one_grain_of_neighbour_lists(eleven, parts):
    lists = g.adjacency_list(eleven, parts).collect()
    assert sorted((r["id"], r["part"]) for r in lists) == [(n, p) for n in range(1, 12) for p in range(parts)]
    found = sorted((r["id"], d) for r in lists for d in r["neighbours"])
    assert found == sorted((s, d) for s, links in ELEVEN.items() for d in links)


def test_zero_weights_lose_no_rank(spark):
    edges = spark.createDataFrame([(1, 2, 0), (2, 1, 1), (3, 1, 1)], "src long, dst long, weight long")
    assert [r["total_mass"] for r in g.pagerank_trace(edges, iterations=5).collect()] == pytest.approx([1.0] * 5)
    start = {r["id"]: r["dangling"] for r in g.initial_ranks(g.init_graph(edges)).collect()}
    assert start == {1: True, 2: False, 3: False}
    assert {r["src"] for r in g.transition_matrix(edges).collect()} == {2, 3}
    with pytest.raises(Exception, match="negative weight"):
        g.transition_matrix(edges.union(spark.createDataFrame([(1, 3, -1)], edges.schema))).collect()


@pytest.mark.parametrize("batch", [1, 4])
def test_betweenness_of_source_batches(eleven, same_rows, batch):
    same_rows(g.betweenness_centrality(eleven, batch=batch), g.betweenness_centrality(eleven))


def test_published_steady_state(spark):
    expected = [0.10526316, 0.15789474, 0.18421053, 0.23684211, 0.31578947]
    edges = _letters(spark, CLOSED)
    for found in (g.markov_steady_state(edges, 200, "A", 1e-9), g.markov_steady_state(edges, 10, "A", doubling=True)):
        assert [r["p"] for r in found.orderBy("id").collect()] == pytest.approx(expected, abs=1e-7)


@pytest.mark.parametrize(("steps", "value"), [(1, 0.16666667), (2, 0.02777778), (3, 0.0007716)])
def test_published_leak_steps(spark, steps, value):
    found = g.markov_steady_state(_letters(spark, LEAKING), steps, "A", doubling=True)
    assert {r["id"]: r["p"] for r in found.collect()}["A"] == pytest.approx(value, abs=1e-7)


def test_leak_shrinks(spark):
    masses = [r["mass"] for r in g.mass_leak_report(_letters(spark, LEAKING), 6, "A").collect()]
    assert masses[0] == 1.0 and masses == sorted(masses, reverse=True) and masses[-1] < 0.5


def test_doubling_of_large_chains_takes_plain_steps(spark, same_rows):
    edges = _letters(spark, CLOSED)
    squared = g.markov_steady_state(edges, 2, "A", doubling=True)
    same_rows(g.markov_steady_state(edges, 2, "A", doubling=True, max_states=4), squared)


def test_links_without_an_end_carry_no_rank(spark):
    edges = spark.createDataFrame([(1, 2, 1), (1, None, 1), (2, 1, 1)], "src long, dst long, weight long")
    assert abs(sum(r["rank"] for r in g.pagerank(edges, 3).collect()) - 1) < 1e-9


def _betweenness(pairs):
    """All shortest paths by enumeration."""
    nodes = sorted(set("".join(pairs)))
    links = {n: [p[1] for p in pairs if p[0] == n] for n in nodes}
    scores = dict.fromkeys(nodes, 0.0)
    for s, t in itertools.permutations(nodes, 2):
        paths = [[s]]
        while paths and not any(p[-1] == t for p in paths):
            paths = [[*p, n] for p in paths for n in links[p[-1]] if n not in p]
        shortest = [p for p in paths if p[-1] == t]
        for path in shortest:
            for middle in path[1:-1]:
                scores[middle] += 1 / len(shortest)
    n = len(nodes)
    return {k: v / ((n - 1) * (n - 2)) for k, v in scores.items()}


@pytest.mark.parametrize("pairs", [CLOSED, LEAKING])
def test_betweenness_by_enumeration(spark, pairs):
    found = {r["id"]: r["betweenness"] for r in g.betweenness_centrality(_letters(spark, pairs)).collect()}
    assert found == pytest.approx(_betweenness(pairs))


def test_betweenness_from_all_sources_given(spark):
    edges = _letters(spark, CLOSED)
    given = g.betweenness_centrality(edges, sources=g.graph_nodes(edges)).collect()
    assert {r["id"]: r["betweenness"] for r in given} == pytest.approx(_betweenness(CLOSED))


def test_matrix_holds_every_cell(spark):
    edges = _letters(spark, CLOSED)
    pairs = {(r["src"], r["dst"]) for r in edges.collect()}
    assert sorted((r["id"], r["other"]) for r in g.adjacency_matrix(edges).collect()) == sorted(pairs)
    ids = sorted({end for pair in pairs for end in pair})
    for row in g.adjacency_matrix(edges, ids).collect():
        assert {(row["id"], i) for i in ids if row[i]} == {p for p in pairs if p[0] == row["id"]}


def test_doubling_of_large_chains_ends(spark):
    with pytest.raises(ValueError, match="plain steps"):
        g.markov_steady_state(_letters(spark, CLOSED), 30, "A", doubling=True, max_states=4)
