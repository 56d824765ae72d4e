"""The Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from chronoweave.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, row string, rank long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(digests):
    out = [list(digests)]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        first = at // 3 * 3
        yield "".join(level[first:at]), "".join(level[at + 1 : first + 3])
        at //= 3


def expected(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    trees = {}
    for s in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        ordered = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = ordered, levels(map(leaf, ordered))
    top = levels(tree[-1][0] for _, tree in trees.values())
    out = Counter()
    for k, (ordered, tree) in enumerate(trees.values()):
        for i, r in enumerate(ordered):
            steps, tampered = [*siblings(tree, i), *siblings(top, k)], r
            if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0 and r[4] is not None:
                tampered = (*r[:4], r[4].replace("\n", ""))
            h = leaf(tampered)
            for a, b in steps:
                h = sha(a + h + b)
            proof = sha("".join(a + b for a, b in steps))
            out[r[0], leaf(r), tree[-1][0], top[-1][0], proof, h, h == top[-1][0]] += 1
    return out


def made(n, sources, seed=1):
    rng = random.Random(seed)
    ids = lambda i: rng.choice([None, *range(n)]) if rng.random() < 0.2 else i
    texts = [None, "", "a\nb", "x" * 50 + "é\n\n", "\n"]
    return [(ids(i), rng.choice(sources), rng.choice([None, "en", "é"]), rng.choice([None, 5, -3]), rng.choice(texts)) for i in range(n)]


CASES = {
    "one": [(1, "a", None, None, "t\n")],
    "few": made(40, ["a", "b", None, "é", ""]),
    "hot source of more than two rounds": made(900, ["hot"] * 8 + ["a", None]),
    "one row repeated": [(7, "s", "en", 1, "x\n")] * 700 + made(40, ["s", "t"]),
    "many sources": made(500, [f"s{i}" for i in range(300)]),
    "long text": [(1, "a", None, None, "word \n" * 300_000), (2, "a", None, None, "é" * 100)],
}


@pytest.mark.parametrize("name", CASES)
def test_rows_of_the_manifest(spark, name):
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in CASES[name]], SCHEMA).repartition(3)
    found = merkle.digest(merkle.manifest(docs, candidate=merkle.without_line_breaks))
    assert Counter(map(tuple, found.collect())) == expected(CASES[name])


def test_trees_of_several_rounds(spark):
    digests = [sha(str(i)) for i in range(700)]
    table = spark.createDataFrame([(1, i, d) for i, d in enumerate(digests)] + [(2, 0, "x")], "tree long, rank long, digest string")
    forest = merkle.Forest.build(table, spark.createDataFrame([(1, 700), (2, 1)], "tree long, n long"), 4)
    assert len(forest.segments) == 2
    assert {tuple(r) for r in forest.tops.collect()} == {(1, levels(digests)[-1][0], 2), (2, "x", 1)}


def test_empty_table_and_kept_columns(spark):
    docs = spark.createDataFrame([(i, "s", None, i, "t", "x", f"r{i}", i) for i in range(5)], SCHEMA)
    assert merkle.manifest(docs.limit(0)).count() == 0
    found = merkle.manifest(docs, keep=("rank", "n_chars")).collect()
    assert sorted((r["doc_id"], r["rank"], r["n_chars"]) for r in found) == [(i, i, i) for i in range(5)]
    assert all(r["candidate"] is None and len(r["proof"]) == 2 for r in found)
