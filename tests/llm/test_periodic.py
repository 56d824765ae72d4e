"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from chronoweave.llm import periodic


def all_runs(words, least, exponent):
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def made_words(rng):
    words, letters = [], rng.choice([1, 2, 3, 8])
    for _ in range(rng.randint(0, 8)):
        unit = [b"w%d" % rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        words += (unit * rng.randint(1, 9))[: rng.randint(1, 60)] if rng.random() < 0.5 else unit
    return words


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (5, 3)])
def test_runs_of_word_lists(least, exponent):
    rng = random.Random(5)
    for _ in range(60):
        texts = [made_words(rng) for _ in range(10)]
        assert periodic.find(texts, least, exponent) == [all_runs(w, least, exponent) for w in texts]


def test_lookups_in_parts(monkeypatch):
    monkeypatch.setattr(periodic, "LOOKUPS", 7)
    rng = random.Random(6)
    texts = [made_words(rng) for _ in range(60)]
    assert periodic.find(texts) == [all_runs(w, 6, 4) for w in texts]


def row_of(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
    runs = all_runs(words, 6, 4)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1_000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def test_rows(spark):
    rng = random.Random(7)
    texts = [None, "", " \t\n", "a", "a a a a a", "a a\na\ta  a a", "ab ab ab ab ab ab", "x y x y x y x y", "é " * 9, "  " * 7, "w " * 30_000]
    texts += [b" ".join(made_words(rng)).decode() for _ in range(250)]
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)] + [(None, "p q r p q r p q r p q r", "n", 1), (None, None, "n", 1), (3, "a", "n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start long")
    found = periodic.digest(periodic.find_runs(periodic.planted(docs))).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((row_of(r[0], r[1]) for r in rows), key=repr)
    assert sum(r["n_runs"] > 0 for r in found) > 100 and zlib.crc32(b"9") % 10 != 0
    assert periodic.find_runs(docs.limit(0)).count() == 0


def test_general_interface(spark):
    docs = spark.createDataFrame([(1, "go a b a b a b stop stop", "k")], "doc_id long, text string, collapsed string")
    row = periodic.find_runs(docs.withColumnRenamed("collapsed", "kind"), keep=("kind",), least=2, exponent=2).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 6, 2), (7, 2, 1)] and row["collapsed"] == "go a b stop" and row["kind"] == "k"
