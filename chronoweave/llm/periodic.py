"""Periodic runs of words, found as branching tandem repeats in an enhanced suffix array.

A run of period q ends where the word q places on differs, so the last two periods of a long enough
run are a branching square: the suffixes at its two halves share exactly q words and lie in different
children of the LCP interval of depth q.  For each LCP interval the suffixes of all children but the
largest look up, in the inverse suffix array, whether the suffix ``depth`` places before or after them is in
the interval too and outside their own child.  Every square found so is rotated to the left as long as the words
agree, which gives its run; squares of several periods with one end merge into the run of the smallest.

Documents are cut into words and taken together up to ``GROUP_WORDS``.  The document's number is part of a word's rank,
so one array sorts all of a group's documents, side by side, and no common prefix crosses documents.
Intervals come from one pass over the LCP values with a stack; there are no tree nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

#: Fixed pattern of a word.
WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: Words sorted together, and suffixes looked up at a time.
GROUP_WORDS = 1 << 19
LOOKUPS = 1 << 21


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the suffixes of an integer sequence, and ranks by the first 1, 2, 4, ... words.

    Ranks double the words they compare; only suffixes that are still tied are sorted again.
    A suffix that ends sorts behind its extensions.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    heads = np.r_[True, words[order[1:]] != words[order[:-1]]]
    rank = np.full(n + 1, n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    levels, step = [rank.copy()], 1
    while True:
        size = np.diff(np.r_[np.flatnonzero(heads), n])
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            return order, levels
        suffixes = order[tied]
        key = rank[suffixes].astype(np.int64) * (n + 1) + rank[np.minimum(suffixes + step, n)]
        turn = np.argsort(key, kind="stable")
        order[tied], key = suffixes[turn], key[turn]
        heads[tied] = np.r_[True, key[1:] != key[:-1]]
        rank[order[tied]] = np.maximum.accumulate(np.where(heads[tied], tied, 0))
        levels.append(rank.copy())
        step *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the next one in ``order``."""
    shared = np.zeros(len(order) - 1, np.int64)
    some = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]])
    left, right, found = order[:-1][some], order[1:][some], np.zeros(len(some), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        found += (levels[k][left + found] == levels[k][right + found]).astype(np.int64) << k
    shared[some] = found
    return shared


def intervals(shared: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """LCP intervals of at least ``least`` suffixes.

    Returns depth, first and last place of each interval, the number of cuts between its children, and
    the places before the cuts, interval after interval.
    """
    # Values below which fewer than ``least`` suffixes hang together belong to no interval that counts.
    edges = np.flatnonzero(np.diff(np.r_[False, shared > 0, False].astype(np.int8)))
    first, last = edges[::2], edges[1::2]
    kept = last - first >= least - 1
    first, last = first[kept], last[kept]
    depths, lefts, rights, counts, cuts = [], [], [], [], []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        open_depth, open_left, open_cuts = [0], [a], [[]]
        for at, depth in enumerate([*shared[a:b].tolist(), 0], a):
            left = at
            while open_depth[-1] > depth:
                top, left, inner = open_depth.pop(), open_left.pop(), open_cuts.pop()
                if at - left + 1 >= least:
                    depths.append(top)
                    lefts.append(left)
                    rights.append(at)
                    counts.append(len(inner))
                    cuts += inner
            if depth > open_depth[-1]:
                open_depth.append(depth)
                open_left.append(left)
                open_cuts.append([at])
            elif depth:
                open_cuts[-1].append(at)
    return tuple(np.array(x, np.int64) for x in (depths, lefts, rights, counts, cuts))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The integers start, start + 1, ... of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def branching_squares(order: np.ndarray, shared: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of the branching squares that ``exponent`` - 2 equal words stand before."""
    n = len(order)
    depth, left, right, count, cut = intervals(shared, max(exponent, 2))
    if not len(depth):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    # Children of an interval lie between its cuts; the largest one is found by the others' lookups.
    owner = np.repeat(np.arange(len(depth)), count + 1)
    ends = np.cumsum(count + 1) - 1
    low = np.empty(len(owner), np.int64)
    first = np.r_[0, ends[:-1] + 1]
    inner = np.ones(len(owner), bool)
    inner[first] = False
    low[first], low[inner] = left, cut + 1
    high = np.empty(len(owner), np.int64)
    high[:-1], high[ends] = low[1:] - 1, right
    size = high - low + 1
    largest = np.maximum.reduceat(size, first)
    # One child of the largest size is left out, the first one.
    is_largest = np.flatnonzero(size == largest[owner])
    _, once = np.unique(owner[is_largest], return_index=True)
    small = np.ones(len(owner), bool)
    small[is_largest[once]] = False
    owner, low, high, size = owner[small], low[small], high[small], size[small]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    parts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + LOOKUPS, LOOKUPS))
    for a, b in zip(parts[:-1], np.r_[parts[1:-1], len(size)], strict=True):
        if a >= b:
            continue
        child = np.repeat(np.arange(a, b), size[a:b])
        suffix, period = order[_ranges(low[a:b], size[a:b])], depth[owner[child]]
        from_, to = left[owner[child]], right[owner[child]]

        def inside(at, some):
            """Whether the suffix at ``at`` is in the interval."""
            place = inverse[np.clip(at, 0, n - 1)]
            return (at >= 0) & (at < n) & (place >= from_[some]) & (place <= to[some]), place

        everything = np.arange(len(child))
        for start, other in ((suffix, suffix + period), (suffix - period, suffix - period)):
            member, place = inside(other, everything)
            some = np.flatnonzero(member & ((place < low[child]) | (place > high[child])))
            for back in range(1, exponent - 1):
                some = some[inside(start[some] - back * period[some], some)[0]]
            found.append((start[some], period[some]))
    starts, periods = (np.concatenate(x) for x in zip(*found, strict=True))
    both = np.unique(np.stack([starts, periods]), axis=1)
    return both[0], both[1]


def runs_of(words: np.ndarray, starts: np.ndarray, periods: np.ndarray, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs that end with the given branching squares."""
    ends, out = starts + 2 * periods, []
    by_end: dict[int, list[tuple[int, int]]] = {}
    for at in np.lexsort((periods, ends)).tolist():
        end, period, start = int(ends[at]), int(periods[at]), int(starts[at])
        known = by_end.setdefault(end, [])
        # A square whose period is a multiple of the one of a run around it belongs to that run.
        if any(period % q == 0 and begin <= start for begin, q in known):
            continue
        width = 64
        while start:
            low = max(start - width, 0)
            same = words[low:start] == words[low + period : start + period]
            differ = np.flatnonzero(~same)
            if len(differ):
                start = low + int(differ[-1]) + 1
                break
            start, width = low, 2 * width
        known.append((start, period))
        if end - start >= max(least, exponent * period):
            out.append((start, end - start, period))
    return sorted(out, key=lambda run: (run[0], run[2]))


def find(texts: list[list[bytes]], least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Runs of each of some word lists, sorted by start, then period."""
    numbers: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for words in texts for w in words), np.int64, int(sizes.sum()))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(flat) < 2:
        return out
    # A document's number stands before its words, so that documents share no word.
    flat += np.repeat(np.arange(len(texts)), sizes) * len(numbers)
    order, levels = suffix_array(flat)
    shared = common_prefixes(order, levels)
    del levels
    starts, periods = branching_squares(order, shared, exponent)
    ends = np.cumsum(sizes)
    for run in runs_of(flat, starts, periods, least, exponent):
        text = int(np.searchsorted(ends, run[0], side="right"))
        out[text].append((run[0] - int(ends[text] - sizes[text]), run[1], run[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words joined by one space, without those of a run behind its first period."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    dropped = np.cumsum(steps) > 0
    return b" ".join(word for word, gone in zip(words, dropped[:-1].tolist(), strict=True) if not gone)


RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))


def find_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    least: int = LEAST_WORDS,
    exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """One row per document: doc_id, ``keep``, runs (start, length, period in words) and the collapsed text.

    A run is a longest stretch with a smallest period q, at least ``least`` and ``exponent`` (2 or more) times q words
    long.  Runs are sorted by start, then period.  The collapsed text has the kept words, joined by one
    space.  Null, empty and blank texts have no runs and collapse to the empty text; repeated rows keep
    their own row, an empty table gives an empty one, other columns are not read.  Memory grows with
    the longest document, whose words are sorted in one task.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(keys, texts) -> pa.RecordBatch:
            runs = find(texts, least, exponent)
            collapsed = [collapse(words, of).decode() for words, of in zip(texts, runs, strict=True)]
            rows = [[{"start": a, "length": n, "period": q} for a, n, q in of] for of in runs]
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
            return pa.RecordBatch.from_arrays([keys, pa.array(rows, kind), pa.array(collapsed)], names=["doc", "runs", "collapsed"])

        for batch in batches:
            texts, first, held = [], 0, 0
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                texts.append((text.as_py() or b"").split())
                held += len(texts[-1])
                if held >= GROUP_WORDS:
                    yield batch_of(batch.column(0).slice(first, len(texts)), texts)
                    texts, first, held = [], row + 1, 0
            if texts:
                yield batch_of(batch.column(0).slice(first, len(texts)), texts)

    read = docs.select(F.struct(F.col(doc_id).alias("doc_id"), *keep).alias("doc"), F.col(text).cast("string").alias("text"))
    schema = StructType([read.schema["doc"], StructField("runs", RUNS), StructField("collapsed", StringType())])
    return read.mapInArrow(found, schema).select("doc.*", "runs", "collapsed")


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` in which every document whose id's crc32 is divisible by ten repeats a part of its words to its end.

    With g a tenth of the crc32, the words from a = g % n on repeat with period 1 + (n - a) / (3 + g % 8).
    Null ids count as the empty text; texts without words stay as they are.
    """
    draw = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(draw / 10)
    words = F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"({WORD})"), F.lit(1))

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % period).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")).otherwise(F.col(text))

    # ``words`` is bound once by a transformation over an array of one.
    return docs.withColumn(text, F.when(draw % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col(text)))


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run with the greatest exponent, and digests of the runs and the collapsed text."""

    def above(a: Column, b: Column) -> Column:
        """Order by exponent, greatest first, compared as exact fractions; then start, then period."""
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        rest = F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"]))
        return F.when(left > right, -1).when(left < right, 1).otherwise(rest).cast("int")

    best = F.get(F.array_sort("runs", above), 0)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[name].alias(name) for name in ("start", "length", "period")),
        F.floor(1_000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
