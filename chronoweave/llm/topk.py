"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers.  A block of the index holds, for every attribute and bit, a bitmap
over its rows.  A query adds the attributes' slices with bitmap arithmetic, weighted by the bits of its
own components, into slices of the score; rows are then selected from the most significant slice
downward until the best ``k`` are fixed, and rows that tie at the boundary go by their id.  Scores are
read off the slices, so they are exact.

Vectors with components too long for 64-bit slices stand in blocks of their own as they are; they, and
queries with such components, are scored with integers of any length.

Blocks are dealt to tasks once, or a few times where there are fewer blocks than tasks; query groups of bounded size
stream past them, so what moves is the queries and the best rows of each query and block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.llm.common import parts_for
from chronoweave.scratch import write_scratch

SCALE = 256
K = 5
EVERY = 50
BLOCK_ROWS = 16_384
GROUP_QUERIES = 64
#: Vectors with components beyond this, after scaling, are scored without slices, in blocks of so many rows.
LARGEST = 1 << 57
LONG_ROWS = 1_024
#: Vectors with components beyond this have blocks of their own, so that their bits widen no other block.
NARROW = 1 << 15
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v, raw, dim) of the vectors that take part: an id, all components finite.

    ``v`` holds the scaled integers; a vector with one beyond ``LARGEST`` has its components in ``raw`` instead.
    """
    finite = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    fits = F.forall(F.col(vector), lambda x: F.abs(x.cast("double")) <= LARGEST / SCALE)
    scaled = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    taking = rows.filter(F.col(vector).isNotNull() & F.col(vec_id).isNotNull()).filter(finite)
    return taking.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.when(fits, scaled).alias("v"),
        F.when(~fits, F.transform(F.col(vector), lambda x: x.cast("double"))).alias("raw"),
        F.size(vector).alias("dim"),
    )


def _build_long(table: pa.Table) -> pa.Table:
    """A block of vectors with long components, in order of id."""
    order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
    ids = table.column("vec_id").to_numpy()[order]
    raw = table.column("raw").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[order]
    row = {"dim": raw.shape[1], "block": table.column("block")[0].as_py(), "low": 0, "bits": 0}
    row |= {"ids": ids.astype("<i8").tobytes(), "slices": raw.astype("<f8").tobytes()}
    return pa.table({k: [v] for k, v in row.items()}, schema=_BLOCK)


def _build(table: pa.Table) -> pa.Table:
    """One index block: bitmaps by attribute and bit over rows in order of id."""
    ids = table.column("vec_id").to_numpy()
    dim = table.column("dim")[0].as_py()
    values = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    low = int(values.min()) if values.size else 0
    bits = max(1, int(values.max() - low).bit_length()) if values.size else 1
    words = (len(ids) + 63) // 64
    lifted = np.zeros((dim, words * 64), np.uint64)
    lifted[:, : len(ids)] = (values - low).T.astype(np.uint64)
    slices = np.empty((dim, bits, words), "<u8")
    for b in range(bits):
        plane = ((lifted >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        slices[:, b] = np.packbits(plane, axis=1, bitorder="little").view("<u8")
    block = table.column("block")[0].as_py()
    row = {"dim": dim, "block": block, "low": low, "bits": bits, "ids": ids.astype("<i8").tobytes(), "slices": slices.tobytes()}
    return pa.table({k: [v] for k, v in row.items()}, schema=_BLOCK)


_BLOCK = pa.schema(
    [("dim", pa.int32()), ("block", pa.int64()), ("low", pa.int64()), ("bits", pa.int32()), ("ids", pa.binary()), ("slices", pa.binary())]
)


def _add(total: list[np.ndarray], addend: list[np.ndarray], at: int) -> None:
    """Add a bit-sliced number, shifted by ``at`` bits, to a bit-sliced total in place."""
    carry = None
    for i, x in enumerate(addend):
        place = at + i
        if place == len(total):
            total.append(np.zeros_like(x))
        t = total[place]
        half = t ^ x
        if carry is None:
            carry = t & x
            total[place] = half
        else:
            over = half & carry
            np.bitwise_xor(half, carry, out=half)
            np.bitwise_and(t, x, out=t)
            carry = np.bitwise_or(t, over, out=t)
            total[place] = half
    place = at + len(addend)
    while carry is not None and carry.any():
        if place == len(total):
            total.append(carry)
            break
        half = total[place] ^ carry
        carry = total[place] & carry
        total[place] = half
        place += 1


def _scores(slices: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
    """Score slices [query, word] of ``sum |q_d| * x_d``, where negative q_d take the complement of x_d."""
    dim, bits, _ = slices.shape
    negative = np.where(queries < 0, ONES, np.uint64(0))
    sizes = np.abs(queries).astype(np.uint64)
    planes = int(sizes.max()).bit_length() if sizes.size else 0
    sums: list[list[np.ndarray]] = [[] for _ in range(planes)]
    for d in range(dim):
        turned = [slices[d, b][None, :] ^ negative[:, d, None] for b in range(bits)]
        for p in range(planes):
            has = (sizes[:, d] >> np.uint64(p)) & np.uint64(1)
            if has.any():
                mask = (np.uint64(0) - has)[:, None]
                _add(sums[p], [x & mask for x in turned], 0)
    total: list[np.ndarray] = []
    for p, part in enumerate(sums):
        if part:
            while len(total) < p:
                total.append(np.zeros_like(part[0]))
            _add(total, part, p)
    return total


def _select(score: list[np.ndarray], rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps [query, word] of rows surely among the best ``k`` and of rows tied at the boundary."""
    sure, tied = np.zeros_like(rows), rows.copy()
    for s in reversed(score):
        high = tied & s
        both = sure | high
        n = np.bitwise_count(both).sum(axis=1, dtype=np.int64)[:, None]
        sure = np.where(n <= k, both, sure)
        tied = np.where(n > k, high, np.where(n == k, np.uint64(0), tied & ~s))
    return sure, tied


def best_of_block(
    ids: np.ndarray, slices: np.ndarray, low: int, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[list[int], list[int], list[int]]:
    """Places of queries, ids of rows and scores of each query's best ``k`` rows of one block."""
    words = slices.shape[2]
    valid = np.zeros(words * 64, np.uint8)
    valid[: len(ids)] = 1
    rows = np.repeat(np.packbits(valid, bitorder="little").view("<u8")[None, :], len(queries), axis=0)
    first, last = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for q in range(len(queries)):
        for own in range(first[q], last[q]):
            rows[q, own // 64] &= ~np.uint64(1 << (own % 64))
    score = _scores(slices, queries)
    sure, tied = _select(score, rows, k)
    most = (1 << slices.shape[1]) - 1
    exact = queries.astype(object)
    shift = exact.sum(axis=1) * low + np.where(queries < 0, exact, 0).sum(axis=1) * most
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    for q in range(len(queries)):
        place = lambda m: np.flatnonzero(np.unpackbits(m[q].view(np.uint8), bitorder="little"))
        chosen = place(sure)
        # Rows stand in order of id, so the first of those tied have the smaller ids.
        chosen = np.concatenate([chosen, place(tied)[: max(0, k - len(chosen))]])
        for row in chosen.tolist():
            bit = np.uint64(row % 64)
            value = sum(int((s[q, row // 64] >> bit) & np.uint64(1)) << b for b, s in enumerate(score))
            out[0].append(q)
            out[1].append(int(ids[row]))
            out[2].append(value + int(shift[q]))
    return out


def _integers(raw) -> list[int]:
    """Components of a vector, scaled and rounded down, as integers of any length."""
    return [int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE) for x in raw]


def _rows_of(block: dict) -> list[list[int]]:
    """All vectors of a block as integers."""
    if not block["bits"]:
        return [_integers(row) for row in np.frombuffer(block["slices"], "<f8").reshape(-1, block["dim"]).tolist()]
    slices = np.frombuffer(block["slices"], "<u8").reshape(block["dim"], block["bits"], -1)
    planes = np.unpackbits(slices.view(np.uint8), axis=2, bitorder="little")[:, :, : len(block["ids"]) // 8].astype(np.int64)
    values = (planes << np.arange(block["bits"])[None, :, None]).sum(axis=1) + block["low"]
    return values.T.tolist()


def _best_exactly(ids: list[int], rows: list[list[int]], query_id: int, query: list[int], k: int) -> list[tuple[int, int]]:
    """(id, score) of a query's best ``k`` rows, ties by id."""
    scored = ((sum(map(mul, query, row)), i) for i, row in zip(ids, rows, strict=True) if i != query_id)
    return [(i, score) for score, i in heapq.nsmallest(k, scored, key=lambda s: (-s[0], s[1]))]


def _sort_key(score: int) -> bytes:
    """Bytes that sort as the scores do, whatever their length."""
    size = (abs(score).bit_length() + 7) // 8
    key = b"\x80" + size.to_bytes(2, "big") + abs(score).to_bytes(size, "big")
    return key if score >= 0 else bytes(255 - b for b in key)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict = {}
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                # A block comes before the query groups that it answers.
                if r["queries"] is None:
                    block = r
                    continue
                r = block | {"queries": r["queries"]}
                ids = np.frombuffer(r["ids"], "<i8")
                plain = [q for q in r["queries"] if q["v"] is not None and r["bits"]]
                found: list[tuple[dict, int, int]] = []
                if plain:
                    slices = np.frombuffer(r["slices"], "<u8").reshape(r["dim"], r["bits"], -1)
                    query_ids = np.array([q["vec_id"] for q in plain], np.int64)
                    queries = np.array([q["v"] for q in plain], np.int64).reshape(len(query_ids), r["dim"])
                    for i, row, score in zip(*best_of_block(ids, slices, r["low"], query_ids, queries, k), strict=True):
                        found.append((plain[i], row, score))
                if len(plain) < len(r["queries"]):
                    rows = _rows_of(r)
                    for q in r["queries"]:
                        if q["v"] is None or not r["bits"]:
                            query = _integers(q["raw"]) if q["v"] is None else q["v"]
                            found += ((q, row, score) for row, score in _best_exactly(ids.tolist(), rows, q["vec_id"], query, k))
                columns = [
                    pa.array([q["query"] for q, _, _ in found], pa.string()),
                    pa.array([q["vec_id"] for q, _, _ in found], pa.int64()),
                    pa.array([row for _, row, _ in found], pa.int64()),
                    pa.array([max(-(1 << 63), min((1 << 63) - 1, score)) for _, _, score in found], pa.int64()),
                    pa.array([_sort_key(score) for _, _, score in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "query_id", "vec_id", "score", "sort_key"])

    return search


def build_index(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Bit-sliced index of every vector that takes part, one row per block, written to shared storage."""
    sound = write_scratch(quantised(rows, vec_id, vector), "topk-rows").df
    sizes = sound.agg(F.count("v").alias("plain"), F.count("raw").alias("long")).first()
    shape = "dim int, block long, low long, bits int, ids binary, slices binary"
    blocks = max(1, math.ceil(sizes["plain"] / block_rows))
    at = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))
    block = F.when(F.forall("v", lambda x: F.abs(x) <= NARROW), at).otherwise(-1 - at).alias("block")
    built = sound.filter("v IS NOT NULL").select("vec_id", "v", "dim", block).groupBy("dim", "block").applyInArrow(_build, shape)
    if sizes["long"]:
        # Numbers of these blocks lie beyond those of all others.
        own = (F.lit(blocks) + F.pmod(F.xxhash64("vec_id", "raw"), F.lit(math.ceil(sizes["long"] / LONG_ROWS)))).alias("block")
        rest = sound.filter("raw IS NOT NULL").select("vec_id", "raw", "dim", own).groupBy("dim", "block").applyInArrow(_build_long, shape)
        built = built.unionByName(rest)
    return write_scratch(built, "topk-index").df


def search(
    index: DataFrame, rows: DataFrame, k: int = K, vec_id: str = "vec_id", vector: str = "embedding", group: int = GROUP_QUERIES
) -> DataFrame:
    """Best ``k`` rows of the index for every row of ``rows``: query_id, rank, vec_id, score.

    Rows with the query's own id are no candidates, nor are vectors of another length.  Null vectors,
    vectors with null or non-finite components and null ids take no part.  Repeated queries answer
    once; repeated candidates count each.  Fewer candidates than ``k`` give fewer rows.  Ranks follow the
    exact score; one beyond a long is returned as the nearest long.
    """
    queries = quantised(rows, vec_id, vector).distinct().withColumn("query", F.md5(F.to_json(F.struct("vec_id", "v", "raw"))))
    queries = write_scratch(queries, "topk-queries").df
    groups = max(1, math.ceil(queries.count() / group))
    gathered = queries.groupBy("dim", F.pmod(F.xxhash64("query"), F.lit(groups)).alias("group")).agg(
        F.collect_list(F.struct("query", "vec_id", "v", "raw")).alias("queries")
    )
    # The stated queries go to every block, in groups; with few blocks each stands in several stripes that share the groups.
    targets = index.groupBy("dim").agg(F.collect_set("block").alias("blocks"))
    parts = parts_for(rows)
    stripes = max(1, math.ceil(parts / max(1, index.count())))
    held = index.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    sent = gathered.join(targets, "dim").withColumn("stripe", F.pmod("group", F.lit(stripes)).cast("int"))
    sent = sent.withColumn("block", F.explode("blocks")).drop("blocks", "group")
    met = held.unionByName(sent, allowMissingColumns=True)
    place = ["dim", "block", "stripe"]
    pairs = met.repartition(parts, *place).sortWithinPartitions(*place, F.col("queries").isNotNull())
    found = pairs.mapInArrow(_search(k), "query string, query_id long, vec_id long, score long, sort_key binary")
    order = Window.partitionBy("query", "query_id").orderBy(F.desc("sort_key"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
