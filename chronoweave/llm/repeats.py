"""Suffix-array dedup: remove every byte of a string of ``LENGTH`` bytes that also starts elsewhere.

Sorting every suffix of a corpus would move ``LENGTH`` bytes for each of its bytes.  Three facts keep
the work near the size of the repeated parts, and the result exact:

* The gram with the smallest hash inside a window of ``LENGTH`` bytes depends on the window alone.  So
  equal windows have equal anchors, at the same offset, and only windows of one anchor gram can match.
* A run of windows that share an anchor is one context.  Contexts that occur twice with the same bytes
  are repeated as a whole; their hash tells.
* Only different contexts of one gram are left.  Shards of them get a suffix array, by refining
  ranks from 8 to 16, 32, ... bytes, with the unsorted groups alone sorted again.  Common prefixes of
  neighbours follow from the ranks of the levels, and mark the windows that another context holds.

A gram with more contexts than fit a shard is spread over several.  Each shard then also sorts the
digests of its windows and cuts them by binary search into ranges; a range's pieces from all shards
are merged by binary search in one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from chronoweave.llm.common import parts_for
from chronoweave.scratch import write_scratch

LENGTH = 200
GRAM = 16
GRAMS = LENGTH - GRAM + 1
#: Windows looked at together; their places fit the low bits of a key.
CHUNK = 1 << 19
PLACE_BITS = 20
#: Bytes of contexts one suffix array covers, and contexts of one gram that a shard takes.
SHARD_BYTES = 4 << 20
SHARD_CONTEXTS = 10_000
#: A key with more than this part of all rows is heavy, so that there are fewer heavy keys than this number.
HEAVY_KEYS = 1_000
#: Windows of one range in the merge of shards.
RANGE_WINDOWS = 1_000_000
#: Depths to which ranks are refined; the last one is at least ``LENGTH``.
LEVELS = (8, 16, 32, 64, 128)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one big-endian number; ``data`` has 7 bytes more than places."""
    out = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        out |= data[i : len(data) - 7 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the gram at each place."""
    words = _words(data)
    first, second = words[: len(words) - 8], words[8:]
    h = first * np.uint64(0x9E3779B97F4A7C15) + second
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h += second * np.uint64(0xC2B2AE3D27D4EB4F)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of a text: anchor hash, context hash, first window, number of windows."""
    hashes, contexts, starts, counts = [], [], [], []
    windows = len(text) - LENGTH + 1
    for low in range(0, windows, CHUNK):
        high = min(low + CHUNK, windows)
        gram = _gram_hashes(np.frombuffer(text, np.uint8)[low : high - 1 + LENGTH])
        mask = np.uint64((1 << PLACE_BITS) - 1)
        least = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
        width = 1
        while width * 2 <= GRAMS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: high - low], least[GRAMS - width : GRAMS - width + high - low])
        place = (least & mask).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        count = np.diff(np.r_[first, high - low])
        hashes.append(gram[place[first]])
        starts.append(first + low)
        counts.append(count)
        digest = xxhash.xxh3_64_intdigest
        contexts.extend(
            digest(text[s : s + n - 1 + LENGTH]) for s, n in zip((first + low).tolist(), count.tolist(), strict=True)
        )
    if not hashes:
        none = np.empty(0, np.int64)
        return none, none, none, none
    return (
        np.concatenate(hashes).view(np.int64),
        np.array(contexts, np.uint64).view(np.int64),
        np.concatenate(starts),
        np.concatenate(counts),
    )


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "h", "c", "at", "n"]
    for batch in batches:
        keys, columns, held = [], [[], [], [], []], 0
        for row, text in enumerate(batch.column(1)):
            found = anchors(text.as_py())
            keys.append(np.full(len(found[0]), row))
            for column, values in zip(columns, found, strict=True):
                column.append(values)
            held += len(found[0])
            if held > 200_000 or row == batch.num_rows - 1:
                key = batch.column(0).take(pa.array(np.concatenate(keys).astype(np.int64)))
                arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays([key, *arrays], names=names)
                keys, columns, held = [], [[], [], [], []], 0


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted contexts of each text."""
    names = ["key", "h", "at", "n", "contexts", "context"]
    for batch in batches:
        for row in range(batch.num_rows):
            text, wanted = batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
            key = pa.array([batch.column(0)[row].as_py()] * len(wanted), pa.binary())
            parts = [text[w["at"] : w["at"] + w["n"] - 1 + LENGTH] for w in wanted]
            numbers = [pa.array([w[k] for w in wanted], pa.int64()) for k in ("h", "at", "n", "contexts")]
            yield pa.RecordBatch.from_arrays([key, *numbers, pa.array(parts, pa.binary())], names=names)


def suffix_ranks(data: np.ndarray) -> list[np.ndarray]:
    """Ranks of all places by their first 8, 16, ... 256 bytes; past the end stand zeros.

    A rank is the place of its group in sorted order.  Groups of one are sorted for good.
    """
    size, reach = len(data), 2 * LEVELS[-1]
    _, inverse, counts = np.unique(_words(np.r_[data, np.zeros(7, np.uint8)]), return_inverse=True, return_counts=True)
    starts = np.r_[0, np.cumsum(counts)[:-1]]
    ranks = [starts[inverse].astype(np.int32)]
    live = np.flatnonzero(counts[inverse] > 1)
    for depth in LEVELS:
        rank = ranks[-1]
        padded = np.r_[rank, np.full(reach, -1, np.int32)]
        key = (rank[live].astype(np.int64) << 32) | (padded[live + depth].astype(np.int64) + 1)
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        index = np.arange(len(key))
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, bool)
        group = np.r_[True, (key[1:] >> 32) != (key[:-1] >> 32)] if len(key) else np.empty(0, bool)
        first_new = np.maximum.accumulate(np.where(new, index, 0))
        first_group = np.maximum.accumulate(np.where(group, index, 0))
        refined = rank.copy()
        refined[live] = (key >> 32) + first_new - first_group
        ranks.append(refined)
        last = np.r_[new[1:], True] if len(key) else new
        live = live[~(new & last)]
    assert len(ranks[-1]) == size
    return ranks


def common_prefixes(ranks: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common prefix of pairs of places in steps of 8 bytes, up to 248, from the ranks of all levels."""
    length = np.zeros(len(left), np.int64)
    size = len(ranks[0])
    for rank, depth in zip(reversed(ranks[:-1]), reversed(LEVELS), strict=True):
        a, b = np.minimum(left + length, size - 1), np.minimum(right + length, size - 1)
        length += depth * (rank[a] == rank[b])
    return length


def shared_windows(contexts: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the contexts that start at more than one place among them.

    Returns the context of each window, its offset, and whether it is repeated.  ``counts`` are the
    windows of each context; no other place starts a window.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    ranks = suffix_ranks(data)
    bases = np.cumsum([0, *map(len, contexts)])[:-1]
    owner = np.repeat(np.arange(len(contexts)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = bases[owner] + offset
    order = np.argsort(ranks[-1][place], kind="stable")
    same = common_prefixes(ranks, place[order[:-1]], place[order[1:]]) >= LENGTH
    repeated = np.zeros(len(owner), bool)
    repeated[order[:-1]] |= same
    repeated[order[1:]] |= same
    return owner, offset, repeated


def _ranges(owner: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows, sorted by (owner, offset): owner, first and last offset."""
    if not len(owner):
        return owner, offset, offset
    cut = np.flatnonzero((owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1))
    first, last = np.r_[0, cut + 1], np.r_[cut, len(owner) - 1]
    return owner[first], offset[first], offset[last]


def _shard_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of sorted (h, key, at, n, context) rows; whole grams go into one suffix array."""
    held: list[tuple] = []
    size = 0

    def matched(rows: list[tuple]) -> pa.RecordBatch:
        owner, offset, repeated = shared_windows([r[4] for r in rows], np.array([r[3] for r in rows]))
        who, first, last = _ranges(owner[repeated], offset[repeated])
        at = np.array([r[2] for r in rows], np.int64)[who]
        keys = pa.array([rows[i][1] for i in who.tolist()], pa.binary())
        return pa.RecordBatch.from_arrays([keys, pa.array(at + first), pa.array(at + last)], names=["key", "first", "last"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if size >= SHARD_BYTES and row[0] != held[-1][0]:
                yield matched(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield matched(held)


def _shard_digests(ranges: int):
    """Suffix array of one shard of a crowded gram: its own repeats, and all windows cut into ranges."""

    def of_shard(table: pa.Table) -> pa.Table:
        contexts = table.column("context").to_pylist()
        counts = table.column("n").to_numpy()
        owner, offset, repeated = shared_windows(contexts, counts)
        digest = xxhash.xxh3_128_digest
        digests = b"".join(
            digest(contexts[i][o : o + LENGTH]) for i, o in zip(owner.tolist(), offset.tolist(), strict=True)
        )
        halves = np.frombuffer(digests, ">u8").reshape(-1, 2)
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        top = halves[order, 0].astype(np.uint64) >> np.uint64(32)
        bounds = np.searchsorted(top, (np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(ranges))
        bounds[-1] = len(order)
        filled = np.flatnonzero(np.diff(bounds))
        lists = pa.array(np.r_[bounds[filled], len(order)].astype(np.int32))
        who = owner[order]
        columns = [
            pa.array([table.column("h")[0].as_py()] * len(filled), pa.int64()),
            pa.array(filled.astype(np.int32)),
            pa.array([halves[order[bounds[r] : bounds[r + 1]]].tobytes() for r in filled], pa.binary()),
            pa.ListArray.from_arrays(lists, table.column("key").combine_chunks().take(pa.array(who))),
            pa.ListArray.from_arrays(lists, pa.array(table.column("at").to_numpy()[who] + offset[order])),
            pa.ListArray.from_arrays(lists, pa.array(repeated[order])),
        ]
        return pa.Table.from_arrays(columns, schema=_PIECE)

    return of_shard


_PIECE = pa.schema(
    [
        ("h", pa.int64()),
        ("range", pa.int32()),
        ("digests", pa.binary()),
        ("keys", pa.list_(pa.binary())),
        ("at", pa.list_(pa.int64())),
        ("own", pa.list_(pa.bool_())),
    ]
)


def _merge_range(table: pa.Table) -> pa.Table:
    """Windows of a range that several shards hold, found by binary search of each piece in all."""
    flat = lambda c: table.column(c).combine_chunks().flatten()
    digests = np.frombuffer(b"".join(table.column("digests").to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    merged = digests[order]
    # A digest's number in the merged order; equal digests share one.
    number = np.cumsum(np.r_[True, (merged[1:] != merged[:-1]).any(axis=1)])
    held = np.searchsorted(number, number, "right") - np.searchsorted(number, number, "left")
    shared = flat("own").to_numpy(zero_copy_only=False)
    shared[order[held > 1]] = True
    found = pa.array(np.flatnonzero(shared))
    at = flat("at").take(found)
    return pa.table({"key": flat("keys").take(found), "first": at, "last": at})


def _join_unique(rows: DataFrame, side: DataFrame, keys: list[str], places: str, total: int) -> DataFrame:
    """Join rows with a side of one row per key; ``places`` counts a key's rows among ``total`` ones.

    Heavy keys are fewer than ``HEAVY_KEYS`` and a side's row holds a few numbers, so they are broadcast
    and their rows stay where they are; the rest, without a heavy key, is shuffled.
    """
    heavy = F.col(places) * HEAVY_KEYS > total
    known = F.broadcast(side.filter(heavy))
    rest = rows.join(F.broadcast(side.filter(heavy).select(keys)), keys, "left_anti")
    return rows.join(known, keys).unionByName(rest.join(side.filter(~heavy), keys))


def repeated_windows(docs: DataFrame, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """Runs of repeated windows: (key, first, last) by text key; ``docs`` has key and bytes.

    The key stands for a text; rows with the same key are copies, and their places count apart.
    """
    schema = "key binary, h long, c long, at long, n long"
    found = write_scratch(docs.select("key", "bytes").mapInArrow(_anchor_rows, schema), "anchors")
    grams = found.df.groupBy("h").agg(F.count("*").alias("places"), (F.min("c") != F.max("c")).alias("mixed"))
    useful = write_scratch(grams.filter("places > 1"), "useful-grams").df
    joined = _join_unique(found.df, useful, ["h"], "places", found.df.count()).drop("places")
    placed = write_scratch(joined, "placed-contexts").df
    found.discard()
    # Equal contexts are repeated as a whole; one place of each stands for it among the others of its gram.
    contexts = placed.filter("mixed").groupBy("h", "c").agg(
        F.count("*").alias("places"), F.min(F.struct("key", "at", "n")).alias("r")
    )
    contexts = write_scratch(contexts, "mixed-contexts").df
    again = contexts.filter("places > 1").select("h", "c", "places")
    equal = _join_unique(placed.filter("mixed"), again, ["h", "c"], "places", placed.count())
    equal = placed.filter("NOT mixed").select("key", "at", "n").unionByName(equal.select("key", "at", "n"))
    whole = equal.select("key", F.col("at").alias("first"), (F.col("at") + F.col("n") - 1).alias("last"))
    sizes = contexts.groupBy("h").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    sizes = write_scratch(sizes, "gram-contexts").df
    one_each = contexts.select("h", "r.*")
    chosen = write_scratch(_join_unique(one_each, sizes, ["h"], "contexts", contexts.count()), "chosen-contexts").df
    wanted = chosen.groupBy("key").agg(F.collect_list(F.struct("h", "at", "n", "contexts")).alias("wanted"))
    # One copy of each text gives the bytes.
    ids = docs.groupBy("key").agg(F.min("row").alias("row"))
    texts = docs.join(wanted.join(ids, "key"), ["key", "row"])
    schema = "key binary, h long, at long, n long, contexts long, context binary"
    cut = texts.select("key", "bytes", "wanted").mapInArrow(_context_rows, schema)
    crowded = F.col("contexts") > shard_contexts
    crowd = chosen.filter(crowded).count()
    few, out = cut, whole
    if crowd:
        cut = write_scratch(cut, "context-bytes").df
        few, many = cut.filter(~crowded), cut.filter(crowded)
        shard = F.pmod(F.xxhash64("key", "at"), F.ceil(F.col("contexts") / shard_contexts)).alias("shard")
        ranges = max(1, -(-crowd * GRAMS // RANGE_WINDOWS))
        pieces = many.select("h", shard, "key", "at", "n", "context").groupBy("h", "shard").applyInArrow(
            _shard_digests(ranges),
            "h long, range int, digests binary, keys array<binary>, at array<long>, own array<boolean>",
        )
        out = out.unionByName(
            pieces.groupBy("h", "range").applyInArrow(_merge_range, "key binary, first long, last long")
        )
    shards = few.repartition(parts_for(docs), "h").sortWithinPartitions("h").select("h", "key", "at", "n", "context")
    return out.unionByName(shards.mapInArrow(_shard_matches, "key binary, first long, last long"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "kept", "removed"]
    for batch in batches:
        kept, removed = [], []
        for text, runs in zip(batch.column(1), batch.column(2), strict=True):
            text, spans = text.as_py(), []
            for first, last in sorted((r["first"], r["last"]) for r in runs.as_py() or ()):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], last + LENGTH)
                else:
                    spans.append([first, last + LENGTH])
            ends = [0, *(b for _, b in spans)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(text)], strict=True)))
            removed.append([{"start": a, "end": b} for a, b in spans])
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, spans_type)], names=names)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_contexts: int = SHARD_CONTEXTS
) -> DataFrame:
    """One row per document: doc_id, n_bytes, kept (remaining bytes), removed (array of start, end).

    Null texts are empty.  Texts under ``LENGTH`` bytes lose nothing.  Copies of a text, repeated rows
    among them, are removed whole.  Removing bytes can cut a character in two, so the rest is binary.
    Other columns are not read.
    """
    read = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("bytes")
    )
    read = read.withColumn("key", F.unhex(F.md5("bytes"))).withColumn("row", F.xxhash64("doc_id"))
    long_enough = read.filter(F.octet_length("bytes") >= LENGTH)
    runs = repeated_windows(long_enough, shard_contexts)
    by_key = runs.distinct().groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    by_key = write_scratch(by_key, "repeated-runs").df
    joined = read.join(by_key, "key", "left")
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    doc = F.struct("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes")).alias("doc")
    chosen = joined.select(doc, "bytes", "runs")
    schema = StructType(
        [chosen.schema["doc"], StructField("kept", BinaryType()), StructField("removed", ArrayType(span))]
    )
    return chosen.mapInArrow(_kept, schema).select("doc.*", "kept", "removed")


def digest(found: DataFrame) -> DataFrame:
    """Counts and checksum of what :func:`remove_repeats` leaves."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
