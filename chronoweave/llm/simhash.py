"""SimHash near-dedup: 64-bit fingerprints linked at few differing bits.

A fingerprint is eight bytes, each a token of (position, value).  Two fingerprints that differ in at
most ``DISTANCE`` bits share at least 8 - DISTANCE of these tokens, so they share at least 4 of the
first 6: the inverted index lists fingerprints by every choice of ``PREFIX_SHARED`` tokens out of the
first ``PREFIX_SHARED + DISTANCE``.  Inside a list the shared bytes of each pair are counted, pairs
below the guaranteed minimum go, the rest is verified on its bits, and a list returns one link per
fingerprint: to the smallest that it reaches there.

A list longer than ``LIST_ROWS`` is not compared in pairs.  Two fingerprints differ in at most two
bits exactly if some point differs from each in at most one; so its fingerprints are grouped by their
65 such points and linked to the smallest of each group.  No link is lost and nothing grows with the
square of a list.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType

from chronoweave.llm.common import parts_for
from chronoweave.llm.components import components
from chronoweave.scratch import write_scratch

SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 2
#: Bytes a list's fingerprints share; 32 bits keep chance lists short up to some 10^10 fingerprints.
PREFIX_SHARED = 4
LIST_ROWS = 4_096
#: Shingles hashed at a time.
CHUNK = 1 << 16

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bits of each byte value, high bit first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None) -> int:
    """Fingerprint of a text, unsigned; without words zero."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    width = min(SHINGLE_WORDS, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros((8, 8), np.int64), len(starts)
    for i in range(0, total, CHUNK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + CHUNK], stops[i : i + CHUNK], strict=True)]
        octets = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        for place in range(8):
            counts[place] += np.bincount(octets[:, place], minlength=256) @ BYTE_BITS
    return int.from_bytes(np.packbits((2 * counts > total).ravel()).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        values = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc", "fp"])


def fingerprints(docs: DataFrame, carried: Column, text: str = "text") -> DataFrame:
    """(doc, fp) of every row; ``carried`` is kept as doc, fp holds the 64 bits as a long."""
    read = docs.select(carried.alias("doc"), F.col(text).cast("string").alias("text"))
    schema = StructType([read.schema["doc"], StructField("fp", LongType())])
    return read.mapInArrow(_fingerprints, schema)


def _index(nodes: DataFrame, distance: int) -> DataFrame:
    """Fingerprints listed by every choice of shared bytes: (key, fp)."""
    octet = lambda i: F.shiftrightunsigned("fp", 8 * (7 - i)).bitwiseAND(F.lit(255))
    keys = []
    for n, places in enumerate(combinations(range(PREFIX_SHARED + distance), PREFIX_SHARED)):
        key = F.lit(n).cast("long")
        for p in places:
            key = key * 256 + octet(p)
        keys.append(key)
    return nodes.select("fp", F.explode(F.array(*keys)).alias("key"))


def _within(left: np.ndarray, right: np.ndarray, distance: int) -> np.ndarray:
    """Pairs that share enough positional bytes and, verified, differ in few enough bits."""
    differ = left ^ right
    shared = (np.ascontiguousarray(differ).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    kept = shared >= 8 - distance
    kept[kept] = np.bitwise_count(differ[kept]) <= distance
    return kept


def _roots(values: np.ndarray, run: np.ndarray, distance: int) -> np.ndarray:
    """Index of the first row that each row reaches inside its run; rows are sorted by (run, value)."""
    root = np.arange(len(values))
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    longest = int(np.diff(np.r_[first, len(run)]).max())
    left, right = [], []

    def join() -> None:
        a, b = np.concatenate(left), np.concatenate(right)
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                break
            np.minimum.at(root, np.maximum(ra, rb)[open_], np.minimum(ra, rb)[open_])
            while (root[root] != root).any():
                root[:] = root[root]
        left.clear()
        right.clear()

    at, held = np.arange(len(values)), 0
    for step in range(1, longest):
        at = at[at + step < len(values)]
        at = at[run[at] == run[at + step]]
        # Rows that are joined already need no second link.
        new = at[root[at] != root[at + step]]
        new = new[_within(values[new], values[new + step], distance)]
        if len(new):
            left.append(new)
            right.append(new + step)
            held += len(new)
        if held > 4 * len(values):
            join()
            held = 0
    if left:
        join()
    return root


def _list_links(distance: int):
    """Links of the lists in sorted batches; a list cut by a batch's end waits for the next one."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.empty(0, np.int64), np.empty(0, np.uint64))

        def found(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            root = _roots(values, keys, distance)
            linked = root != np.arange(len(root))
            pair = [values[linked].view(np.int64), values[root[linked]].view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in pair], names=["u", "v"])

        for batch in batches:
            keys = np.concatenate([rest[0], batch.column(0).to_numpy()])
            values = np.concatenate([rest[1], batch.column(1).to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            rest = (keys[cut:], values[cut:])
            if cut:
                yield found(keys[:cut], values[:cut])
        if len(rest[0]):
            yield found(*rest)

    return links


def _hub_links(long_lists: DataFrame) -> DataFrame:
    """Links of fingerprints that stand in long lists, over points that differ in at most one bit."""
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)))
    points = long_lists.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("v"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return points.join(least, "point").filter("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def fingerprint_links(nodes: DataFrame, distance: int = DISTANCE, list_rows: int = LIST_ROWS) -> DataFrame:
    """Links (u, v) that join distinct fingerprints as ``distance`` or fewer differing bits would.

    Lists longer than ``list_rows`` go over points one bit away, which is exact for a distance of 2 only.  Under
    any other distance every list compares all its pairs: the links are whole, but the work grows with
    the square of the longest list.
    """
    if distance != 2:
        list_rows = 1 << 62
    index = _index(nodes, distance)
    lists = index.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    listed = write_scratch(index.join(lists, "key"), "simhash-lists").df
    short = listed.filter(F.col("n") <= list_rows).select("key", "fp").repartition(parts_for(nodes), "key")
    # Unsigned order inside a list is not needed, only runs of equal keys.
    links = short.sortWithinPartitions("key", "fp").mapInArrow(_list_links(distance), "u long, v long")
    hubs = listed.filter(F.col("n") > list_rows).select("fp").distinct()
    return links.unionByName(_hub_links(hubs))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    distance: int = DISTANCE,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """One row per document: doc_id, ``keep``, fp (long), component_id.

    ``component_id`` is the smallest doc_id reachable over links, null only where no reachable row has
    one.  Null and empty texts have fingerprint zero and are linked like any other.  Repeated rows keep
    their own row; an empty table gives none.
    """
    carried = F.struct(F.col(doc_id).alias("doc_id"), *keep)
    rows = write_scratch(fingerprints(docs, carried, text), "simhash").df
    nodes = write_scratch(rows.groupBy("fp").agg(F.min("doc.doc_id").alias("least")), "simhash-nodes").df
    roots = components(fingerprint_links(nodes, distance, list_rows)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = placed.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc.*", "fp", "component_id")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal, component_id."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
