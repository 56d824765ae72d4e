"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of ``4 / 5`` or more.

Candidates come from SimHash, as ``simhash`` links fingerprints: the texts of a component form a list.  Many texts
at that similarity differ in some 5 to 15 of a SimHash's 64 bits, which no index of shared bytes reaches, so MinHash
adds lists: ``BANDS`` keys of ``BAND_ROWS`` minima each.  A pair at similarity s shares a key with probability
1 - (1 - s ^ BAND_ROWS) ^ BANDS, which is 0.999993 at 0.8.  All links are verified on the whole sets of shingle hashes.

Every pair of a list is compared, unless its texts are in one group already.  A base shares more with its copies than
they do with each other, so it stands in more and longer lists than they: each list first takes the member with the
most company as its hub and compares it with all others; then, in a second round, the member with the most
company that the first hub's group has not taken in.  Texts that are still outside the hub's group are open, and every
open text is compared with every text of its list.  That is quadratic in the open texts, so lists are dealt to cells
of at most some ``CELL_ROWS`` texts a side, and a cell compares bitmaps, a byte or two a shingle: what one set's bitmap has and the
other's lacks bounds the shingles they can share from above, so no link is lost and few pairs are left to verify.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from chronoweave.llm.common import parts_for
from chronoweave.llm.components import components
from chronoweave.llm.simhash import LOWER, SEED, fingerprint, fingerprint_links
from chronoweave.scratch import write_scratch

SHINGLE_WORDS = 5
BANDS, BAND_ROWS = 30, 5
#: Texts on a side of a cell, and bits of the longest bitmap; larger sets share bits, which only makes the bound less sharp.
CELL_ROWS = 1_024
SKETCH_BITS = 1 << 16
#: Pairs whose bitmaps are compared at a time.
PAIR_ROWS = 1 << 11
#: Shingles whose minima are taken at a time.
CHUNK = 1 << 12

_RANDOM = np.random.default_rng(SEED)
_FLIPS, _FACTORS = _RANDOM.integers(0, 1 << 64, (2, BANDS * BAND_ROWS), np.uint64)
_FACTORS |= np.uint64(1)
_MIX = _RANDOM.integers(0, 1 << 64, (BANDS, BAND_ROWS), np.uint64) | np.uint64(1)
_BAND = _RANDOM.integers(0, 1 << 64, BANDS, np.uint64)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle, one without words has none."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    width = min(SHINGLE_WORDS, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys under which a set of hashes is listed; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    least = np.full(BANDS * BAND_ROWS, (1 << 64) - 1, np.uint64)
    for i in range(0, len(hashes), CHUNK):
        np.minimum(least, ((hashes[i : i + CHUNK, None] ^ _FLIPS) * _FACTORS).min(axis=0), out=least)
    return (least.reshape(BANDS, BAND_ROWS) * _MIX).sum(axis=1, dtype=np.uint64) ^ _BAND


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _hashed(with_keys: bool):
    """Node (hash of the set) and size of each text, with its band keys and fingerprint or with the set."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                texts = part.column(1).cast(pa.binary())
                sets = [shingles(t.as_py()) for t in texts]
                nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
                lists = _lists([band_keys(s) for s in sets] if with_keys else sets)
                sizes = pa.array([len(s) for s in sets], pa.int32())
                columns, names = [part.column(0), pa.array(nodes), sizes, lists], ["row", "node", "size", "hashes"]
                if with_keys:
                    prints = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
                    columns, names = [*columns, pa.array(prints.view(np.int64))], [*names, "fp"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return hashed


def _read(docs: DataFrame, carried: Column, text: str, with_keys: bool) -> DataFrame:
    read = docs.select(carried.alias("row"), F.col(text).cast("string").alias("text"))
    fields = [StructField("node", LongType()), StructField("size", IntegerType()), StructField("hashes", ArrayType(LongType()))]
    fields += [StructField("fp", LongType())] if with_keys else []
    return read.mapInArrow(_hashed(with_keys), StructType([read.schema["row"], *fields]))


def simhash_lists(rows: DataFrame, n_rows: int) -> DataFrame:
    """(node, size, key): the nodes of each component of fingerprints that has several."""
    prints = write_scratch(rows.select("node", "size", "fp").distinct(), "near-prints", n_rows).df
    roots = components(fingerprint_links(prints.select("fp").distinct())).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = prints.join(roots, "fp", "left").select("node", "size", F.xxhash64(F.coalesce("root", "fp")).alias("key"))
    several = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return placed.join(several, "key").select("node", "size", "key")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) of nodes that share enough shingles: Jaccard 4 / 5 is 9 shared for 4 of both sizes together."""
    left = sets.select(F.col("node").alias("u"), F.col("hashes").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("hashes").alias("b"))
    both = pairs.join(left, "u").join(right, "v")
    return both.filter(9 * F.size(F.array_intersect("a", "b")) >= 4 * (F.size("a") + F.size("b"))).select("u", "v")


def _of_like_size(a: str, b: str) -> Column:
    """True of sizes that allow the similarity."""
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def _pairs(rows: DataFrame) -> DataFrame:
    """Ordered pairs (u, v) of the columns a and b, structs of node, size and root, that may still link."""
    may = (F.col("a.root") != F.col("b.root")) & _of_like_size("a.size", "b.size")
    ends = [f("a.node", "b.node").alias(name) for f, name in ((F.greatest, "u"), (F.least, "v"))]
    return rows.filter(may).select(*ends)


def _hubs(lists: DataFrame) -> DataFrame:
    """Each list's member with the most company."""
    return lists.groupBy("key").agg(F.max_by("one", F.struct("company", F.xxhash64("one.node"))).alias("hub"))


def _opened(lists: DataFrame) -> DataFrame:
    """Members of lists of several groups, with the list's hub, length and number of open texts: the hub's group has not taken them in."""
    with_hub = lists.join(_hubs(lists), "key").withColumn("open", F.col("one.root") != F.col("hub.root"))
    counts = with_hub.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("open").alias("n_open"))
    return with_hub.join(counts.filter("n_open > 0"), "key")


def sketch(hashes: np.ndarray) -> bytes:
    """Bitmap of a set: a bit for the low bits of each hash, 8 to 16 bits a member in a power of two."""
    width = min(1 << max(9, (8 * len(hashes) - 1).bit_length()), SKETCH_BITS)
    bits = np.zeros(width, bool)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends, flat = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy().view(np.uint64)
        bits = [sketch(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], names=["node", "bits"])


def _cells(lists: DataFrame, rows: int) -> DataFrame:
    """Members of lists with open texts, dealt to cells (key, i, j): every open text meets every text of its list in one.

    A cell compares its rows of side 0 with those of side 1, and in cells with i = j also with each other.  A short
    list is one cell, with its open texts on side 0.  The open texts of a longer one come in blocks, numbered before
    the blocks of its other texts, and each block of open texts meets all blocks.
    """
    short, draw = F.col("n") <= rows, F.xxhash64("one.node", F.lit(SEED))
    n_blocks = lambda n: F.when(short, 1).otherwise(F.ceil(n / F.lit(rows)))
    blocked = lists.select("key", "one", "open", short.alias("short"), n_blocks(F.col("n_open")).alias("ko"), n_blocks(F.col("n") - F.col("n_open")).alias("kc"), draw.alias("draw"))
    block = F.when(F.col("open"), F.pmod("draw", "ko")).when(F.col("short"), 0).otherwise(F.col("ko") + F.pmod("draw", "kc"))
    met = F.when(F.col("open") & ~F.col("short"), F.col("ko") + F.col("kc")).otherwise(F.col("ko"))
    dealt = blocked.select("key", "one", "open", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), met.cast("long") - 1)).alias("other"))
    side = (~F.col("open") | (F.col("other") < F.col("block"))).cast("int")
    return dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), side.alias("side"), "one.*")


def _may_link(size: np.ndarray, bits: pa.Array):
    """A function of two arrays of rows: which of their pairs may share enough, by sizes and bitmaps."""
    # Every bitmap has whole words of 64 bits.
    ends = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
    words, first = np.frombuffer(bits.buffers()[2], np.uint8, ends[-1]).view(np.uint64), ends[:-1] // 8
    width = np.diff(ends) // 8
    at, tables, counts = {}, {}, {}
    for w in np.unique(width).tolist():
        # Sets of like size have bitmaps of one width or of two that differ by a factor of two; the wider one is folded.
        own, wide = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        parts = [words[first[rows][:, None] + np.arange(n)] for rows, n in ((own, w), (wide, 2 * w))]
        tables[w] = np.concatenate([parts[0], parts[1][:, :w] | parts[1][:, w:]])
        counts[w] = np.bitwise_count(tables[w]).sum(axis=1, dtype=np.int64)
        at[w] = np.zeros(len(size), np.int64)
        at[w][np.concatenate([own, wide])] = np.arange(len(own) + len(wide))

    def may(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        kept = 5 * np.minimum(size[a], size[b]) >= 4 * np.maximum(size[a], size[b])
        least = np.minimum(width[a], width[b])
        for w in np.unique(least[kept]).tolist():
            here = np.flatnonzero(kept & (least == w))
            x, y = at[w][a[here]], at[w][b[here]]
            both = np.bitwise_count(tables[w][x] & tables[w][y]).sum(axis=1, dtype=np.int64)
            left, right = size[a[here]] - counts[w][x], size[b[here]] - counts[w][y]
            kept[here] = 9 * (np.minimum(left, right) + both) >= 4 * (size[a[here]] + size[b[here]])
        return kept

    return may


def _cell_pairs(cells: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) of whole cells, sorted by (key, i, j, side), that may link."""
    key, i, j, side, node, size, root = (cells.column(n).to_numpy() for n in ("key", "i", "j", "side", "node", "size", "root"))
    bits = cells.column("bits").combine_chunks().cast(pa.binary())
    may = _may_link(size.astype(np.int64), bits)
    n = len(key)
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    length = np.diff(np.r_[first, n])
    end = np.repeat(first + length, length)
    right = np.repeat(first + np.add.reduceat((side == 0).astype(np.int64), first), length)
    start = np.where(i == j, np.arange(n) + 1, right)
    count = np.where(side == 0, end - start, 0)
    before = np.r_[0, np.cumsum(count)]
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(before, before[row] + PAIR_ROWS, "right")) - 1)
        a = np.repeat(np.arange(row, stop), count[row:stop])
        b = start[a] + np.arange(len(a)) - (before[a] - before[row])
        differ = root[a] != root[b]
        a, b = a[differ], b[differ]
        if len(a):
            kept = may(a, b)
            u, v = node[a[kept]], node[b[kept]]
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])
        row = stop


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the cells in sorted batches; a cell cut by a batch's end waits for the next one."""
    rest = None
    for part in (batch.slice(at, 1_000) for batch in batches for at in range(0, batch.num_rows, 1_000)):
        table = pa.Table.from_batches([part])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        keys = [table.column(n).to_numpy() for n in ("key", "i", "j")]
        last = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))
        cut = int(last[-1]) + 1 if len(last) else 0
        rest = table.slice(cut)
        if cut:
            yield from _cell_pairs(table.slice(0, cut))
    if rest is not None:
        yield from _cell_pairs(rest)


def _all_pairs(lists: DataFrame, sets: DataFrame, rows: int, n_rows: int | None = None) -> DataFrame:
    """Pairs (u, v) of the open texts with all texts of other groups in their lists, but those whose bitmaps rule a link out."""
    held = sets.join(lists.select(F.col("one.node").alias("node")).distinct(), "node", "left_semi")
    bits = write_scratch(held.select("node", "hashes").mapInArrow(_sketched, "node long, bits binary"), "near-bits", n_rows).df
    cells = _cells(lists, rows).join(bits, "node").repartition(parts_for(lists), "key", "i", "j")
    order = ["key", "i", "j", "side"]
    return cells.sortWithinPartitions(*order).select(*order, "node", "size", "root", "bits").mapInArrow(_met, "u long, v long")


def node_roots(docs: DataFrame, rows: DataFrame, text: str = "text", exact: bool = True, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(u, v): the smallest node that each node reaches over links; smallest nodes have no row.

    All pairs of a list are compared whatever ``exact`` says, which callers may still give.
    """
    n_rows = rows.count()
    alike = write_scratch(simhash_lists(rows, n_rows), "near-alike", n_rows)
    index = rows.dropDuplicates(["node"]).select("node", "size", F.explode("hashes").alias("key")).unionByName(alike.df)
    keys = index.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    listed = write_scratch(index.join(keys, "key"), "near-lists", n_rows)
    # The nodes in lists, each with the sum of its lists' lengths; written, so that its size is known before the sets are exchanged for it.
    company = write_scratch(listed.df.groupBy("node").agg(F.sum("n").alias("company")), "near-company", n_rows)
    sets = _read(docs, F.lit(0), text, with_keys=False).join(company.df, "node", "left_semi").dropDuplicates(["node"])
    sets = write_scratch(sets.select("node", "hashes"), "near-sets", n_rows)
    everything = listed.df.drop("n").join(company.df, "node")
    links = None

    def placed() -> DataFrame:
        """All lists with their members' present roots."""
        at = F.col("node")
        if links is not None:
            roots = components(links).select(F.col("u").alias("node"), F.col("v").alias("root"))
            joined, at = everything.join(roots, "node", "left"), F.coalesce("root", "node")
        else:
            joined = everything
        return joined.select("key", F.struct("node", "size", at.alias("root")).alias("one"), "company")

    def linked(pairs: DataFrame) -> DataFrame:
        """Add the links among the pairs."""
        found = write_scratch(_verified(pairs.distinct(), sets.df), "near-links", n_rows).df
        return found if links is None else links.unionByName(found)

    lists = placed()
    links = linked(_pairs(lists.join(_hubs(lists), "key").select(F.col("one").alias("a"), F.col("hub").alias("b"))))
    second = write_scratch(_opened(placed()), "near-open", n_rows)
    rest = second.df.filter("open").select("key", "one", "company")
    again = second.df.select("key", F.col("one").alias("a")).join(_hubs(rest).withColumnRenamed("hub", "b"), "key")
    links = linked(_pairs(again))
    second.discard()
    opened = write_scratch(_opened(placed()), "near-open", n_rows)
    # Written, so that the number of pairs is known before the sets are exchanged for them.
    pairs = write_scratch(_all_pairs(opened.df, sets.df, cell_rows, n_rows).distinct(), "near-pairs", n_rows)
    links = linked(pairs.df)
    for table in (opened, alike, listed, company, pairs, sets):
        table.discard()
    return components(links)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", exact: bool = True) -> DataFrame:
    """One row of every group of near copies: that with the smallest id, then the smallest digest of its text.

    Rows without an id come after all others of their group.  Near copies link transitively; equal rows
    count once; texts without words are copies of each other.  All columns are returned as they are,
    whatever their names; an empty table gives an empty one.  No pair of a list is left out, whatever ``exact`` says.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(
        whole.alias("doc"),
        F.col(doc_id).alias("id"),
        F.col(text).cast("string").alias("text"),
        F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("digest"),
        F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "digest", "row")
    rows = write_scratch(_read(keyed, order, "text", with_keys=True), "near-rows")
    roots = node_roots(docs, rows.df, text, exact).select(F.col("u").alias("node"), F.col("v").alias("root"))
    nodes = rows.df.groupBy("node").agg(F.min("row").alias("row")).join(roots, "node", "left")
    stay = nodes.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("row").alias("row")).select("row.*")
    stay = write_scratch(stay, "near-stay", rows.df.count()).df
    rows.discard()
    same = (keyed["row"] == stay["row"]) & (keyed["digest"] == stay["digest"]) & keyed["id"].eqNullSafe(stay["id"])
    return keyed.join(stay, same, "left_semi").dropDuplicates(["id", "digest", "row"]).select("doc.*")
