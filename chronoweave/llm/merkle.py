"""Merkle dataset manifest: a content-addressed tree of digests, and every row's path to its root.

A row's leaf is the SHA-256 of its fields.  The leaves of one source, in order of their id, are hashed
three at a time until one node remains, the source's subroot; the subroots, in order of the source, are
hashed likewise to the root.

*Building.*  ``SEGMENT`` levels are built at once: 243 neighbouring nodes form a segment, whose inner
nodes become records (digest, children).  The segments' top nodes are the entries of the next round, so
a tree of 10^10 leaves takes five rounds, each with a 243rd of the rows of the one before.  A segment is
stored under its top node's digest; equal segments are stored once, or up to ``COPIES`` times, so that no
task has to answer all places that share a digest.

*Descent.*  A request starts at the root and goes down by the digits, to base three, of its rank.  In each segment the records say
which child a digit selects; the children not selected are the row's siblings on that level.  All requests below one
segment share the way to it, so only one row per segment travels through the upper levels, and a row's
own request is answered in the lowest segment, by one task that holds the segment and its 243 rows.  The
path is collected from the top and reversed at the end.

Ranks come from a range partition by (source, id, leaf): a row's place in its range plus the rows of its source in earlier
ranges, so a source with a third of all rows is spread like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import parts_for
from chronoweave.ordering import positions
from chronoweave.scratch import write_scratch
from chronoweave.skew import stored_side

#: Children of a node, and levels and leaves of a segment.
FAN = 3
SEGMENT = 5
LEAVES = FAN**SEGMENT
COPIES = 1_024
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<left: string, right: string>"
_NODES = "array<struct<digest: string, children: array<string>>>"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of fields in lowercase hex; a field is ``-`` if null, else its UTF-8 length, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def _levels(n: Column) -> Column:
    """Levels of a segment in a round of ``n`` entries: until one node remains, ``SEGMENT`` at most."""
    return F.size(F.filter(F.array(*(F.lit(FAN**j) for j in range(SEGMENT))), lambda p: p < n))


def _ranked(leaves: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """Number every leaf inside its source and every source; also returns (tree, n)."""
    order = ["source", "key", "leaf", "serial"]
    ranged = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number counts on inside a range; its high bits are the range.
    ranged = write_scratch(ranged.drop("serial", "key").withColumn("at", F.monotonically_increasing_id()), "merkle-ranges").df
    ranged = ranged.withColumn("range", F.shiftright("at", 33))
    found = ranged.groupBy("source", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    found = write_scratch(found, "merkle-counts").df
    sizes = found.groupBy("source").agg(F.sum("rows").alias("n"))
    sizes = write_scratch(positions(sizes, ["source"], "tree"), "merkle-sources").df
    # One row per range and source, fewer than ranges and sources together.
    earlier = "coalesce(sum(rows) OVER (PARTITION BY source ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    shift = found.selectExpr("source AS _source", "range", f"first - {earlier} AS shift")
    shift = shift.join(sizes.select("source", "tree"), F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    shift = stored_side(shift.select("_source", F.col("range").alias("_range"), "shift", "tree"))
    placed = ranged.join(shift, ranged["source"].eqNullSafe(shift["_source"]) & (F.col("range") == F.col("_range")))
    return placed.select("row", "tree", (F.col("at") - F.col("shift")).alias("rank"), "leaf", "candidate"), sizes.select("tree", "n")


def _raise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash the entries of segments up to one node each, and list the inner nodes."""
    for batch in batches:
        tops, nodes = [], []
        for levels, members in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            digests, records = [m["digest"] for m in sorted(members, key=lambda m: m["rank"])], []
            for _ in range(levels):
                runs = [digests[i : i + FAN] for i in range(0, len(digests), FAN)]
                digests = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
                records += ({"digest": d, "children": run} for d, run in zip(digests, runs, strict=True))
            tops.append(digests[0])
            nodes.append(records)
        kind = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
        columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(tops), pa.array(nodes, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "rank", "levels", "digest", "nodes"])


@dataclass
class Forest:
    """Trees over the same rounds: stored segments by round, and each tree's size, top node and round of it."""

    segments: list[DataFrame]
    tops: DataFrame
    parts: int

    @classmethod
    def build(cls, entries: DataFrame, sizes: DataFrame, parts: int) -> Forest:
        """Raise (tree, rank, digest) to one node a tree; ``sizes`` holds (tree, n)."""
        most = sizes.agg(F.max("n")).first()[0] or 0
        segments, tops, width = [], None, 1
        sizes = stored_side(sizes)
        while True:
            # Entries of this round; a tree has at least one round, so that single leaves are no special case.
            left = sizes.select("tree", F.ceil(F.col("n") / F.lit(width)).alias("n"))
            block = F.floor(F.col("rank") / LEAVES)
            cells = entries.join(left, "tree").select("tree", block.alias("block"), _levels(F.col("n")).alias("levels"), "rank", "digest")
            member = F.collect_list(F.struct("rank", "digest"))
            grouped = cells.repartition(parts, "tree", "block").groupBy("tree", "block").agg(F.first("levels").alias("levels"), member.alias("members"))
            raised = grouped.mapInArrow(_raise, f"tree long, rank long, levels int, digest string, nodes {_NODES}")
            raised = write_scratch(raised, "merkle-segments").df
            segments.append(raised)
            width *= LEAVES
            above = sizes.withColumn("left", F.ceil(F.col("n") / F.lit(width)))
            round_ = F.lit(len(segments))
            done = raised.join(above.filter("left = 1").select("tree"), "tree").select("tree", "digest", round_.alias("round"))
            tops = done if tops is None else tops.unionByName(done)
            if most <= width:
                return cls(segments, tops, parts)
            entries = raised.select("tree", "rank", "digest").join(above.filter("left > 1").select("tree"), "tree")

    def segments_below(self, starts: DataFrame) -> DataFrame:
        """Lowest segments with the way to them: (tree, block, levels, digest, nodes, path, carried).

        ``starts`` has tree, path (from the root down) and carried for every tree.
        """
        starts = self.tops.join(starts, "tree").select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path", "carried", "round")
        frontier = None
        for at in range(len(self.segments) - 1, -1, -1):
            here = starts.filter(F.col("round") == at + 1).drop("round")
            frontier = here if frontier is None else frontier.unionByName(here)
            copy = F.col("rank") % COPIES
            # A place keeps its own number; what is stored under a digest is looked up by the digest alone.
            stored = self.segments[at].select("digest", copy.alias("copy"), "levels", "nodes").dropDuplicates(["digest", "copy"])
            below = frontier.withColumn("copy", copy).join(stored, ["digest", "copy"]).withColumnRenamed("rank", "block")
            if at == 0:
                return below.select("tree", "block", "levels", "digest", "nodes", "path", "carried")
            frontier = _requests(below)


def _ways(digest: str, levels: int, records: dict[str, list[str]], ranks: list[int]) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """Digest and siblings (before, after; from the top down) that each rank descends to."""
    for rank in ranks:
        at, way = digest, []
        for level in range(levels - 1, -1, -1):
            children, digit = records[at], rank // FAN**level % FAN
            way.append(("".join(children[:digit]), "".join(children[digit + 1 :])))
            at = children[digit]
        yield at, way


def _paths(paths: list[list[tuple[str, str]]]) -> pa.Array:
    kind = [pa.field("left", pa.string()), pa.field("right", pa.string())]
    ends = np.concatenate(([0], np.cumsum([len(p) for p in paths]))).astype(np.int32)
    flat = [pa.array([step[side] for p in paths for step in p], pa.string()) for side in (0, 1)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(flat, fields=kind))


def _records(nodes) -> dict[str, list[str]]:
    return {n["digest"]: n["children"] for n in nodes}


def _steps(path) -> list[tuple[str, str]]:
    return [(s["left"], s["right"]) for s in path]


def _all_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One request per entry of each segment."""
    for batch in batches:
        for row in batch.to_pylist():
            records = _records(row["nodes"])
            ranks = range(_leaves(row["digest"], row["levels"], records))
            found = list(_ways(row["digest"], row["levels"], records, ranks))
            head, first = _steps(row["path"]), row["block"] * LEAVES
            columns = [
                pa.array([row["tree"]] * len(found), pa.int64()),
                pa.array([first + r for r in ranks], pa.int64()),
                pa.array([d for d, _ in found]),
                _paths([head + way for _, way in found]),
                pa.array([row["carried"]] * len(found), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "rank", "digest", "path", "carried"])


def _leaves(digest: str, levels: int, records: dict[str, list[str]]) -> int:
    """Entries below a segment's top node; only the last run of a level is shorter."""
    count = 1
    for _ in range(levels):
        children = records[digest]
        count, digest = FAN * (count - 1) + len(children), children[-1]
    return count


def _requests(segments: DataFrame) -> DataFrame:
    return segments.mapInArrow(_all_below, f"tree long, rank long, digest string, path array<{_STEP}>, carried string")


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Complete path, from the leaf up, of the rows of each segment."""
    for batch in batches:
        asked = batch.column(0)
        for at, row in enumerate(batch.drop_columns(["asked"]).to_pylist()):
            wanted = asked[at].values
            records, head = _records(row["nodes"]), _steps(row["path"])
            ranks = (wanted.field("rank").to_numpy() % LEAVES).tolist()
            ways = list(_ways(row["digest"], row["levels"], records, ranks))
            columns = [wanted.field("row"), pa.array([d for d, _ in ways]), _paths([(head + way)[::-1] for _, way in ways])]
            columns += [pa.array([row["carried"]] * len(ways), pa.string()), wanted.field("candidate")]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "leaf", "proof", "subroot", "candidate"])


def manifest(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    fields: tuple[str, ...] = FIELDS,
    keep: tuple[str, ...] = (),
    candidate: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per document: doc_id, ``keep``, leaf, subroot, root, proof, candidate.

    ``proof`` lists the levels from the leaf to the root, each with the digests of the siblings before
    (``left``) and behind (``right``) the node, joined as hex text; a lone node's step has two empty texts.
    ``candidate`` computes another digest, such as that of a later copy of the row, from the leaf and the columns of
    ``docs``; it is handed on with the row, to be folded over the proof.

    Ids ascend, null ids first; rows of one id stand in order of their leaf.  A null source is a source,
    the first one.  Null fields count as ``-``, empty texts as ``0:``.  Repeated rows are leaves of their own; an empty table gives an
    empty one.  Other columns are not read.  Columns in ``keep`` should be narrow: 243 rows meet in one value.
    """
    spark, parts = docs.sparkSession, parts_for(docs)
    leaf = leaf_digest([F.col(f) for f in fields])
    leaves = docs.select(
        F.struct(F.col(doc_id).alias("doc_id"), *keep).alias("row"),
        F.col(source).cast("string").alias("source"),
        F.col(doc_id).alias("key"),
        leaf.alias("leaf"),
        (candidate(leaf) if candidate else F.lit(None).cast("string")).alias("candidate"),
        F.monotonically_increasing_id().alias("serial"),
    )
    leaves, sizes = _ranked(write_scratch(leaves, "merkle-leaves").df, parts)
    trees = Forest.build(leaves.select("tree", "rank", F.col("leaf").alias("digest")), sizes, parts)
    # The one tree over the sources, which are numbered from one; its number is data, so that joins keep their key.
    subroots = trees.tops.select(F.lit(1).cast("long").alias("tree"), (F.col("tree") - 1).alias("rank"), "digest")
    subroots = write_scratch(subroots, "merkle-subroots").df
    one = spark.range(1, 2).select(F.col("id").alias("tree"), F.lit(subroots.count()).cast("long").alias("n"))
    top = Forest.build(subroots, one, parts)
    root = top.tops.first()
    nothing = F.expr(f"cast(array() AS array<{_STEP}>)")
    start = one.select("tree", nothing.alias("path"), F.lit("").alias("carried"))
    ways = _requests(top.segments_below(start)).select((F.col("rank") + 1).alias("tree"), "path", F.col("digest").alias("carried"))
    segments = trees.segments_below(stored_side(ways))
    asked = leaves.select("tree", F.floor(F.col("rank") / LEAVES).alias("block"), F.struct("rank", "row", "candidate").alias("one"))
    asked = asked.repartition(parts, "tree", "block").groupBy("tree", "block").agg(F.collect_list("one").alias("asked"))
    met = asked.join(segments, ["tree", "block"]).select("asked", "levels", "digest", "nodes", "path", "carried")
    row = leaves.schema["row"].dataType.simpleString()
    answered = met.mapInArrow(_answers, f"row {row}, leaf string, proof array<{_STEP}>, subroot string, candidate string")
    root = F.lit(root["digest"] if root else None).cast("string").alias("root")
    return answered.select("row.*", "leaf", "subroot", root, "proof", "candidate")


def folded(leaf: Column, proof: Column) -> Column:
    """Root that a leaf's digest and its siblings give."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def without_line_breaks(leaf: Column) -> Column:
    """Leaf of the row with the line breaks of its text deleted, where its id's crc32 is even; else the row's own leaf.

    Null ids count as the empty text, null texts stay null.
    """
    draw = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    other = leaf_digest([text if f == "text" else F.col(f) for f in FIELDS])
    return F.when((draw % 2 == 0) & F.contains(F.col("text"), F.lit("\n")), other).otherwise(leaf)


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, digest of the siblings, the root folded from the candidate and whether it holds."""
    siblings = F.array_join(F.transform("proof", lambda step: F.concat(step["left"], step["right"])), "")
    found = rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.col("candidate"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
