"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

A native job.  Each source's documents stand in a shuffled order and form one stream of words, which
is read in blocks of equal size, from the start again at its end.  Slot ``i`` of the mix lies at the
point ``i * golden ratio`` modulo one; the source whose share of the cumulative targets covers the point
owns the slot, and the slot's rank among the source's slots is the block it takes.  The slots so decide
what is taken: a source gives the words of the slots it owns, which is its target to within a few blocks, as the
points of this sequence fall into every interval almost in proportion.

Points are integers modulo 2^31, so every engine finds the same ones.  Running numbers are taken inside small
cells and carried over by a table of cell sizes, so neither a source with a third of all rows nor its slots
ever meet in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import running_before
from chronoweave.ordering import positions
from chronoweave.scratch import write_scratch
from chronoweave.skew import BROADCAST_ROWS

#: Fixed pattern of a word, and weights of the sources by code point, null last, repeating.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: Budget as a fraction of all words, and times its size that a source may give.
BUDGET = (3, 2)
REPEATS = 2
BLOCK_WORDS = 2_048
#: Fewest slots of a mix, for which blocks of a small corpus are shorter.
LEAST_SLOTS = 1 << 16
#: Documents of a hash cell of a source's shuffled order, and slots of a cell of the schedule.
ORDER_CELL = 1_000
SLOT_CELL = 4_096
#: Points are numbers below GRID; the golden ratio's fraction of it is the step from slot to slot.
GRID = 1 << 31
GOLDEN = round((math.sqrt(5) - 1) / 2 * GRID) | 1
#: Cells of the grid for the lookup of a point's source.
POINT_CELLS = 4_096


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Words each source owes the mix; (source, size) -> (source, size, weight, target double, take long).

    Sources above ``REPEATS`` times their size are held there and the rest is shared again by weight
    until none is above.  Each round is one aggregate over the sources.
    """
    last = F.col("source").isNull()
    ranked = positions(sizes.withColumn("last", last), ["last", "source"], "place")
    weight = F.array(*map(F.lit, weights))[((F.col("place") - 1) % len(weights)).cast("int")]
    table = write_scratch(ranked.select("source", "size", weight.cast("long").alias("weight")), "source-sizes").df
    above = F.lit(False)
    held = -1
    total = table.agg(F.sum("size")).first()[0] or 0
    while True:
        row = table.agg(
            F.count_if(above).alias("held"),
            F.coalesce(F.sum(F.when(above, F.col("size"))), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        # Twice the words left to share, an exact integer.
        left = F.lit(total * BUDGET[0] * 2 // BUDGET[1] - 2 * REPEATS * row["words"])
        share = F.col("weight") * left / F.lit(2 * max(row["weight"], 1))
        if row["held"] == held:
            break
        held = row["held"]
        above = above | (F.col("weight") * left > F.lit(2 * REPEATS * row["weight"]) * F.col("size"))
    target = F.when(above, (REPEATS * F.col("size")).cast("double")).otherwise(share.cast("double"))
    take = F.least(F.round("target").cast("long"), REPEATS * F.col("size"))
    return table.withColumn("target", target).withColumn("take", take)


def schedule(table: DataFrame, block_words: int, step: int = GOLDEN) -> DataFrame:
    """Slots of the mix: (sid, rank, slot), as many as the words owed fill.

    ``table`` has sid and take (words owed).  A slot's point is ``slot * step`` modulo ``GRID``.
    """
    owed = table.filter("take > 0")
    total = owed.agg(F.sum("take").alias("words"), F.count("*").alias("sources")).first()
    words, slots = total["words"] or 1, -(-(total["words"] or 0) // block_words)
    shares = running_before(owed.withColumn("group", F.floor(F.col("sid") / 1_000)), [], "group", ["sid"], F.col("take"), "before")
    bound = lambda c: F.floor(c / F.lit(words) * GRID).cast("long")
    shares = shares.select("sid", bound(F.col("before")).alias("low"), bound(F.col("before") + F.col("take")).alias("high")).filter("low < high")
    width = GRID // POINT_CELLS
    cell = lambda c: F.floor(c / width)
    lookup = shares.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))))
    lookup = F.broadcast(lookup) if total["sources"] <= BROADCAST_ROWS else lookup
    point = (F.col("slot") % GRID) * F.lit(step) % GRID
    points = table.sparkSession.range(slots).withColumnRenamed("id", "slot").withColumn("point", point).withColumn("cell", cell(F.col("point")))
    owned = points.join(lookup, "cell").filter("point >= low AND point < high").select("sid", "slot")
    owned = owned.withColumn("slots", F.floor(F.col("slot") / SLOT_CELL))
    return running_before(owned, ["sid"], "slots", ["slot"], F.lit(1), "rank").select("sid", "rank", "slot")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int | None = None,
    keep: tuple[str, ...] = (),
    step: int = GOLDEN,
) -> tuple[DataFrame, DataFrame]:
    """Place every document's words in the mix; returns (documents, pieces).

    Documents: doc_id, ``keep``, size, source_size, target, taken, first_slot (null where nothing is taken).
    Pieces: sid and at (the document's place in its source), rank and slot (the block), words.  A block
    has ``BLOCK_WORDS`` words, fewer if the mix would have less than ``LEAST_SLOTS`` slots.  Documents
    without words take part with nothing taken; repeated rows are documents of their own; a null source is
    a source, the last one; an empty table gives two empty tables.
    """
    rows = docs.select(
        F.struct(F.col(doc_id).alias("doc_id"), *keep).alias("row"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.concat_ws("|", F.col(doc_id).cast("string"))).alias("draw"),
    )
    rows = write_scratch(rows, "mix-sizes").df
    sizes = write_scratch(rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")), "mix-sources").df
    table = positions(targets(sizes.select("source", "size"), weights), [F.col("source").isNull(), "source"], "sid")
    counted = sizes.select(F.col("source").alias("_source"), "docs")
    table = table.join(counted, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    table = write_scratch(table, "mix-targets").df
    total = table.agg(F.sum("take").alias("words"), F.count("*").alias("sources")).first()
    block_words = block_words or max(1, min(BLOCK_WORDS, (total["words"] or 0) // LEAST_SLOTS))
    slots = write_scratch(schedule(table, block_words, step), "mix-slots").df
    owned = slots.groupBy("sid").agg(F.count(F.lit(1)).alias("slots"))
    take = F.least(F.coalesce("slots", F.lit(0)) * block_words, REPEATS * F.col("size"))
    side = table.join(owned, "sid", "left").select(
        F.col("source").alias("_source"), "sid", F.col("size").alias("source_size"), "target", take.alias("take"), "docs"
    )
    side = F.broadcast(side) if total["sources"] <= BROADCAST_ROWS else side
    placed = rows.join(side, rows["source"].eqNullSafe(side["_source"])).drop("_source", "source")
    cells = F.ceil(F.col("docs") / ORDER_CELL)
    placed = placed.withColumn("cell", F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") % cells).drop("docs")
    placed = running_before(placed, ["sid"], "cell", ["draw", "size"], F.col("size"), "at")
    # Rows that tie in this order have the same id and size, so a second evaluation gives the same places.
    placed = placed.drop("cell") if keep else write_scratch(placed.drop("cell"), "mix-order").df
    # Each pass over the stream covers the document once; only what the source's slots reach counts.
    passes = F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))).alias("epoch")
    low = F.col("at") + F.col("epoch") * F.col("source_size")
    high = F.least(low + F.col("size"), F.col("take"))
    spans = (
        placed.filter("size > 0")
        .select("sid", "at", "size", "source_size", "take", passes)
        .select("sid", "at", low.alias("low"), high.alias("high"))
        .filter("low < high")
    )
    block = F.lit(block_words)
    ranks = F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))
    pieces = spans.withColumn("rank", F.explode(ranks)).withColumn(
        "words", F.least("high", (F.col("rank") + 1) * block) - F.greatest("low", F.col("rank") * block)
    )
    pieces = pieces.join(slots, ["sid", "rank"]).select("sid", "at", "rank", "slot", "words")
    taken = pieces.groupBy("sid", "at").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    # A document with words is the only one of its source at its place.
    full = placed.filter("size > 0").join(taken, ["sid", "at"], "left")
    none = placed.filter("size = 0").withColumns({c: F.lit(None).cast("long") for c in ("taken", "first_slot")})
    out = full.unionByName(none).select(
        "row.*", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot"
    )
    return out, pieces


def repeat_documents(docs: DataFrame) -> DataFrame:
    """Each document as many times as its share of the mix holds it, to the nearest whole number.

    All columns are returned as they are, whatever their names.  Documents without words go; an empty
    table gives an empty one.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows, _ = mix(docs.select("doc_id", "text", "source", whole.alias("_doc")), keep=("_doc",))
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    return rows.withColumn("_n", F.explode(F.array_repeat(F.lit(1), times))).select("_doc.*")
