"""Benchmark decontamination: find token windows of test items in training documents.

A native job.  Every item gives its windows of ``size`` words (an item with fewer words gives one
window of all its words).  Hashes of the windows form a set inside the plan, so documents are tested
where they are read: no window of a document is shuffled unless its hash is in the set.  Hits are then
verified on their words by a join.  A benchmark too large for such a set goes through a join on the
hashes instead, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import let, lower_ascii, row_bytes
from chronoweave.scratch import write_scratch
from chronoweave.skew import BROADCAST_ROWS

#: Fixed pattern of a word, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Window hashes a plan may hold; eight bytes each.
SET_ROWS = 50_000
#: Widest window, in bytes, of a table that is broadcast.
WINDOW_BYTES = 4_096


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, item_id: str, text: str, size: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: n (words), gram, hash, items (sorted ids as strings)."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w"))
    length = F.least(F.size("w"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("w") - length + 1)
    grams = F.transform(starts, lambda i: F.slice("w", i, length))
    windows = rows.filter(F.size("w") > 0).select("item", length.alias("n"), F.explode(F.array_distinct(grams)).alias("g"))
    return windows.groupBy("n", F.array_join("g", " ").alias("gram"), F.xxhash64("g").alias("hash")).agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )


def _hits_by_set(rows: DataFrame, hashes: dict[int, list[int]]) -> DataFrame:
    """Windows whose hash is in the set; the words of a document stay in its row."""
    found = []
    for n, values in sorted(hashes.items()):
        known = ",".join(f"{v}L" if v != -(2**63) else "(-9223372036854775807L - 1L)" for v in values)
        starts = (
            f"filter(if(size(w) < {n}, array(), sequence(1, size(w) - {n - 1})), i -> xxhash64(slice(w, i, {n})) IN ({known}))"
        )
        found.append(
            F.expr(f"transform({starts}, i -> struct(i AS start, {n} AS n, array_join(slice(w, i, {n}), ' ') AS gram))")
        )
    none = F.array().cast("array<struct<start:int,n:int,gram:string>>")
    return rows.withColumn("hits", F.concat(none, *found)).select("row", "key", "n_words", "hits")


def _hits_by_join(rows: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows that have an item window's hash, by a join; one row per hit."""
    def of_size(n: int) -> Column:
        starts = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - n + 1)).otherwise(F.array().cast("array<int>"))
        window = lambda i: F.struct(
            i.alias("start"),
            F.lit(n).alias("n"),
            F.xxhash64(F.slice("w", i, n)).alias("hash"),
            F.array_join(F.slice("w", i, n), " ").alias("gram"),
        )
        return F.transform(starts, window)

    every = F.concat(*map(of_size, sizes))
    exploded = rows.select("key", F.explode(every).alias("h")).select("key", "h.*")
    return exploded.join(windows.select("n", "hash").distinct(), ["n", "hash"], "left_semi").drop("hash")


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    set_rows: int = SET_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, ``keep``, n_words, spans (start word from 1, n words), items.

    ``spans`` are the occurring windows in order of start; ``items`` the sorted ids, as strings, of
    the items they belong to (an item without id counts in spans, not in ``items``).  Null and empty
    texts have no words; an empty benchmark hits nothing; repeated rows keep their own row.
    """
    windows = write_scratch(item_windows(items, item_id, item_text, size), "item-windows").df
    count, widest = row_bytes(windows, "gram")
    listed = windows.select("n", "hash").collect() if count <= set_rows else []
    read = docs.select(
        F.struct(F.col(doc_id).alias("doc_id"), *keep).alias("row"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    key = F.md5("text").alias("key")
    split = let(words(F.col("text")), lambda w: F.struct(w.alias("w"))).alias("t")
    rows = read.select("row", key, split).select("row", "key", F.col("t.w").alias("w"))
    rows = rows.withColumn("n_words", F.size("w"))
    if count <= set_rows:
        hashes: dict[int, list[int]] = {}
        for r in listed:
            hashes.setdefault(r["n"], []).append(r["hash"])
        rows = write_scratch(_hits_by_set(rows, hashes), "window-hits").df
        hits = rows.filter(F.size("hits") > 0).select("key", F.explode("hits").alias("h")).select("key", "h.*")
    else:
        sizes = [r["n"] for r in windows.select("n").distinct().collect()]
        hits = _hits_by_join(rows, windows, sizes)
    # Copies of a text share their hits.
    side = windows.select("gram", "n", "items")
    side = F.broadcast(side) if count <= BROADCAST_ROWS and widest <= WINDOW_BYTES else side
    per_text = (
        hits.distinct()
        .join(side, ["n", "gram"])
        .groupBy("key")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "n"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    def listed_hits(of: DataFrame) -> DataFrame:
        none = {"spans": F.array().cast("array<struct<start:int,n:int>>"), "items": F.array().cast("array<string>")}
        return of.select("row.*", "n_words", *((F.coalesce(c, empty) if c in of.columns else empty).alias(c) for c, empty in none.items()))

    if count > set_rows:
        return listed_hits(rows.join(per_text, "key", "left"))
    # Rows without a hit, nearly all, go nowhere.
    some = F.size("hits") > 0
    return listed_hits(rows.filter(some).join(per_text, "key", "left")).unionByName(listed_hits(rows.filter(~some)))


def words_hit(spans: Column) -> Column:
    """Number of words inside any of the ordered spans."""
    end = lambda s: s["start"] + s["n"]
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda a, s: F.struct(
            F.greatest(a["end"], end(s)).alias("end"),
            (a["hit"] + F.greatest(F.lit(0), end(s) - F.greatest(a["end"], s["start"]))).alias("hit"),
        ),
        lambda a: a["hit"],
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and item digest of :func:`find_contamination`."""
    hit = words_hit(F.col("spans")).cast("long")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without any hit, with all their columns as they are, whatever their names.

    Documents without words stay; an empty table gives an empty one.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    read = docs.select("doc_id", "text", whole.alias("_doc"))
    return find_contamination(read, items, keep=("_doc",)).filter(F.size("spans") == 0).select("_doc.*")
