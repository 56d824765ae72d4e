"""URL filters: exact membership in a key list from a cascade of Bloom filters.

A native job.  Level 0 encodes the listed keys; level 1 encodes those other keys of the corpus that
level 0 takes for listed; level 2 the listed keys that level 1 takes for them; and so on until a level
makes no mistake.  Level 0 has bits in proportion to the logarithm of universe over list, so that about as many
keys as are listed slip through it: every level is bounded by the list, however large the universe.  Over the corpus's complete key universe the first level that denies a key decides,
so the answer is exact.  Filters are arrays of 64-bit words inside the plan: no join is needed.

A list too long for one such filter is cut into shards by key hash and answered per distinct key,
shard by shard, with bounded filters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import UPPER
from chronoweave.scratch import write_scratch

#: Keys one cascade may list; its first level then has at most eight megabytes, in a universe of 2 ^ 40 keys.
SHARD_KEYS = 1_000_000
#: Least bits and hashes of a key in any level.
BITS_PER_KEY = 12
HASHES = 4


@dataclass(frozen=True)
class Cascade:
    """Bloom filters by level; each is a number of hashes and a list of 64-bit words."""

    levels: tuple[tuple[int, tuple[int, ...]], ...]

    def member(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            held = _held(key, level, *self.levels[level])
            answer = F.when(held, answer).otherwise(F.lit(level % 2 == 1))
        return answer


def _bits(key: Column, level: int, size: int, hashes: int) -> list[Column]:
    """Bit places of a key: independent hashes that differ by level."""
    return [F.pmod(F.xxhash64(F.lit(level), F.lit(h), key), F.lit(size)) for h in range(hashes)]


def _held(key: Column, level: int, hashes: int, words: tuple[int, ...]) -> Column:
    stored = F.array(*map(F.lit, words)) if len(words) < 64 else F.from_json(
        F.lit("[" + ",".join(map(str, words)) + "]"), "array<bigint>"
    )
    held = F.lit(True)
    for bit in _bits(key, level, 64 * len(words), hashes):
        word = F.get(stored, F.floor(bit / 64).cast("int"))
        held = held & (F.getbit(word, (bit % 64).cast("int")) == 1)
    return held


def level_shape(keys: int, others: int) -> tuple[int, int]:
    """Bits and hashes a key of a filter of ``keys`` keys that should take about as many of the others for its own."""
    doubt = math.log2(max(others / max(keys, 1), 1))
    bits = max(BITS_PER_KEY, math.ceil(doubt / math.log(2)) + 1)
    return bits, max(HASHES, round(bits * math.log(2)) if bits > BITS_PER_KEY else HASHES)


def _build_level(keys: DataFrame, count: int, level: int, shape: tuple[int, int]) -> tuple[int, tuple[int, ...]]:
    """Hashes and words of the filter of ``keys``, put together from partial words of every partition."""
    bits_per_key, hashes = shape
    words = max(1, math.ceil(count * bits_per_key / 64))
    bits = keys.select(F.explode(F.array(*_bits(F.col("key"), level, 64 * words, hashes))).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit % 64 AS int))")
    # At most a word for every few keys of a shard comes to the driver, which puts them into the plan.
    rows = bits.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.bit_or(one).alias("bits")).collect()
    filled = [0] * words
    for r in rows:
        filled[r["word"]] = r["bits"]
    return hashes, tuple(filled)


def build_cascade(universe: DataFrame) -> Cascade:
    """Cascade of a written table (key, listed) of distinct keys; at most ``SHARD_KEYS`` keys are listed."""
    levels: list[tuple[int, tuple[int, ...]]] = []
    pending = universe
    while True:
        level = len(levels)
        inside, outside = F.col("listed") == (level % 2 == 0), F.col("listed") == (level % 2 == 1)
        keys = pending.filter(inside).select("key")
        sizes = pending.agg(F.count_if(inside).alias("keys"), F.count_if(outside).alias("others")).first()
        if not sizes["keys"]:
            break
        levels.append(_build_level(keys, sizes["keys"], level, level_shape(sizes["keys"], sizes["others"])))
        # What stays in doubt: the keys just written, and others that the level mistakes for them.
        mistaken = outside & _held(F.col("key"), level, *levels[-1])
        pending = pending.filter(inside | mistaken)
    return Cascade(tuple(levels))


def host_of(url: Column) -> Column:
    """Host of a URL, A-Z lower-cased; empty if the URL is null or has no ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """Path of a URL up to ``?``, ``#`` or its end; empty if the URL is null or has no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_keys(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Keys of a URL that can be rules: suffixes of the host times prefixes of the path, longest first.

    Only the label counts and path lengths that occur in ``rules`` are tried.
    """
    labels = sorted({h.count(".") + 1 for _, h, _ in rules})
    lengths = sorted({len(p) for _, _, p in rules})
    parts = [
        F.when(F.char_length(path) >= n, F.concat(F.substring_index(host, ".", -k), F.substring(path, 1, n)))
        for k in labels
        for n in lengths
    ]
    found = F.array_distinct(F.array_compact(F.array(*parts)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(
            F.reverse(F.array_sort(F.transform(found, lambda k: F.struct(F.char_length(k), k.alias("k"))))),
            lambda s: s["k"],
        )
    )


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    page_id: str = "page_id",
    url: str = "url",
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` are (verdict, host, path).  The longest fitting rule decides.  Pages without one are
    blocked if their host is listed, else allowed.  Listed are hosts with more pages that rules block
    than pages that rules allow, both counted over the whole table.  Rules and hosts are keys of one
    cascade.  A null URL or one without ``://`` has an empty host, fits no rule and is allowed.
    Repeated pages keep their rows; other columns are not read.
    """
    raw = F.col(url).cast("string")
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(raw).alias("host"), path_of(raw).alias("path"))
    rows = rows.withColumn("keys", rule_keys(F.col("host"), F.col("path"), rules))
    rows = write_scratch(rows, "url-keys").df
    spark = pages.sparkSession
    universe = rows.select(F.explode("keys").alias("key")).distinct()
    named = {h + p: v for v, h, p in rules}
    rule_list = F.array(*map(F.lit, sorted(named)))
    ruled = write_scratch(universe.select("key", F.array_contains(rule_list, F.col("key")).alias("listed")), "url-rules").df
    is_rule = build_cascade(ruled)
    verdicts = [F.struct(F.lit(k).alias("key"), F.lit(v == "block").alias("listed")) for k, v in sorted(named.items())]
    blocks = build_cascade(spark.range(1).select(F.inline(F.array(*verdicts))))
    rule = F.get(F.filter("keys", is_rule.member), F.lit(0))
    judged = rows.withColumn("rule", rule).withColumn(
        "verdict", F.when(F.col("rule").isNotNull(), F.when(blocks.member(F.col("rule")), "block").otherwise("allow"))
    ).drop("keys")
    judged = write_scratch(judged, "url-rule-verdicts").df
    hosts = judged.groupBy(F.col("host").alias("key")).agg(
        (F.count_if(F.col("verdict") == "block") > F.count_if(F.col("verdict") == "allow")).alias("listed")
    )
    hosts = write_scratch(hosts, "url-hosts").df
    listed = hosts.filter("listed").count()
    shards = max(1, math.ceil(listed / shard_keys))
    if shards == 1:
        by_list = F.when(build_cascade(hosts).member(F.col("host")), "block").otherwise("allow")
        return judged.withColumn("verdict", F.coalesce("verdict", by_list))
    return _judge_in_shards(judged, hosts, shards)


def _judge_in_shards(judged: DataFrame, hosts: DataFrame, shards: int) -> DataFrame:
    """Hosts answered shard by shard, each with its own bounded cascade."""
    shard = lambda c: F.pmod(F.xxhash64(F.lit("shard"), c), F.lit(shards))
    out = judged
    for k in range(shards):
        cascade = build_cascade(hosts.filter(shard(F.col("key")) == k))
        mine = F.col("verdict").isNull() & (shard(F.col("host")) == k)
        verdict = F.when(mine, F.when(cascade.member(F.col("host")), "block").otherwise("allow"))
        # Each shard's filters leave the plan with its pass.
        out = write_scratch(out.withColumn("verdict", F.coalesce(verdict, "verdict")), "url-shard").df
    return out
