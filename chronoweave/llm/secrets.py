"""Secret scans: spans of credentials in texts, weighed by how many owners hold the same value.

A native job.  Positions come from the lengths of the pieces between matches, so no function that
walks a text row by row in Python is needed.  Every candidate value is hashed; hashes are counted by
distinct repository and owner over the whole corpus.  A value that many owners hold is a copied
example, one that a single owner holds looks live.  Free-standing random tokens, which no pattern
names, become spans only when a single owner holds them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import let, running_total
from chronoweave.scratch import write_scratch

#: Fixed patterns and least lengths.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 12
#: Runs too short fail as a whole here, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
#: A free-standing token, with a digit, that may be a credential of unknown form.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"
#: Every assignment holds one of these, in lower case.
KEYWORDS = ("passw", "secret", "token", "key")
TOKEN_CHARACTERS = 10
KINDS = ("assign", "access", "hex", "owner")
#: Owners from which on a value counts as a copied example.
EXAMPLE_OWNERS = 3
#: Repositories from which on it does, even if they are all of one owner.
EXAMPLE_REPOS = 100


def _matches(text: Column, pattern: str, build) -> Column:
    """Array of ``build(match, start, end)`` for the leftmost non-overlapping matches; code points."""

    def located(hits: Column) -> Column:
        def from_gaps(gaps: Column) -> Column:
            lengths = F.transform(hits, lambda h, i: F.char_length(h) + F.char_length(gaps[i]))
            return let(
                running_total(lengths),
                lambda ends: F.transform(hits, lambda h, i: build(h, ends[i] - F.char_length(h), ends[i])),
            )

        return let(F.split(text, pattern, -1), from_gaps)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def _span(kind: str):
    def build(value: Column, start: Column, end: Column) -> Column:
        return F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), value.alias("value")
        )

    return build


def _tokens(text: Column) -> Column:
    """Random-looking tokens outside of assignments that hold no other kind of span."""

    def in_gaps(gaps: Column) -> Column:
        hits = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0))
        sizes = F.transform(gaps, lambda g, i: F.char_length(g) + F.coalesce(F.char_length(F.get(hits, i)), F.lit(0)))

        def shifted(ends: Column) -> Column:
            def of_gap(gap: Column, i: Column) -> Column:
                base = F.when(i > 0, ends[i - 1]).otherwise(F.lit(0))
                return _matches(gap, TOKEN, lambda h, s, e: _span("owner")(h, s + base, e + base))

            return F.flatten(F.transform(gaps, of_gap))

        return let(running_total(sizes), shifted)

    return F.filter(let(F.split(text, ASSIGN, -1), in_gaps), _random)


def _random(token: Column) -> Column:
    """Whether a token has letters, digits and variety, and holds no span of another kind."""
    value = token["value"]
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~value.rlike(f"{ACCESS}|{HEX}")
        & (F.size(F.array_distinct(F.split(value, ""))) >= TOKEN_CHARACTERS)
    )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans``: array of (start, kind, end, value) of base spans and candidate tokens."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def whole(t: Column) -> Column:
        # Plain searches tell most texts without any match from the others.
        none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
        keyword = let(F.lower(t), lambda low: reduce(or_, (F.contains(low, F.lit(k)) for k in KEYWORDS)))
        only_if = lambda test, spans: F.when(test, spans).otherwise(none)
        assign = F.filter(
            _matches(t, ASSIGN, _span("assign")),
            lambda m: F.char_length(F.regexp_extract(m["value"], f"^{ASSIGN}$", 2)) >= ASSIGN_LEAST,
        )
        tokens = F.when(keyword, _tokens(t)).otherwise(F.filter(_matches(t, TOKEN, _span("owner")), _random))
        return F.concat(
            only_if(keyword, assign),
            only_if(F.contains(t, F.lit("AKIA")), _matches(t, ACCESS, _span("access"))),
            only_if(t.rlike(HEX), _matches(t, HEX, _span("hex"))),
            only_if(t.rlike(TOKEN), tokens),
        )

    return docs.withColumn("spans", let(value, whole))


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct repositories and owners per candidate hash; (hash, repo, owner) -> (hash, repos, owners).

    Each count first removes repeats by its own key, so a value that a third of all rows hold is
    merged before the shuffle and never gathered.  A null owner counts as one unknown owner.
    """
    repos = candidates.groupBy("hash", "repo").agg(F.lit(1).alias("_")).groupBy("hash").agg(F.count("*").alias("repos"))
    owners = (
        candidates.groupBy("hash", "owner").agg(F.lit(1).alias("_")).groupBy("hash").agg(F.count("*").alias("owners"))
    )
    return repos.join(owners, "hash")


def find_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repo: str | None = None
) -> DataFrame:
    """One row per document: doc_id, base and spans (arrays of start, kind, end), n_example, n_live, n_repos.

    A value is an example if ``EXAMPLE_OWNERS`` owners or ``EXAMPLE_REPOS`` repositories hold it, and live if a single owner and
    fewer repositories do.  ``base`` holds every base span; ``spans`` adds the live tokens.  ``n_example`` and
    ``n_live`` count spans with such values, ``n_repos`` is the most repositories that hold one of the
    document's values.  ``repo`` defaults to the document itself.  Null and empty texts have no spans; repeated rows keep their
    own row; other columns are not read.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = scan(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(owner).cast("string").alias("owner"),
            F.col(repo or doc_id).cast("string").alias("repo"),
            value.alias("text"),
        )
    ).select(
        "doc_id",
        "owner",
        "repo",
        F.md5("text").alias("key"),
        F.transform(
            "spans",
            lambda s: F.struct(
                s["start"].alias("start"),
                s["kind"].alias("kind"),
                s["end"].alias("end"),
                F.sha2(
                    F.when(s["kind"] == 0, F.regexp_extract(s["value"], f"^{ASSIGN}$", 2)).otherwise(s["value"]), 256
                ).alias("hash"),
            ),
        ).alias("spans"),
    )
    rows = write_scratch(rows, "secret-spans").df
    found = rows.filter(F.size("spans") > 0)
    counts = ownership(found.select("repo", "owner", F.explode(F.array_distinct("spans.hash")).alias("hash")))
    # A verdict belongs to the text, so copies of a text share one.
    spans = found.select("key", F.explode("spans").alias("s")).select("key", "s.*").distinct()
    judged = spans.join(counts, "hash")
    example = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repos") >= EXAMPLE_REPOS)
    live = (F.col("owners") == 1) & ~example
    per_text = judged.groupBy("key").agg(
        F.collect_list(F.when((F.col("kind") == 3) & live, F.struct("start", "kind", "end"))).alias("added"),
        F.count_if(example & (F.col("kind") < 3)).alias("n_example"),
        F.count_if(live).alias("n_live"),
        F.max("repos").alias("n_repos"),
    )
    base = F.transform(
        F.filter("spans", lambda s: s["kind"] < 3), lambda s: F.struct(s["start"], s["kind"], s["end"])
    )
    kind = "array<struct<start:int,kind:int,end:int>>"
    none = F.array().cast(kind)
    with_base = lambda df: df.select("doc_id", "key", base.cast(kind).alias("base"))
    # Only rows with spans need a verdict; the others, empty texts among them, would meet under few keys.
    asked = with_base(found).join(per_text, "key").select("doc_id", "base", "added", "n_example", "n_live", "n_repos")
    zero = [F.lit(0).cast("long").alias(c) for c in ("n_example", "n_live", "n_repos")]
    rest = with_base(rows.filter(F.size("spans") == 0)).select("doc_id", "base", none.alias("added"), *zero)
    return asked.unionByName(rest).select(
        "doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", "added")).alias("spans"), "n_example", "n_live", "n_repos"
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest and listing of the spans of :func:`find_secrets`."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.col("n_example").cast("long").alias("n_example"),
        F.col("n_live").cast("long").alias("n_live"),
        F.col("n_repos").cast("long").alias("n_repos"),
    )
