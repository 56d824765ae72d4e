"""One query per operator over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import (
    decontaminate,
    html_text,
    merkle,
    mixing,
    periodic,
    quality,
    repeats,
    secrets,
    simhash,
    token_counts,
    token_files,
    topk,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_secret_scans")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by pattern and by ownership frequency."""
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op5_benchmark_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
    i AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
    g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM i),
    p AS (
      SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g))
    ),
    h AS (SELECT doc_id, p.i AS i, p.n AS n, item FROM p JOIN g ON p.n = g.n AND p.gram = g.gram),
    c AS (
      SELECT doc_id, count(DISTINCT pos) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id
    ),
    t AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id
    )
    SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.find_contamination(docs, items))


@query(
    "op6_source_mixing",
    r"""
    WITH d AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
      FROM documents
    ),
    s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
      FROM d GROUP BY source
    ),
    -- Sources in the order in which they reach twice their size; the first k are held there.
    o AS (
      SELECT *, row_number() OVER w AS k, coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
        sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size) OVER () AS total
      FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)
    ),
    f AS (
      SELECT min(k) AS k FROM o WHERE weight * (3 * total - 4 * held) <= 4 * rest * source_size
    ),
    l AS (
      SELECT CAST(3 * total - 4 * held AS BIGINT) AS share, CAST(rest AS BIGINT) AS rest FROM o WHERE k = (SELECT k FROM f)
    ),
    t AS (
      SELECT source, source_size,
        CASE WHEN k < (SELECT k FROM f) THEN CAST(2 * source_size AS DOUBLE)
          ELSE (weight * (SELECT share FROM l)) / (2 * (SELECT rest FROM l)) END AS target
      FROM o
    ),
    -- Cumulative words owed, the slots they fill, and the point of each slot.
    w AS MATERIALIZED (
      SELECT source, source_size, target, least(CAST(round(target) AS BIGINT), 2 * source_size) AS owed,
        row_number() OVER (ORDER BY source NULLS LAST) AS sid
      FROM t
    ),
    b AS MATERIALIZED (
      SELECT CAST(sum(owed) AS BIGINT) AS words, greatest(1, least(2048, CAST(sum(owed) AS BIGINT) // 65536)) AS block FROM w
    ),
    g AS MATERIALIZED (
      SELECT sid, CAST(floor((up - owed) / CAST(words AS DOUBLE) * 2147483648) AS BIGINT) AS low,
        CAST(floor(up / CAST(words AS DOUBLE) * 2147483648) AS BIGINT) AS high
      FROM (SELECT sid, owed, CAST(sum(owed) OVER (ORDER BY sid) AS BIGINT) AS up FROM w), b
    ),
    k AS MATERIALIZED (
      SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
      FROM (SELECT slot, slot * {golden} % 2147483648 AS point FROM (SELECT unnest(range((words + block - 1) // block)) AS slot FROM b))
      JOIN g ON point >= low AND point < high
    ),
    a AS MATERIALIZED (
      SELECT w.sid AS sid, source, source_size, target, block, least(coalesce(n, 0) * block, 2 * source_size) AS take
      FROM w LEFT JOIN (SELECT sid, count(*) AS n FROM k GROUP BY sid) AS o ON w.sid = o.sid CROSS JOIN b
    ),
    c AS (
      SELECT doc_id, a.sid AS sid, size, source_size, target, take, block,
        CAST(sum(size) OVER (PARTITION BY a.sid ORDER BY CAST('0x' || substr(draw, 1, 8) AS BIGINT) % cells, draw, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS pos
      FROM (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY source) / CAST(1000 AS DOUBLE)) AS BIGINT) AS cells FROM d) AS d
      JOIN a ON d.source IS NOT DISTINCT FROM a.source
    ),
    z AS (
      SELECT *, CASE WHEN size = 0 THEN CAST(0 AS BIGINT)
        ELSE size * (take // source_size) + greatest(0, least(pos + size, take % source_size) - pos) END AS taken
      FROM c
    )
    SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN slot END AS first_slot
    FROM z LEFT JOIN k ON z.sid = k.sid AND pos // block = rank
    """.format(golden=mixing.GOLDEN),
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents"))[0]


#: Fixed rules: verdict, host, start of the path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query(
    "op9_url_filters",
    r"""
    WITH p AS (
      SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
      FROM pages
    ),
    r AS (
      SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
      FROM p
    ),
    v AS (SELECT *, rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') AS blocked FROM r),
    h AS (SELECT host, count(*) FILTER (blocked) > count(*) FILTER (NOT blocked) AS listed FROM v GROUP BY host)
    SELECT page_id, v.host AS host, path, rule, CASE WHEN coalesce(blocked, listed) THEN 'block' ELSE 'allow' END AS verdict
    FROM v JOIN h ON v.host = h.host
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.digest(quality.score_documents(docs, labels))


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.digest(html_text.extract(table(spark, sf_dir, "pages")))


def token_file_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the documents' token ids, read them back and sum them up per document."""
    import public_tokenizers

    path = token_files.scratch_folder(spark, "token-ids")
    token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.digest(token_files.read_tokens(spark, path))


@query("op7_token_id_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets and checksums of every document's token ids, from the written files."""
    return token_file_rows(spark, table(spark, sf_dir, "documents"))


@query(
    "op2_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(topk.build_index(rows), rows.filter(F.col("vec_id") % topk.EVERY == 0))


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 200 bytes that also start elsewhere."""
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def _merkle_sql(levels: int = 12) -> str:
    """SQL twin of op11, level by level; it holds for up to 3 ** ``levels`` rows a source and as many sources."""
    parts = ("doc_id", "source", "lang", "n_chars", "{text}")
    field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field.format(p.format(text=text)) for p in parts) + ")"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    letters = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {letters}), lambda a, b: {bits}), 4294967295)"
    steps = [
        f"""WITH f AS MATERIALIZED (
          SELECT doc_id, {leaf("text")} AS leaf, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS sid,
            CASE WHEN coalesce({crc}, 0) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS tampered
          FROM documents
        ), g AS MATERIALIZED (
          SELECT *, row_number() OVER (PARTITION BY sid ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM f
        ), n0 AS MATERIALIZED (SELECT sid, place AS i, leaf AS d, count(*) OVER (PARTITION BY sid) AS c FROM g),
        t0 AS MATERIALIZED (SELECT doc_id, leaf, sid, sid AS source, place AS i, tampered AS h, '' AS p FROM g)"""
    ]
    run = "PARTITION BY sid, i // 3 ORDER BY i ROWS BETWEEN"
    for k in range(2 * levels):
        if k == levels:
            steps.append(f"r AS MATERIALIZED (SELECT sid AS source, d AS subroot FROM n{k})")
            steps.append(f"m AS MATERIALIZED (SELECT 0 AS sid, sid AS i, d, count(*) OVER () AS c FROM n{k})")
            steps.append(f"u AS MATERIALIZED (SELECT * REPLACE (0 AS sid, sid AS i) FROM t{k})")
        nodes, rows = ("m", "u") if k == levels else (f"n{k}", f"t{k}")
        steps.append(f"""s{k} AS MATERIALIZED (
          SELECT sid, i, c, CASE WHEN c > 1 THEN coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
            CASE WHEN c > 1 THEN coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r
          FROM {nodes}
        ), n{k + 1} AS MATERIALIZED (
          SELECT sid, i // 3 AS i, CASE WHEN c = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, (c + 2) // 3 AS c
          FROM {nodes} GROUP BY sid, i // 3, c
        ), t{k + 1} AS MATERIALIZED (
          SELECT doc_id, leaf, sid, source, i // 3 AS i, CASE WHEN c = 1 THEN h ELSE sha256(l || h || r) END AS h, p || l || r AS p
          FROM {rows} AS t JOIN s{k} AS s USING (sid, i)
        )""")
    last = 2 * levels
    return ",\n".join(steps) + f"""
        SELECT doc_id, leaf, subroot, d AS root, sha256(p) AS proof_sha256, h AS folded_root, h = d AS verified
        FROM t{last} JOIN r USING (source) CROSS JOIN (SELECT d FROM n{last})"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a copy without line breaks still folds to the root."""
    docs = table(spark, sf_dir, "documents")
    return merkle.digest(merkle.manifest(docs, candidate=merkle.without_line_breaks))


@query("op12_token_counts")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_counts.digest(token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of which have one planted, and the text without their repeats."""
    return periodic.digest(periodic.find_runs(periodic.planted(table(spark, sf_dir, "documents"))))
