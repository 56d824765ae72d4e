"""Preparation, models and evaluation on the line-item model table."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bindings.cleaning import SPARSE, sparse
from bindings.enriching import paired
from bindings.registry import q6, query, r6
from bindings.tables import LINE_COLUMNS, LINE_KEYS, NUMERICS, hash_sql, with_views
from chronoweave.functions.scalars import key_hash
from chronoweave.operators import metrics as m
from chronoweave.operators import models as mo
from chronoweave.operators import prep as pr

LI = with_views("li")
PREDS = with_views("preds")
KEYS = ", ".join(LINE_KEYS)
FEATURES = ["m", "scaled_features"]
YEARS = [1995, 1996, 1997, 1998]
TEST_YEAR = 1999


def training_rows(x):
    return x.li.filter(F.col("y") < TEST_YEAR)


def test_rows(x):
    return x.li.filter(F.col("y") == TEST_YEAR)


def prepared(x):
    """Balanced training rows and untouched test rows, both through a pipeline fitted on unbalanced training rows."""
    train = training_rows(x)
    balanced = pr.undersample_majority(train, "label", "y", LINE_KEYS)
    _, tables = pr.fit_and_apply(pr.prep_pipeline(NUMERICS), train, balanced, test_rows(x))
    return tables[0].unionByName(tables[1])


@query(
    "undersample_majority",
    with_views("li", extra="""r AS (SELECT y, least(coalesce(count(*) FILTER (label = 1) / CAST(nullif(count(*) FILTER (label = 0), 0) AS DOUBLE), 1), 1) AS ratio
  FROM li WHERE y < 1999 GROUP BY y)""")
    + f"""SELECT {KEYS}, label, li.y FROM li JOIN r ON li.y = r.y
WHERE label = 1 OR {hash_sql(*LINE_KEYS)} < ratio * CAST(4294967296 AS DOUBLE)""",
)
def _(x):
    return pr.undersample_majority(training_rows(x), "label", "y", LINE_KEYS).select(*LINE_KEYS, "label", "y")


@query(
    "blocked_time_split",
    LI + "SELECT y, CASE WHEN m <= 9 THEN 'train' ELSE 'validation' END AS role, label, count(*) AS n FROM li GROUP BY ALL",
)
def _(x):
    roles = x.li.withColumn("role", pr.blocked_time_split(F.col("m")))
    return roles.groupBy("y", "role", "label").agg(F.count("*").alias("n"))


@query(
    "impute_median",
    SPARSE
    + f"""SELECT event_id, {q6('coalesce(value, (SELECT quantile_cont(value, 0.5) FROM sparse))')} AS value_imputed,
  {q6('coalesce(mostly, (SELECT quantile_cont(mostly, 0.5) FROM sparse))')} AS mostly_imputed FROM sparse""",
)
def _(x):
    filled = pr.impute_median(sparse(x), ["value", "mostly"])
    return filled.select("event_id", r6("value_imputed").alias("value_imputed"), r6("mostly_imputed").alias("mostly_imputed"))


@query("impute_median_fitted")
def _(x):
    """The fitted estimator form used inside pipelines; its median is approximate."""
    return pr.impute_table(sparse(x), ["value", "mostly"]).select("event_id", "value_imputed", "mostly_imputed")


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM sparse WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "impute_mode",
    SPARSE
    + f"""SELECT event_id, coalesce(user_id, {_mode('user_id')}) AS user_id_imputed, coalesce(mostly, {_mode('mostly')}) AS mostly_imputed,
  coalesce(CASE WHEN event_id % 5 <> 0 THEN event_type END,
    (SELECT event_type FROM sparse WHERE event_id % 5 <> 0 GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)) AS kind_imputed
FROM sparse""",
)
def _(x):
    rows = sparse(x).withColumn("kind", F.when(F.col("event_id") % 5 != 0, F.col("event_type")))
    return pr.impute_mode(rows, ["user_id", "mostly", "kind"]).select("event_id", "user_id_imputed", "mostly_imputed", "kind_imputed")


@query("assemble_features", f"SELECT {KEYS}, l_quantity AS f0, l_tax AS f3, {q6('l_quantity + l_extendedprice + l_discount + l_tax')} AS total FROM lineitem")
def _(x):
    made = pr.assemble_features(NUMERICS).transform(x.lineitem)
    parts = vector_to_array("features")
    total = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    return made.select(*LINE_KEYS, parts[0].alias("f0"), parts[3].alias("f3"), r6(total).alias("total"))


@query("vector_to_array", f"SELECT {KEYS}, 4 AS width, l_extendedprice AS price FROM lineitem")
def _(x):
    made = pr.array_features(pr.assemble_features(NUMERICS).transform(x.lineitem), "features")
    return made.select(*LINE_KEYS, F.size("features_array").alias("width"), F.col("features_array")[1].alias("price"))


def _scaled(c: str, scope: str = "li") -> str:
    lo, hi = f"(SELECT min({c}) FROM {scope})", f"(SELECT max({c}) FROM {scope})"
    return q6(f"({c} - {lo}) / ({hi} - {lo})")


@query("minmax_scale", LI + f"SELECT {KEYS}, {_scaled('l_quantity')} AS quantity, {_scaled('l_extendedprice')} AS price FROM li")
def _(x):
    made = pr.minmax_table(x.lineitem, ["l_quantity", "l_extendedprice"])
    return made.select(*LINE_KEYS, r6("l_quantity_scaled").alias("quantity"), r6("l_extendedprice_scaled").alias("price"))


@query("minmax_scale_vector", LI + f"SELECT {KEYS}, {_scaled('l_quantity')} AS quantity, {_scaled('l_extendedprice')} AS price FROM li")
def _(x):
    """The fitted scaler gives the same values as the column-wise form."""
    vectors = pr.assemble_features(["l_quantity", "l_extendedprice"]).transform(x.lineitem)
    scaled = pr.minmax_scale().fit(vectors).transform(vectors)
    parts = vector_to_array("scaled_features")
    return scaled.select(*LINE_KEYS, r6(parts[0]).alias("quantity"), r6(parts[1]).alias("price"))


@query(
    "prep_pipeline",
    with_views("li", extra="train AS (SELECT * FROM li WHERE y < 1999)")
    + f"""SELECT {KEYS}, {_scaled('l_quantity', 'train')} AS quantity, {_scaled('l_extendedprice', 'train')} AS price,
  {_scaled('l_tax', 'train')} AS tax FROM li WHERE y = 1999""",
)
def _(x):
    """Bounds come from the training years, values from the test year."""
    _, tables = pr.fit_and_apply(pr.prep_pipeline(NUMERICS), training_rows(x), test_rows(x))
    parts = vector_to_array("scaled_features")
    return tables[0].select(
        *LINE_KEYS, r6(parts[0]).alias("quantity"), r6(parts[1]).alias("price"), r6(parts[3]).alias("tax")
    )


def _robust(c: str) -> str:
    q1, q2, q3 = (f"(SELECT quantile_cont({c}, {q}) FROM lineitem)" for q in (0.25, 0.5, 0.75))
    return q6(f"({c} - {q2}) / ({q3} - {q1})")


@query("robust_scale", f"SELECT {KEYS}, {_robust('l_quantity')} AS quantity, {_robust('l_extendedprice')} AS price FROM lineitem")
def _(x):
    made = pr.robust_table(x.lineitem, ["l_quantity", "l_extendedprice"])
    return made.select(*LINE_KEYS, r6("l_quantity_scaled").alias("quantity"), r6("l_extendedprice_scaled").alias("price"))


@query("robust_scale_fitted")
def _(x):
    """The fitted estimator form; its quartiles are approximate."""
    vectors = pr.assemble_features(NUMERICS).transform(x.lineitem)
    scaled = pr.robust_scale().fit(vectors).transform(vectors)
    return scaled.select(*LINE_KEYS, vector_to_array("scaled_features").alias("scaled"))


@query("hash_categoricals")
def _(x):
    """Hashed text columns, as many buckets as by default."""
    texts = x.lineitem.withColumn("supplier", F.col("l_suppkey").cast("string"))
    hashed = pr.hash_categoricals(["l_returnflag", "l_linestatus", "supplier"], buckets=1_000).transform(texts)
    return hashed.select(*LINE_KEYS, vector_to_array("categorical_features").alias("categorical_features"))


@query(
    "one_hot_encode",
    """WITH c AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS slot, count(*) OVER () AS width FROM documents GROUP BY lang)
SELECT doc_id, CAST(slot AS BIGINT) AS slot, CAST(width AS INTEGER) AS width FROM documents JOIN c USING (lang)""",
)
def _(x):
    encoded = pr.one_hot_encode(x.documents.select("doc_id", "lang"), "lang")
    parts = vector_to_array("lang_ohe")
    return encoded.select("doc_id", (F.array_position(parts, 1.0) - 1).alias("slot"), F.size(parts).alias("width"))


@query("frequency_encode", "SELECT doc_id, count(*) OVER (PARTITION BY source) AS source_freq FROM documents")
def _(x):
    return pr.frequency_encode(x.documents.select("doc_id", "source"), "source")


@query("tfidf_encode")
def _(x):
    encoded = pr.tfidf_encode(x.documents.select("doc_id", "text"), "text")
    return encoded.select("doc_id", vector_to_array("text_tfidf").alias("text_tfidf"))


@query(
    "encoding_rules",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(DISTINCT {c}) AS "distinct",
  CASE WHEN count(DISTINCT {c}) / CAST(count(*) AS DOUBLE) > 0.9 THEN 'drop' WHEN count(DISTINCT {c}) <= 10 THEN 'one_hot'
       WHEN '{c}' = 'text' THEN 'tfidf' ELSE 'frequency' END AS rule FROM documents"""
        for c in ("lang", "source", "text")
    ),
)
def _(x):
    return pr.encoding_rules(x.documents, one_hot_limit=10, embed=["text"])


@query(
    "auto_encode_strings",
    """WITH c AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS slot FROM documents GROUP BY lang)
SELECT doc_id, n_chars, CAST(slot AS BIGINT) AS lang_slot, count(*) OVER (PARTITION BY source) AS source_freq,
  count(*) OVER (PARTITION BY text) AS text_freq FROM documents JOIN c USING (lang)""",
)
def _(x):
    """Languages become one-hot vectors, sources and texts frequencies; an id share of 1 drops nothing."""
    encoded = pr.auto_encode_strings(x.documents, one_hot_limit=10, id_share=1.0)
    slot = (F.array_position(vector_to_array("lang_ohe"), 1.0) - 1).alias("lang_slot")
    return encoded.select("doc_id", "n_chars", slot, "source_freq", "text_freq")


@query("auto_encode_strings_embedded")
def _(x):
    """An id share of 1 keeps the text column, so all encodings except dropping are used."""
    encoded = pr.auto_encode_strings(x.documents, one_hot_limit=10, embed=["text"], id_share=1.0)
    arrays = [vector_to_array(c).alias(c) for c in encoded.columns if c.endswith(("_ohe", "_tfidf"))]
    return encoded.select("doc_id", "n_chars", "source_freq", *arrays)


@query("logreg_baseline")
def _(x):
    """Scores on the last quarter for a model of the first nine months."""
    return mo.logreg_baseline(prepared(x), FEATURES, "label", "m")[1]


@query("blocked_cv_logreg")
def _(x):
    return mo.blocked_cv_logreg(prepared(x), FEATURES, "label", "y", "m", YEARS, TEST_YEAR).grid


@query("blocked_cv_mlp")
def _(x):
    return mo.blocked_cv_mlp(prepared(x), FEATURES, "label", "y", "m", YEARS, TEST_YEAR).grid


@query("gbt_importance")
def _(x):
    return mo.gbt_importance(x.li, ["m", *NUMERICS], "label")


@query("rf_feature_selection")
def _(x):
    return mo.rf_feature_selection(x.li.select("label", "m", *NUMERICS), "label", threshold=0.01)[1]


@query("permutation_importance")
def _(x):
    model = LogisticRegression(maxIter=100).fit(mo.model_table(training_rows(x), NUMERICS, "label"))
    return mo.permutation_importance(model, test_rows(x), NUMERICS, "label", [c for c in LINE_COLUMNS if c not in NUMERICS])


def _round_sql(turn: int, key: int) -> str:
    """One Feistel round on (x, y) of a grid ``high`` by ``wide``."""
    half = hash_sql("{0}", str(4 * key + turn))
    if turn % 2:
        return f"x, (y + {half.format('x')}) % wide AS y"
    return f"(x + {half.format('y')}) % high AS x, y"


def _moved_sql(key: int, walks: int = 8) -> str:
    """Where each ``place`` goes under the bijection of ``key``."""
    inner = "SELECT place, place AS p FROM numbered"
    for walk in range(walks):
        cells = f"SELECT place, p, p // wide AS x, p % wide AS y FROM ({inner}), grid"
        for turn in range(4):
            cells = f"SELECT place, p, {_round_sql(turn, key)} FROM ({cells}), grid"
        step = "x * wide + y" if not walk else "CASE WHEN p >= n THEN x * wide + y ELSE p END"
        inner = f"SELECT place, {step} AS p FROM ({cells}), grid"
    return inner


_RULE = "CASE WHEN {0}.l_quantity > 20 AND {1}.l_discount < CAST(0.06 AS DOUBLE) THEN 1 ELSE 0 END"


@query(
    "permutation_importance_rule",
    with_views(
        "li",
        extra=f"""numbered AS MATERIALIZED (
  SELECT l_quantity, l_discount, label, row_number() OVER (ORDER BY {KEYS}, l_quantity, l_discount, label) - 1 AS place FROM li),
grid AS MATERIALIZED (SELECT n, wide, CAST(ceil(n / wide) AS BIGINT) AS high FROM
  (SELECT count(*) AS n, CAST(floor(sqrt(greatest(count(*) - 1, 0))) AS BIGINT) + 1 AS wide FROM numbered)),
q AS MATERIALIZED (SELECT p, l_quantity FROM ({_moved_sql(42)}) JOIN numbered USING (place)),
d AS MATERIALIZED (SELECT p, l_discount FROM ({_moved_sql(43)}) JOIN numbered USING (place)),
r AS (SELECT avg(CASE WHEN {_RULE.format('b', 'b')} = label THEN 1 ELSE 0 END) AS own,
  avg(CASE WHEN {_RULE.format('q', 'b')} = label THEN 1 ELSE 0 END) AS quantity,
  avg(CASE WHEN {_RULE.format('b', 'd')} = label THEN 1 ELSE 0 END) AS discount
  FROM numbered b JOIN q ON q.p = b.place JOIN d ON d.p = b.place)""",
    )
    + f"""SELECT 'l_quantity' AS feature, {q6('own - quantity')} AS importance FROM r
UNION ALL SELECT 'l_discount', {q6('own - discount')} FROM r""",
)
def _(x):
    """Importance of two features to a fixed rule, which SQL can move and score as well."""
    rule = F.when((F.col("l_quantity") > 20) & (F.col("l_discount") < 0.06), 1.0).otherwise(0.0)
    features = ["l_quantity", "l_discount"]
    found = mo.permutation_importance(lambda df: df.withColumn("prediction", rule), x.li, features, "label", [*LINE_KEYS, *features, "label"])
    return found.select("feature", r6("importance").alias("importance"))


@query("process_and_select")
def _(x):
    labelled = x.documents.join(x.labels, "doc_id").drop("doc_id")
    return mo.process_and_select(labelled, "quality", one_hot_limit=10, embed=["text"])[1]


def _sweep_sql() -> str:
    return """t AS (SELECT CAST(k AS DOUBLE) / 100 AS threshold FROM (SELECT unnest(range(101)) AS k)),
u AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM li GROUP BY score),
c AS (SELECT threshold, CAST(coalesce(sum(pos), 0) AS BIGINT) AS tp, CAST(coalesce(sum(neg), 0) AS BIGINT) AS fp
  FROM t LEFT JOIN u ON score >= threshold GROUP BY threshold),
f AS (SELECT *, (SELECT count(*) FROM li WHERE label = 1) AS actual FROM c),
g AS (SELECT *, coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS p, tp / CAST(actual AS DOUBLE) AS r,
  coalesce(2 * tp / CAST(nullif(tp + fp + actual, 0) AS DOUBLE), 0) AS f1 FROM f)"""


@query(
    "threshold_search",
    with_views("li", extra=_sweep_sql())
    + f"""SELECT threshold, tp, fp, actual - tp AS fn, {q6('p')} AS "precision", {q6('r')} AS recall, {q6('f1')} AS f1,
  row_number() OVER (ORDER BY f1 DESC, threshold) = 1 AS best FROM g""",
)
def _(x):
    found = m.threshold_search(x.li, "score", "label")
    return found.select("threshold", "tp", "fp", "fn", *(r6(c).alias(c) for c in ("precision", "recall", "f1")), "best")


@query(
    "apply_threshold",
    LI
    + """SELECT cutoff, label, CASE WHEN score >= cutoff THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction, count(*) AS n
FROM li, (SELECT unnest([CAST(0.3 AS DOUBLE), CAST(0.5 AS DOUBLE)]) AS cutoff) GROUP BY ALL""",
)
def _(x):
    parts = [m.apply_threshold(x.li.withColumn("cutoff", F.lit(c)), "score", c) for c in (0.3, 0.5)]
    return parts[0].unionByName(parts[1]).groupBy("cutoff", "label", "prediction").agg(F.count("*").alias("n"))


@query("probability_errors", LI + f"SELECT {q6('avg(abs(score - label))')} AS mae, {q6('avg((score - label) * (score - label))')} AS mse FROM li")
def _(x):
    return m.probability_errors(x.li, "score", "label").select(r6("mae").alias("mae"), r6("mse").alias("mse"))


@query(
    "log_loss",
    LI
    + f"""SELECT {q6('-avg(label * ln(p) + (1 - label) * ln(1 - p))')} AS log_loss FROM
  (SELECT label, least(greatest(score, CAST(1e-15 AS DOUBLE)), CAST(1 AS DOUBLE) - CAST(1e-15 AS DOUBLE)) AS p FROM li)""",
)
def _(x):
    return m.log_loss(x.li, "score", "label").select(r6("log_loss").alias("log_loss"))


_VOTED = """v AS (SELECT *, CASE WHEN pred_a + pred_b >= 1 THEN CAST(1 AS DOUBLE) ELSE 0 END AS vote FROM preds),
report AS (SELECT k.class, k.class = 1 AS one,
  (SELECT count(*) FROM v WHERE label = k.class) AS support,
  (SELECT count(*) FROM v WHERE vote = k.class) AS predicted,
  (SELECT count(*) FROM v WHERE label = k.class AND vote = k.class) AS hits
  FROM (SELECT unnest([CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)]) AS class) k),
scores AS (SELECT class, coalesce(hits / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS p, hits / CAST(support AS DOUBLE) AS r,
  2 * hits / CAST(support + predicted AS DOUBLE) AS f, support, hits FROM report)"""


def _voted(x):
    return paired(x).withColumn("vote", m.ensemble_vote([F.col("pred_a"), F.col("pred_b")], "any"))


@query(
    "class_report",
    with_views("preds", extra=_VOTED)
    + f"""SELECT class, {q6('p')} AS "precision", {q6('r')} AS recall, {q6('f')} AS f1, support, hits FROM scores""",
)
def _(x):
    found = m.class_report(_voted(x), "label", "vote")
    return found.select("class", *(r6(c).alias(c) for c in ("precision", "recall", "f1")), "support", "hits")


@query(
    "weighted_metrics",
    with_views("preds", extra=_VOTED)
    + f"""SELECT {q6('sum(hits) / CAST(sum(support) AS DOUBLE)')} AS accuracy, {q6('sum(f * support) / sum(support)')} AS weighted_f1,
  {q6('sum(p * support) / sum(support)')} AS weighted_precision, {q6('sum(r * support) / sum(support)')} AS weighted_recall FROM scores""",
)
def _(x):
    found = m.weighted_metrics(_voted(x), "label", "vote")
    return found.select(*(r6(c).alias(c) for c in ("accuracy", "weighted_f1", "weighted_precision", "weighted_recall")))


@query(
    "binary_scores",
    with_views("preds", extra="v AS (SELECT *, CASE WHEN pred_a + pred_b >= 1 THEN 1 ELSE 0 END AS vote FROM preds)")
    + f"""SELECT y, {q6('count(*) FILTER (label = 1 AND vote = 1) / CAST(count(*) FILTER (label = 1) AS DOUBLE)')} AS recall,
  {q6('count(*) FILTER (label = 1 AND vote = 1) / CAST(count(*) FILTER (vote = 1) AS DOUBLE)')} AS "precision",
  {q6('2 * count(*) FILTER (label = 1 AND vote = 1) / CAST(count(*) FILTER (label = 1) + count(*) FILTER (vote = 1) AS DOUBLE)')} AS f1
FROM v GROUP BY y""",
)
def _(x):
    voted = x.preds.withColumn("vote", m.ensemble_vote([F.col("pred_a"), F.col("pred_b")], "any"))
    found = m.binary_scores(voted, "label", "vote", ["y"])
    return found.select("y", *(r6(c).alias(c) for c in ("recall", "precision", "f1")))


#: Majority label of each of four groups of lines, and how many of ten lines of a group have it.
_GROUPS = "CASE l_linenumber % 4 WHEN 0 THEN 8 WHEN 1 THEN 2 WHEN 2 THEN 9 ELSE 1 END"
_DRAWN = f"CASE WHEN {hash_sql('l_orderkey', 'l_partkey')} % 10 < {_GROUPS} THEN 1 ELSE 0 END"
_GROUPED = with_views("li", extra=f"""grouped AS (
  SELECT y, m, {_DRAWN} AS won, CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END AS pred FROM li)""")
INDICATORS = ["g0", "g1", "g2", "g3"]


def grouped(x):
    """Lines with disjoint indicators of four groups, whose labels have rates far from one half."""
    number = F.col("l_linenumber") % 4
    rate = F.when(number == 0, 8).when(number == 1, 2).when(number == 2, 9).otherwise(1)
    won = (key_hash(F.col("l_orderkey"), F.col("l_partkey")) % 10 < rate).cast("int")
    return x.li.select("y", "m", won.alias("won"), *(F.when(number == i, 1.0).otherwise(0.0).alias(g) for i, g in enumerate(INDICATORS)))


def _scores_sql(where: str, by: str = "") -> str:
    """Recall, precision and F1 of the groups' majority labels."""
    tp, actual, predicted = "sum(won * pred)", "sum(won)", "sum(pred)"
    return f"""SELECT {by}{tp} / CAST({actual} AS DOUBLE) AS recall, {tp} / CAST({predicted} AS DOUBLE) AS "precision",
  2 * {tp} / CAST({actual} + {predicted} AS DOUBLE) AS f1 FROM grouped WHERE {where}"""


@query("logreg_baseline_groups", _GROUPED + f"SELECT {q6('recall')} AS recall, {q6('precision')} AS \"precision\", {q6('f1')} AS f1 FROM ({_scores_sql('m > 9')})")
def _(x):
    """Without regularisation a model of disjoint indicators gives each group its own rate, so it predicts the majority."""
    found = mo.logreg_baseline(grouped(x), INDICATORS, "won", "m")[1]
    return found.select(*(r6(c).alias(c) for c in ("recall", "precision", "f1")))


_CV = _scores_sql(f"m > 9 AND y IN ({', '.join(map(str, YEARS))})", "y, ") + " GROUP BY y"


@query("blocked_cv_logreg_groups", _GROUPED + f"SELECT '0.0' AS \"regParam\", {q6('avg(recall)')} AS mean_recall, {q6('avg(f1)')} AS mean_f1 FROM ({_CV})")
def _(x):
    found = mo.blocked_cv_logreg(grouped(x), INDICATORS, "won", "y", "m", YEARS, TEST_YEAR, grid=({"regParam": 0.0},)).grid
    return found.select("regParam", *(r6(c).alias(c) for c in ("mean_recall", "mean_f1")))


@query("blocked_cv_mlp_groups", _GROUPED + f"SELECT {q6('avg(recall)')} AS mean_recall, {q6('avg(f1)')} AS mean_f1 FROM ({_CV})")
def _(x):
    """A network separates four disjoint indicators as well."""
    grid = ({"hidden_layers": [6, 2], "maxIter": 100, "stepSize": 0.03},)
    found = mo.blocked_cv_mlp(grouped(x), INDICATORS, "won", "y", "m", YEARS, TEST_YEAR, grid=grid).grid
    return found.select(*(r6(c).alias(c) for c in ("mean_recall", "mean_f1")))


_TWO = "SELECT 'even' AS feature, CAST(1 AS DOUBLE) AS importance FROM {0} HAVING count(*) > 0 UNION ALL SELECT 'same', CAST(0 AS DOUBLE) FROM {0} HAVING count(*) > 0"


def two_features(x):
    """A label that one feature decides, and a feature that never changes."""
    even = (F.col("l_linenumber") % 2).cast("double")
    return x.lineitem.select(even.cast("int").alias("won"), even.alias("even"), F.lit(3.0).alias("same"))


@query("gbt_importance_decided", _TWO.format("lineitem"))
def _(x):
    return mo.gbt_importance(two_features(x), ["even", "same"], "won").withColumn("importance", r6("importance"))


@query("rf_feature_selection_decided", _TWO.format("lineitem"))
def _(x):
    return mo.rf_feature_selection(two_features(x), "won")[1].withColumn("importance", r6("importance"))


@query(
    "process_and_select_decided",
    "SELECT 'kind_freq' AS feature, CAST(1 AS DOUBLE) AS importance FROM events HAVING count(*) > 0 UNION ALL SELECT 'same', CAST(0 AS DOUBLE) FROM events HAVING count(*) > 0",
)
def _(x):
    """The frequency of a text decides the label; the table's other column is constant."""
    kind = F.when(F.col("event_id") % 3 == 0, "rare").otherwise("usual")
    rows = x.events.select(kind.alias("kind"), F.lit(1.5).alias("same"), (F.col("event_id") % 3 == 0).cast("int").alias("won"))
    return mo.process_and_select(rows, "won", one_hot_limit=1)[1].withColumn("importance", r6("importance"))


@query("hash_categoricals_total", f"SELECT {KEYS}, CAST(3 AS DOUBLE) AS total FROM lineitem")
def _(x):
    """Each of the three texts of a row adds one to some bucket."""
    texts = x.lineitem.withColumn("supplier", F.col("l_suppkey").cast("string"))
    hashed = pr.hash_categoricals(["l_returnflag", "l_linestatus", "supplier"], buckets=1_000).transform(texts)
    return hashed.select(*LINE_KEYS, pr.vector_total("categorical_features").alias("total"))


@query(
    "tfidf_encode_words",
    f"""WITH n AS (SELECT count(*) AS rows FROM documents), c AS (SELECT lang, count(*) AS held FROM documents GROUP BY lang)
SELECT doc_id, {q6("ln((rows + 1) / CAST(held + 1 AS DOUBLE))")} AS weight FROM documents JOIN c USING (lang), n""",
)
def _(x):
    """Texts of one word: the only weight is the inverse document frequency of that word."""
    encoded = pr.tfidf_encode(x.documents.select("doc_id", "lang"), "lang", features=1 << 12)
    return encoded.select("doc_id", r6(pr.vector_total("lang_tfidf")).alias("weight"))
