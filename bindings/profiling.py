"""Counts, profiles and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.cleaning import BAND_SQL, SPARSE, sparse
from bindings.registry import q6, query, r6
from bindings.tables import NUMERICS, with_views
from chronoweave.functions import scalars as s
from chronoweave.operators import clean
from chronoweave.operators import profile as p

EV = with_views("ev")
LI = with_views("li")


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(x):
    return p.value_counts(x.events, "event_type")


@query(
    "calendar_counts",
    LI
    + """SELECT y AS year, m AS month, CAST(day(l_shipdate) AS INTEGER) AS day, CAST(isodow(l_shipdate) AS INTEGER) AS iso_weekday,
  CAST(hour(l_shipdate) AS INTEGER) AS hour, label, count(*) AS n, m || '-' || y AS month_year FROM li GROUP BY ALL""",
)
def _(x):
    parts = s.calendar_parts(F.col("l_shipdate"))
    names = ["year", "month", "day", "iso_weekday", "hour"]
    return p.calendar_counts(x.li.select("label", *(parts[n].alias(n) for n in names)), names, "label")


@query("band_counts", EV + f"SELECT CAST(d AS VARCHAR) AS day, {BAND_SQL} AS band, flag, count(*) AS n FROM ev GROUP BY ALL")
def _(x):
    return p.band_counts(x.ev.withColumn("day", F.col("d").cast("string")), "day", s.time_band(F.col("h")), "flag")


@query(
    "route_rollup",
    with_views("nat")
    + """SELECT r_name, CAST(sum(weight) AS BIGINT) AS n FROM nat JOIN nation ON src = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def _(x):
    routes = x.nat.withColumnRenamed("weight", "n").join(x.nation, F.col("src") == F.col("n_nationkey"))
    return p.route_rollup(routes.join(x.region, F.col("n_regionkey") == F.col("r_regionkey")), "r_name")


@query(
    "route_counts",
    """SELECT s_nationkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
)
def _(x):
    lines = x.lineitem.join(x.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return p.route_counts(lines, ["s_nationkey"], ["l_linestatus"], "l_returnflag")


@query("grouped_mean", f"SELECT l_suppkey, {q6('avg(l_quantity)')} AS mean, count(l_quantity) AS n FROM lineitem GROUP BY l_suppkey")
def _(x):
    return p.grouped_mean(x.lineitem, ["l_suppkey"], "l_quantity").withColumn("mean", r6("mean"))


# Coordinates derived from keys; every fifth nation has none, one has text that is no number.
@query(
    "geo_counts",
    """SELECT n_name, CAST(n_nationkey * 2.5 AS DOUBLE) AS lat, CAST(n_regionkey * -10.5 AS DOUBLE) AS lon, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0 AND n_nationkey <> 3 GROUP BY ALL""",
)
def _(x):
    lat = F.when(F.col("n_nationkey") == 3, "x").when(F.col("n_nationkey") % 5 != 0, (F.col("n_nationkey") * 2.5).cast("string"))
    placed = x.nation.select("n_nationkey", "n_name", lat.alias("lat"), (F.col("n_regionkey") * -10.5).alias("lon"))
    customers = x.customer.join(placed, F.col("c_nationkey") == F.col("n_nationkey"))
    return p.geo_counts(customers, "n_name", "lat", "lon").withColumn("lon", F.col("lon") + F.lit(0.0))


@query(
    "class_ratio",
    LI
    + f"""SELECT y, label, n, {q6("n / CAST(sum(n) OVER (PARTITION BY y) AS DOUBLE)")} AS ratio
FROM (SELECT y, label, count(*) AS n FROM li GROUP BY y, label)""",
)
def _(x):
    return p.class_ratio(x.li, "label", ["y"]).withColumn("ratio", r6("ratio"))


@query(
    "monthly_positive_mean",
    LI + f"SELECT m, n, {q6('avg(n) OVER ()')} AS mean_n FROM (SELECT m, count(*) AS n FROM li WHERE label = 1 GROUP BY m)",
)
def _(x):
    return p.monthly_positive_mean(x.li, "m", "label").withColumn("mean_n", r6("mean_n"))


@query(
    "duplicate_rows",
    with_views("ev_dup") + "SELECT event_id, user_id, event_type, value, count(*) AS n FROM ev_dup GROUP BY ALL HAVING count(*) > 1",
)
def _(x):
    return p.duplicate_rows(x.ev_dup.select("event_id", "user_id", "event_type", "value"))


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(x):
    return p.duplicate_keys(x.lineitem, ["l_orderkey", "l_linenumber"])


SPARSE_COLUMNS = ["event_id", "user_id", "event_type", "value", "mostly"]


@query(
    "null_profile",
    SPARSE
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls, round(100 * (count(*) - count({c})) / CAST(count(*) AS DOUBLE), 2) AS percent FROM sparse"
        for c in SPARSE_COLUMNS
    ),
)
def _(x):
    return p.null_profile(sparse(x))


def _profile_sql(table: str, columns, nulls: bool = False) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) AS rows, count(*) - count({c}) AS nulls, {q6(f'avg({c})')} AS mean,
  {q6(f'stddev_samp({c})')} AS stddev, {q6(f'min({c})')} AS min, {q6(f'max({c})')} AS max,
  {q6(f'quantile_cont({c}, 0.5)')} AS median FROM {table}"""
        for c in columns
    )


def numeric_profile(x):
    """Exact profile of the numeric columns."""
    found = p.numeric_profile(x.lineitem, NUMERICS, exact=True)
    return found.select("feature", "rows", "nulls", *(r6(c).alias(c) for c in ("mean", "stddev", "min", "max", "median")))


query("numeric_profile", _profile_sql("lineitem", NUMERICS))(numeric_profile)


@query("numeric_profile_approx")
def _(x):
    """The one-pass form with an approximate median."""
    return p.numeric_profile(x.lineitem, NUMERICS)


@query(
    "profile_merge",
    SPARSE
    + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) - count({c}) AS nulls,
  round(100 * (count(*) - count({c})) / CAST(count(*) AS DOUBLE), 2) AS percent,
  {q6(f'avg({c})') if numeric else 'CAST(NULL AS DOUBLE)'} AS mean,
  {q6(f'quantile_cont({c}, 0.5)') if numeric else 'CAST(NULL AS DOUBLE)'} AS median FROM sparse"""
        for c, numeric in (("event_id", True), ("user_id", True), ("event_type", False), ("value", True), ("mostly", True))
    ),
)
def _(x):
    rows = sparse(x)
    stats = p.numeric_profile(rows, clean.columns_of_type(rows), exact=True).select("feature", "mean", "median")
    merged = p.profile_merge(p.null_profile(rows), stats)
    return merged.select("feature", "nulls", "percent", r6("mean").alias("mean"), r6("median").alias("median"))


@query("time_extent", EV + "SELECT min(sec) AS first, max(sec) AS last FROM ev")
def _(x):
    return p.time_extent(x.ev, "sec")


@query(
    "outcome_buckets",
    """SELECT count(*) FILTER (v >= 15) AS late, count(*) FILTER (v > 0 AND v < 15) AS slightly_late,
  count(*) FILTER (v <= 0) AS on_time FROM (SELECT value - 40 AS v FROM events)""",
)
def _(x):
    return p.outcome_buckets(x.events.select((F.col("value") - 40).alias("v")), "v")


def _hist_sql(bins: int, low: str, high: str) -> str:
    return f"""WITH e AS (SELECT {low} AS lo, {high} AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
  FROM lineitem, e WHERE l_extendedprice BETWEEN lo AND hi GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, {q6(f'lo + b.bin * ((hi - lo) / {bins})')} AS "from",
  {q6(f'lo + (b.bin + 1) * ((hi - lo) / {bins})')} AS "to", coalesce(n, 0) AS n
FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN e LEFT JOIN c ON b.bin = c.bin"""


def _hist(df):
    return df.select("bin", r6("from").alias("from"), r6("to").alias("to"), "n")


@query("histogram", _hist_sql(30, "min(l_extendedprice)", "max(l_extendedprice)"))
def _(x):
    return _hist(p.histogram(x.lineitem, "l_extendedprice", 30))


@query("histogram_bounded", _hist_sql(200, "CAST(min(-5000) AS DOUBLE)", "CAST(min(10000) AS DOUBLE)"))
def _(x):
    return _hist(p.histogram(x.lineitem, "l_extendedprice", 200, -5000.0, 10000.0))


def _box_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, b.label, rows, {q6('q1')} AS q1, {q6('median')} AS median, {q6('q3')} AS q3,
  {q6(f'min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {q6(f'max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high
FROM li JOIN (SELECT label, count({c}) AS rows, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
  quantile_cont({c}, 0.75) AS q3 FROM li GROUP BY label) b ON li.label = b.label GROUP BY b.label, rows, q1, median, q3"""


@query("boxplot_stats", LI + "\nUNION ALL ".join(_box_sql(c) for c in NUMERICS))
def _(x):
    found = p.boxplot_stats(x.li, NUMERICS, "label")
    names = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return found.select("feature", "label", "rows", *(r6(c).alias(c) for c in names))


RATIO_COLUMNS = ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderkey"]


@query(
    "distinct_ratio",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) AS rows, count(DISTINCT {c}) AS "distinct", {q6(f'count(DISTINCT {c}) / CAST(count(*) AS DOUBLE)')} AS ratio FROM orders"""
        for c in RATIO_COLUMNS
    ),
)
def _(x):
    found = p.distinct_ratio(x.orders, RATIO_COLUMNS)
    return found.select("feature", F.col("rows").cast("long").alias("rows"), "distinct", r6("ratio").alias("ratio"))


@query("scalar_sum_count", f"SELECT {q6('sum(value)')} AS total, count(value) AS n, {q6('avg(value)')} AS mean FROM events")
def _(x):
    return p.scalar_sum_count(x.events, "value").select(r6("total").alias("total"), "n", r6("mean").alias("mean"))


def _corr_sql(columns, source: str, shown=None) -> str:
    names = shown or columns
    return "\nUNION ALL ".join(
        f"SELECT '{names[i]}' AS a, '{names[j]}' AS b, {q6(f'corr({a}, {b})')} AS corr FROM {source}"
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    )


def _corr(df):
    return df.select("a", "b", r6("corr").alias("corr"))


@query("pearson_matrix", _corr_sql(NUMERICS, "lineitem"))
def _(x):
    return _corr(p.pearson_matrix(x.lineitem, NUMERICS))


@query(
    "pearson_matrix_pairwise",
    SPARSE + _corr_sql(["value", "mostly"], "sparse"),
)
def _(x):
    return _corr(p.pearson_matrix(sparse(x), ["value", "mostly"], pairwise=True))


_RANKS = "WITH ranks AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / CAST(2 AS DOUBLE) AS r_{c}" for c in NUMERICS
) + " FROM lineitem)\n"


@query("spearman_matrix", _RANKS + _corr_sql([f"r_{c}" for c in NUMERICS], "ranks", NUMERICS))
def _(x):
    return _corr(p.spearman_matrix(x.lineitem, NUMERICS))


@query("ml_pearson_matrix", _corr_sql(NUMERICS, "lineitem"))
def _(x):
    return _corr(p.ml_correlation_matrix(x.lineitem, NUMERICS))


def _moments(c: str) -> str:
    n = f"count({c})"
    mu = f"(SELECT avg({c}) FROM lineitem)"
    m2, m3, m4 = (f"avg(power({c} - {mu}, {k}))" for k in (2, 3, 4))
    skew, kurt = f"({m3} / power({m2}, 1.5))", f"({m4} / power({m2}, 2) - 3)"
    jb = f"({n} / CAST(6 AS DOUBLE) * (power({skew}, 2) + power({kurt}, 2) / 4))"
    return f"""SELECT '{c}' AS feature, {n} AS n, {q6(skew)} AS skewness, {q6(kurt)} AS kurtosis,
  round({jb}, 4) AS jarque_bera, {q6(f'exp(-{jb} / 2)')} AS p_value FROM lineitem"""


@query("normality_profile", "\nUNION ALL ".join(_moments(c) for c in NUMERICS))
def _(x):
    found = p.normality_profile(x.lineitem, NUMERICS)
    return found.select(
        "feature", "n", r6("skewness").alias("skewness"), r6("kurtosis").alias("kurtosis"),
        F.round("jarque_bera", 4).alias("jarque_bera"), r6("p_value").alias("p_value"),
    )
