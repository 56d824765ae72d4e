"""Edge cases: nulls, clocks, stores, balancing, metrics."""

import datetime as dt
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from bindings.tables import LINE_KEYS, NUMERICS, Tables
from chronoweave import scratch
from chronoweave.functions import scalars as s
from chronoweave.operators import clean, dictionary, enrich, metrics, models, prep, profile
from chronoweave.skew import small_side
from chronoweave.sources import scan
from chronoweave.plans import departures
from chronoweave.sources.stages import ModelStore, StageStore, input_version


def _one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("clock", "expected"),
    [
        (0, dt.datetime(2024, 3, 9)),
        (5, dt.datetime(2024, 3, 9, 0, 5)),
        (2359, dt.datetime(2024, 3, 9, 23, 59)),
        (2400, dt.datetime(2024, 3, 10)),
        (1275, None),
    ],
)
def test_clock(spark, clock, expected):
    stamp = s.hhmm_to_timestamp(F.col("day"), F.col("clock"))
    assert _one(spark, stamp, day=dt.date(2024, 3, 9), clock=clock) == expected


@pytest.mark.parametrize(
    ("before", "clock", "days", "mode", "gap"),
    [
        (955, 1005, 0, "minutes", 10),
        (955, 1005, 0, "hhmm", 50),
        (2350, 10, 1, "minutes", 20),
        (2350, 10, 1, "hhmm", 60),
        (955, 1005, 2, "minutes", None),
        (2400, 100, 1, "minutes", 60),
    ],
)
def test_turnaround(spark, before, clock, days, mode, gap):
    day = dt.date(2024, 3, 9)
    column = s.turnaround(F.col("day"), F.col("clock"), F.col("pd"), F.col("before"), mode)
    assert _one(spark, column, day=day + dt.timedelta(days=days), clock=clock, pd=day, before=before) == gap


def test_stage_store(spark, data_dir, tmp_path):
    store = StageStore(spark, str(tmp_path / "stages"))
    assert store.list() == [] and not store.exists("a")
    orders = Tables(spark, data_dir).orders
    assert store.save(orders, "a") == (orders.count(), 6)
    assert store.exists("a") and not store.exists("a", "2") and store.list() == ["a"]
    calls = []
    for _ in range(2):
        store.stage("b", lambda: calls.append(1) or orders, version="x")
    assert calls == [1]
    assert store.delete("a") and not store.exists("a")
    with pytest.raises(ValueError):
        store.path("../elsewhere")


def test_input_version_follows_the_files(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5).write.parquet(folder)
    first = input_version(spark, folder)
    assert input_version(spark, folder) == first
    spark.range(5).write.mode("append").parquet(folder)
    second = input_version(spark, folder)
    assert second != first
    spark.range(5).write.parquet(f"{folder}/deeper/part=1")
    third = input_version(spark, folder)
    assert third != second
    spark.range(5, 10).write.mode("overwrite").parquet(f"{folder}/deeper/part=1")
    assert input_version(spark, folder) != third


def test_model_store_keeps_the_fit(spark, data_dir, tmp_path, same_rows):
    lines = Tables(spark, data_dir).li
    model = prep.prep_pipeline(NUMERICS).fit(lines)
    store = ModelStore(spark, str(tmp_path))
    store.save(model, "run")
    text = F.col("scaled_features").cast("string").alias("v")
    same_rows(model.transform(lines).select(text), store.load("run").transform(lines).select(text))


def test_scaled_values_lie_between_zero_and_one(spark, data_dir):
    lines = Tables(spark, data_dir).li
    scaled = prep.array_features(prep.prep_pipeline(NUMERICS).fit(lines).transform(lines), "scaled_features")
    low, high = scaled.select(F.explode("features_array").alias("v")).agg(F.min("v"), F.max("v")).first()
    assert low >= 0 and high <= 1 + 1e-12


def test_undersampling_balances_every_block(spark, data_dir):
    lines = Tables(spark, data_dir).li
    balanced = prep.undersample_majority(lines, "label", "y", LINE_KEYS)
    assert balanced.filter("label = 1").count() == lines.filter("label = 1").count()
    for row in profile.class_ratio(balanced, "label", ["y"]).collect():
        assert row["ratio"] == pytest.approx(0.5, abs=0.1)


def test_undersampling_keeps_a_block_without_a_majority(spark):
    rows = spark.createDataFrame([(1, 1, i) for i in range(5)] + [(1, 0, 9)] + [(2, 0, i) for i in range(3)], "y int, l int, k int")
    kept = prep.undersample_majority(rows, "l", "y", ["k"])
    assert kept.filter("y = 1").count() == 6
    assert kept.filter("y = 2").count() == 0


def test_weighted_metrics_equal_the_evaluator(spark, data_dir):
    rows = Tables(spark, data_dir).preds.select(F.col("label").cast("double").alias("label"), F.col("pred_a").alias("prediction"))
    found = metrics.weighted_metrics(rows, "label", "prediction").first()
    for name, column in {
        "accuracy": "accuracy", "f1": "weighted_f1", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall",
    }.items():
        assert MulticlassClassificationEvaluator(metricName=name).evaluate(rows) == pytest.approx(found[column])


def test_vote_rules(spark):
    votes = [F.col("a"), F.col("b"), F.col("c")]
    rows = spark.createDataFrame([(1.0, 0.0, 0.0), (1.0, 1.0, 0.0), (1.0, 1.0, 1.0)], "a double, b double, c double")
    for rule, expected in {"any": [1, 1, 1], "majority": [0, 1, 1], "all": [0, 0, 1]}.items():
        assert [r["v"] for r in rows.select(metrics.ensemble_vote(votes, rule).alias("v")).collect()] == expected


def test_prediction_join_refuses_repeated_keys(spark):
    once, twice = (spark.createDataFrame([(k,) for k in keys], "k int") for keys in ([1, 2], [1, 1]))
    with pytest.raises(Exception, match="not unique"):
        enrich.prediction_join([once, twice.withColumn("p", F.lit(1))], ["k"]).collect()


def test_prediction_join_computes_each_output_once(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/orders.parquet")
    first, second = rows.select("o_orderkey", "o_custkey"), rows.select("o_orderkey", "o_totalprice")
    joined = enrich.prediction_join([first, second], ["o_orderkey"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2 and plan.count("Exchange hashpartitioning") == 2
    assert joined.count() == rows.count()


def test_bucket_lookup_keeps_every_row(spark, data_dir):
    events = Tables(spark, data_dir).ev
    hourly = events.groupBy("event_type", F.date_trunc("HOUR", "ts").alias("hour_ts")).agg(F.avg("value").alias("seen"))
    joined = enrich.bucket_lookup_join(events, hourly, {"event_type": "event_type"}, s.lookup_bucket(F.col("ts")), "hour_ts")
    assert joined.count() == events.count() and joined.columns == [*events.columns, "seen"]


@pytest.mark.parametrize(("first", "fan_out"), [(2, 0), (1000, 0), (8, 4)])
def test_nearest_reading_equals_the_full_join(spark, data_dir, same_rows, first, fan_out):
    tables = Tables(spark, data_dir)
    readings = enrich.hourly_dedup_avg(tables.obs, ["station", "hour_ts"], ["value"], ["props"], ["ts", "event_id"])
    full = enrich.nearest_station_lookup(readings, tables.stations, "station", ["site", "hour_ts"], "distance", ["value", "props"])
    missing = spark.sql("SELECT 3L AS site, TIMESTAMP '1999-01-01 00:00:00' AS hour_ts")
    wanted = full.select("site", "hour_ts").union(missing)
    args = ("station", "site", "hour_ts", "distance", ["value", "props"])
    same_rows(enrich.nearest_reading(wanted, readings, tables.stations, *args, first=first, max_fan_out=fan_out), full)


def test_small_side_hints_only_small_tables(spark):
    def hinted(df):
        return "ResolvedHint" in small_side(df, 10)._jdf.queryExecution().analyzed().toString()

    assert hinted(spark.range(10)) and not hinted(spark.range(11))
    assert hinted(spark.range(2).withColumn("t", F.lit("x" * 1000)))
    assert not hinted(spark.range(2).withColumn("t", F.lit("x" * 1025)))
    assert not hinted(spark.range(2).withColumn("t", F.array("id")))
    assert hinted(spark.range(0).withColumn("t", F.lit("x")))


def test_sparse_columns_at_the_threshold(spark):
    rows = spark.createDataFrame([(1, None, 1), (2, 2, None), (3, None, 3), (4, 4, 4)], "a int, b int, c int")
    assert clean.drop_sparse_columns(rows).columns == ["a", "c"]


def test_frequency_of_null_is_null(spark):
    rows = spark.createDataFrame([("x",), ("x",), (None,)], "c string")
    assert sorted(map(repr, enrich.frequency_join(rows, "c", "n").collect())) == sorted(
        ["Row(c='x', n=2)", "Row(c='x', n=2)", "Row(c=None, n=None)"]
    )


def test_histogram_of_a_constant(spark):
    rows = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert sum(r["n"] for r in profile.histogram(rows, "v", 5).collect()) == 2


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "k int, v double, s string")
    assert clean.drop_sparse_columns(rows).columns == ["k", "v", "s"]
    assert profile.numeric_profile(rows, ["v"]).first()["rows"] == 0
    assert profile.numeric_profile(rows, ["v"], exact=True).first()["median"] is None
    assert prep.auto_encode_strings(rows.drop("s")).columns == ["k", "v"]


def test_log_metrics_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    metrics.log_metrics(spark, path, "a", {"x": 1}, {"f1": 0.5})
    metrics.log_metrics(spark, path, "b", {"x": 2}, {"f1": 0.6})
    assert metrics.metrics_table(spark, path).filter("kind = 'metric'").count() == 2


def test_scores_outside_of_the_unit_interval_count(spark):
    from chronoweave.operators import metrics

    rows = spark.createDataFrame([(1.2, 1), (0.9, 1), (-0.5, 1), (0.1, 0)], "p double, y int")
    found = {r["cutoff"] if "cutoff" in r else r[0]: r for r in metrics.threshold_search(rows, "p", "y", 10).collect()}
    assert len(found) == 11
    assert max(r["recall"] for r in found.values()) == pytest.approx(2 / 3)


def test_null_groups_and_empty_columns_keep_their_rows(spark):
    from chronoweave.operators import enrich, prep, profile

    rows = spark.createDataFrame([(1, 1, None), (2, 0, 1)], "id long, y int, block int")
    assert {r["id"] for r in prep.undersample_majority(rows, "y", "block", ["id"]).collect()} >= {1}
    assert profile.histogram(spark.createDataFrame([(None,)], "v double"), "v", 3).count() == 0
    boxes = profile.boxplot_stats(spark.createDataFrame([(1.0, None), (2.0, 1)], "v double, y int"), ["v"], "y")
    assert {r["y"] for r in boxes.collect()} == {None, 1}
    readings = spark.createDataFrame([("far", 1, 5.0), ("near", 1, 7.0)], "station string, hour int, t double")
    stations = spark.createDataFrame([("far", None), ("near", 3.0)], "station string, km double")
    best = enrich.nearest_station_lookup(readings, stations, "station", ["hour"], "km", ["t"])
    assert [r["station"] for r in best.collect()] == ["near"]


def test_vehicle_history_keeps_to_its_horizon(spark):
    """A departure at 10:00 sees, two hours before, the arrival at 07:00 and not the one at 09:00."""
    rows = [("N1", 1, 600, 700), ("N1", 2, 800, 900), ("N1", 3, 1000, None), ("N1", 4, 1200, 1300), (None, 5, 600, 700)]
    flights = spark.createDataFrame(rows, "Tail_Number string, n int, CRSDepTime int, ARR_TIME int").withColumns(
        {"FlightDate": F.lit("2024-01-01").cast("date")}
        | {c: F.lit("x") for c in departures.TIEBREAK if c not in ("n", "CRSDepTime", "FlightDate")}
        | {c: F.col("n").cast("double") for c in ("TAXI_IN", "TAXI_OUT", "ARR_DELAY")}
    )
    found = departures.vehicle_features(flights, horizon_s=7200)
    assert {r["n"]: r["Prev_TaxiIn"] for r in found.collect()} == {1: None, 2: None, 3: 1.0, 4: 2.0, 5: None}
    plain = departures.vehicle_features(flights)
    assert {r["n"]: r["Prev_TaxiIn"] for r in plain.collect()} == {1: None, 2: 1.0, 3: 2.0, 4: 3.0, 5: None}
    assert plain.columns == found.columns


def test_dictionary_of_columns(spark, monkeypatch):
    """Counts and numbers of several columns; broadcast, split by heavy values, and with one colliding hash."""
    values = ["x"] * 50 + ["y"] * 3 + [None] * 4 + [f"v{i}" for i in range(40)]
    rows = spark.createDataFrame([(i, v, f"w{i % 3}" if v else None) for i, v in enumerate(values)], "i int, a string, b string")
    counts = {v: values.count(v) for v in values if v}
    order = {v: n for n, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    for plan in ("broadcast", "split", "collision"):
        if plan == "split":
            monkeypatch.setattr(dictionary, "BROADCAST_ROWS", 0)
            monkeypatch.setattr(dictionary, "HEAVY", 5)
        if plan == "collision":
            monkeypatch.setattr(dictionary, "_first_hash", lambda text: F.when(text.isNotNull(), F.lit(7).cast("long")))
        found = dictionary.build(rows, ["a", "b"], numbered=["a"])
        assert found.distinct == {"a": 42, "b": 3} and found.rows == {"a": 93, "b": 93}
        out = found.attach(found.attach(found.attach(rows, "a", "n"), "a", "at", "number"), "b", "m").collect()
        assert {(r["i"], r["a"], r["n"], r["at"]) for r in out} == {(i, v, counts.get(v), order.get(v)) for i, v in enumerate(values)}
        groups = [i % 3 for i, v in enumerate(values) if v]
        assert all(r["m"] == (groups.count(r["i"] % 3) if r["a"] else None) for r in out) and len(out) == 97


def test_encoders_of_many_columns(spark):
    rows = spark.createDataFrame([("a", "p q", None), ("b", "p", None), ("a", None, None), (None, "q q", None)], "l string, t string, z string")
    out = prep.encode_columns(rows.fillna("", ["t"]), one_hot=["l", "z"], frequency=["l"], tfidf=["t"], features=8)
    assert sorted(out.columns) == ["l_freq", "l_ohe", "t_tfidf", "z_ohe"]
    seen = sorted((r["l_freq"] or 0, tuple(r["l_ohe"].toArray())) for r in out.collect())
    assert seen == [(0, (0.0, 0.0)), (1, (0.0, 1.0)), (2, (1.0, 0.0)), (2, (1.0, 0.0))]


def test_mode_keeps_types(spark):
    rows = spark.createDataFrame([(2**53 + 1, "b", None), (None, None, None), (2**53 + 1, "a", None), (5, "b", None)], "n long, s string, e string")
    out = prep.impute_mode(rows, ["n", "s", "e"])
    assert {r["n_imputed"] for r in out.collect()} == {2**53 + 1, 5} and {r["s_imputed"] for r in out.collect()} == {"a", "b"}
    assert dict(out.dtypes)["n_imputed"] == "bigint" and {r["e_imputed"] for r in out.collect()} == {None}


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 50, 1_000])
def test_moved_places_are_a_permutation(spark, rows):
    places = spark.range(rows).select(models.permuted_place(F.col("id"), rows, 42).alias("a"), models.permuted_place(F.col("id"), rows, 43).alias("b")).collect()
    assert sorted(r["a"] for r in places) == sorted(r["b"] for r in places) == list(range(rows))
    assert rows < 50 or sum(r["a"] == r["b"] for r in places) < 5


def test_permuted_variants_keep_all_rows(spark):
    rows = spark.createDataFrame([(i, float(i), float(-i) if i % 5 else None, i % 2) for i in range(60)], "i int, u double, v double, y int")
    out = models.permuted_variants(rows, ["u", "v"], "y", ["i"]).collect()
    by = {n: [r for r in out if r["variant"] == n] for n in ("", "u", "v")}
    assert [len(v) for v in by.values()] == [60] * 3
    assert all(r["v"] is None or r["u"] == -r["v"] for r in by[""]) and sum(r["v"] is None for r in by["v"]) == 12
    for name in ("u", "v"):
        assert sorted(repr(r[name]) for r in by[name]) == sorted(repr(r[name]) for r in by[""])
        assert sum(r["v"] is not None and r["u"] == -r["v"] for r in by[name]) < 15


def test_expanded_rows(spark):
    rows = spark.createDataFrame([("a", 25), ("b", 0), ("c", None), ("d", 10), ("e", -3)], "k string, n long")
    found = {r["k"]: r["count"] for r in clean.expand_rows(rows, F.col("n"), block=10, spread=3).groupBy("k").count().collect()}
    assert found == {"a": 25, "d": 10}
    many = spark.createDataFrame([("a", 10_000_000)], "k string, n long")
    assert clean.expand_rows(many, F.col("n")).count() == 10_000_000
    huge = clean.expand_rows(spark.createDataFrame([("a", 3_000_000_000)], "k string, n long"), F.col("n"))
    assert len(huge.limit(5).collect()) == 5


def test_clustered_sink_prunes_row_groups(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") % 2).alias("y"), (F.col("id") * 7919 % 40_000).alias("at"), F.rand(1).alias("v"))
    path = str(tmp_path / "t")
    assert scan.sink_parquet(rows, path, ["y"], files=8, cluster_by=["at"]) == 40_000
    groups = [g for f in (tmp_path / "t").rglob("*.parquet") for g in [pq.ParquetFile(f).metadata.row_group(0)]]
    spans = [(g.column(0).statistics.min, g.column(0).statistics.max) for g in groups]
    assert len(spans) >= 8 and sum(low <= 500 and high >= 400 for low, high in spans) <= 2
    assert spark.read.parquet(path).filter("at BETWEEN 400 AND 500").count() == 101


def test_scratch_scope_removes_what_is_not_kept(spark):
    with scratch.scratch_scope(spark) as keep:
        first = scratch.write_scratch(spark.range(5), "first")
        second = keep(scratch.write_scratch(first.df.filter("id > 1"), "second"))
    fs, path = scratch.hadoop_path(spark, first.path)
    assert not fs.exists(path) and second.df.count() == 3
    outside = scratch.write_scratch(spark.range(2), "outside")
    assert outside.df.count() == 2


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (1, 4.0, "y"), (1, 4.0, "y"), (2, None, None)], "`a.b` int, `c``d` double, `e.f` string")
    assert {r["feature"]: r["nulls"] for r in profile.null_profile(df).collect()} == {"a.b": 0, "c`d": 1, "e.f": 1}
    assert clean.drop_sparse_columns(df, 0.2).columns == ["a.b"]
    assert clean.require_not_null(df, ["e.f", "a.b"]).count() == 3
    assert sorted(tuple(r) for r in clean.dedup_keys(df, ["a.b"], ["c`d", "e.f"]).collect()) == [(1, 2.0, "x"), (2, None, None)]
    assert [tuple(r) for r in profile.duplicate_rows(df).collect()] == [(1, 4.0, "y", 2)]
    for exact in (False, True):
        found = {r["feature"]: r["median"] for r in profile.numeric_profile(df, ["a.b", "c`d"], exact=exact).collect()}
        assert found == {"a.b": 1.0, "c`d": 4.0}
        assert clean.fill_median(df, ["c`d"], exact=exact).filter("`c``d` = 4").count() == 3


class _Stub:
    """Stands for an estimator and its model; fitting notes whether the thread's properties stay its own."""

    def __init__(self, spark, number, meet, seen):
        self.spark, self.number, self.meet, self.seen = spark, number, meet, seen

    def fit(self, df):
        if self.number is not None:
            self.spark.sparkContext.setLocalProperty("chronoweave.test", str(self.number))
            self.meet.wait(60)
            self.seen.append(self.spark.sparkContext.getLocalProperty("chronoweave.test") == str(self.number))
        return self

    def transform(self, df):
        return df.withColumn("prediction", F.col("label"))


def test_parallel_fits_keep_their_own_properties(spark):
    """A query number set by one fit must not be cleared by another one."""
    rows = spark.createDataFrame([(y, m, float(m % 2), m % 2) for y in (1, 2, 3) for m in range(1, 13)], "y int, m int, x double, won int")
    meet, seen, numbers = threading.Barrier(2), [], iter((1, 2, None))
    found = models.blocked_search(
        rows, ["x"], "won", "y", "m", [1, 2], 3, ({"a": 1},), lambda *_: _Stub(spark, next(numbers), meet, seen), parallelism=2
    )
    assert seen == [True, True]
    assert found.test.first()["f1"] == 1.0


def test_total_of_a_sparse_vector_visits_stored_entries(spark):
    made = [(0, Vectors.sparse(1_000, {3: 1.0, 900: 2.5})), (1, Vectors.dense(1.0, 0.0, 4.0)), (2, Vectors.sparse(5, {}))]
    found = spark.createDataFrame(made, ["k", "v"]).select("k", prep.vector_total("v").alias("t"))
    assert {r["k"]: r["t"] for r in found.collect()} == {0: 3.5, 1: 5.0, 2: 0.0}


def test_permuted_rows_carry_a_column_once(spark, monkeypatch):
    """Features and label that are part of the order travel as their own copies only; long values keep their exact order."""
    seen = []
    real = models.positions
    monkeypatch.setattr(models, "positions", lambda df, order, out: seen.append((df.columns, list(order))) or real(df, order, out))
    rows = spark.createDataFrame([(i, float(-i % 5), 2**60 + i, i % 2) for i in range(40)], "k long, x double, z long, won int")
    found = models.permuted_variants(rows, ["x", "z"], "won", ["k", "x", "z", "won"])
    assert seen == [(["b0", "b1", "y", "k", "z"], ["k", "b0", "z", "y"])]
    own = sorted((r["x"], r["z"], r["won"]) for r in found.filter("variant = ''").collect())
    assert own == sorted((float(-i % 5), float(2**60 + i), float(i % 2)) for i in range(40))


def test_permuted_rows_do_not_depend_on_task_sizes(spark, same_rows, monkeypatch):
    rows = spark.createDataFrame([(i, float(i % 5), float(i % 3), i % 2) for i in range(60)], "k long, x double, z double, won int")
    plain = models.permuted_variants(rows, ["x", "z"], "won", ["k"])
    monkeypatch.setattr(models, "TASK_ROWS", 7)
    monkeypatch.setattr(models, "PART_ROWS", 11)
    small = models.permuted_variants(rows, ["x", "z"], "won", ["k"])
    assert small._jdf.queryExecution().analyzed().toString().count("RepartitionByExpression") == 2
    same_rows(plain, small)


def _tree_rows(spark, rows=6_000):
    chance = F.when(F.col("a") > 6, 0.3).otherwise(0.0) + F.col("b") / 60 + F.when(F.col("c") > 2, 0.2).otherwise(0.0)
    made = spark.range(rows).select("id", *((F.xxhash64("id", F.lit(n)) % 10_000 + 10_000).alias(n) for n in "abcp"))
    made = made.select((F.col("a") % 12).alias("a"), (F.col("b") % 30).alias("b"), (F.col("c") % 5).alias("c"), F.lit(1).alias("d"), "p")
    return made.select((F.col("p") % 1_000 < 1_000 * chance).cast("int").alias("won"), "a", "b", "c", "d")


def _fitted_rows(monkeypatch, kind):
    seen, real = [], kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, df, *rest: seen.append(df.count()) or real(self, df, *rest))
    return seen


def test_boosting_merges_rows_of_equal_bins(spark, monkeypatch):
    """Boosting over merged rows gives the importances of all rows."""
    df = _tree_rows(spark).cache()
    plain = {r[0]: r[1] for r in models.gbt_importance(df, ["a", "b", "c", "d"], "won", maxIter=3).collect()}
    seen = _fitted_rows(monkeypatch, models.GBTClassifier)
    merged = {r[0]: r[1] for r in models.gbt_importance(df, ["a", "b", "c", "d"], "won", maxIter=3, task_rows=100).collect()}
    assert merged == pytest.approx(plain, abs=1e-9)
    assert seen == [df.distinct().count()] and 2 * seen[0] <= df.count()


def test_forest_merges_rows_of_equal_bins(spark, monkeypatch):
    """A forest over merged rows has the importances of one over all rows, up to the draw of its samples."""
    df = _tree_rows(spark, 12_000).cache()
    plain = {r[0]: r[1] for r in models.rf_feature_selection(df, "won", trees=40)[1].collect()}
    seen = _fitted_rows(monkeypatch, models.RandomForestClassifier)
    merged = {r[0]: r[1] for r in models.rf_feature_selection(df, "won", trees=40, task_rows=100)[1].collect()}
    assert len(seen) == 40 and max(seen) <= df.distinct().count()
    assert merged == pytest.approx(plain, abs=0.05)
    again = {r[0]: r[1] for r in models.rf_feature_selection(df, "won", trees=40, task_rows=100)[1].collect()}
    assert again == pytest.approx(merged, abs=1e-9)


def test_bags_take_rows_as_a_bootstrap_does(spark):
    cells = spark.range(2_000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2 * 30 + 1).alias("weight"))
    bags = models.bagged_cells(cells, 3, 7)
    for t in range(3):
        found = {r["weight"]: r for r in bags.groupBy("weight").agg(F.avg(f"w{t}").alias("m"), F.var_samp(f"w{t}").alias("v")).collect()}
        for weight in (1, 31):
            assert found[weight]["m"] == pytest.approx(weight, rel=0.15) and found[weight]["v"] == pytest.approx(weight, rel=0.25)


def test_cells_keep_missing_values_an_error(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 0)] * 50, "x double, won int")
    with pytest.raises(Exception):
        models.gbt_importance(df, ["x"], "won", maxIter=1, task_rows=0).collect()


def test_cells_are_no_fewer_than_bins_where_rows_hardly_merge(spark):
    df = spark.range(1_000).select((F.col("id") % 2).alias("won"), *(F.rand(n).alias(f"x{n}") for n in range(4)))
    assert models.tree_cells(df, [f"x{n}" for n in range(4)], "won", task_rows=0) is None
    cells = models.tree_cells(df, ["x0"], "won", task_rows=0)
    assert cells.count() == 64 and cells.agg(F.sum("weight")).first()[0] == 1_000
