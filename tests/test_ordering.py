"""The chunked and swept plans for hot groups give the rows of the plain window plans."""

import pytest
from pyspark.sql import functions as F

from bindings.tables import Tables
from chronoweave import ordering, skew
from chronoweave.operators import profile
from chronoweave.operators import temporal as t

HOT = 150  # rows per task that make every group count as hot


@pytest.fixture(scope="module")
def events(spark, data_dir):
    """A third of the rows share one entity, some rows have none, and seconds repeat."""
    rows = Tables(spark, data_dir).ev_null
    hot = F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id"))
    return rows.withColumns(
        {"user_id": F.when(F.col("user_id").isNotNull(), hot), "sec": F.col("sec") - F.col("sec") % 600}
    ).cache()


CASES = {
    "trailing_count": lambda df, n: t.trailing_count(df, "user_id", "sec", {"n": F.col("flag")}, task_rows=n),
    "trailing_mean": lambda df, n: t.trailing_mean(df, "user_id", "sec", {"v": F.col("value")}, task_rows=n),
    "history_rates": lambda df, n: t.history_rates(df, "user_id", "sec", {"f": F.col("flag")}, task_rows=n),
    "expanding_rate": lambda df, n: t.expanding_rate(df, "user_id", "sec", F.col("flag"), task_rows=n),
    "rolling_rate": lambda df, n: t.rolling_rate(df, "user_id", "sec", F.col("flag"), 14, task_rows=n),
    "trailing_arrivals": lambda df, n: t.trailing_arrivals(
        df.filter("event_type = 'click'"), df.filter("event_type = 'view'"), "user_id", "sec", task_rows=n
    ),
    "entity_lag": lambda df, n: t.entity_lag(
        df, "user_id", ["sec"], ["event_id"], {"value": "v1", "event_type": "t1"}, task_rows=n
    ),
    "entity_lag_known": lambda df, n: t.entity_lag_known(
        df.withColumn("known_at", F.col("sec") + 3600 * F.col("h")),
        "user_id", ["sec"], ["event_id"], {"value": "v1", "sec": "s1"}, "sec", "known_at", 600, task_rows=n,
    ),
    "first_event_flag": lambda df, n: t.first_event_flag(df, "user_id", ["sec"], ["event_id"], task_rows=n),
    "positions": lambda df, n: ordering.positions(df, ["sec", "event_id"], task_rows=n),
    "positions_descending": lambda df, n: ordering.positions(df, [F.col("sec").desc(), "event_id"], task_rows=n),
    "cumulative_counts": lambda df, n: ordering.cumulative_counts(df, ["user_id"], "value", task_rows=n),
    "exact_quantiles": lambda df, n: ordering.exact_quantiles(
        df, ["event_type"], "value", {"q1": 0.25, "q2": 0.5}, task_rows=n
    ),
    "exact_quantiles_overall": lambda df, n: ordering.exact_quantiles(df, [], "value", {"q9": 0.9}, task_rows=n),
    "boxplot_stats": lambda df, n: profile.boxplot_stats(df, ["value", "h"], "flag", task_rows=n),
    "spearman_matrix": lambda df, n: profile.spearman_matrix(df, ["value", "h"], task_rows=n),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_plan_equals_plain_plan(events, same_rows, name):
    same_rows(CASES[name](events, 10**9), CASES[name](events, HOT))


def test_crowded_frames_change_the_plan_only(events, same_rows, monkeypatch):
    plain = CASES["history_rates"](events, 10**9)
    monkeypatch.setattr(skew, "FRAME_WORK", 1)
    swept = CASES["history_rates"](events, 10**9)
    assert "explode" in swept._jdf.queryExecution().analyzed().toString()
    same_rows(plain, swept)


def test_chunks_are_balanced_for_one_hot_key(events):
    chunked = ordering.ordered_chunks(events.filter("user_id = 7"), ["user_id", "sec", "event_id"], 8)
    sizes = [r["count"] for r in chunked.groupBy(ordering.CHUNK).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)


def test_lag_needs_a_tiebreak(events):
    with pytest.raises(ValueError):
        t.entity_lag(events, "user_id", ["sec"], [], {"value": "v1"})


def test_later_rows_do_not_change_features(events, same_rows):
    """Point-in-time safety: appending the second half leaves the first half's features alone."""
    middle = events.approxQuantile("sec", [0.5], 0.0)[0]
    early = events.filter(F.col("sec") <= middle)
    for name in ("trailing_count", "trailing_mean", "history_rates", "entity_lag", "first_event_flag"):
        alone = CASES[name](early, 10**9)
        within = CASES[name](events, 10**9).filter(F.col("sec") <= middle)
        same_rows(alone, within)


def test_every_row_comes_back_once(events):
    total = events.count()
    for name in ("trailing_count", "trailing_mean", "history_rates", "entity_lag", "first_event_flag", "positions"):
        assert CASES[name](events, HOT).count() == total


def test_range_frame_by_brute_force(spark):
    rows = [(e, s, (e * s) % 3 == 0) for e in (1, 2) for s in (0, 5, 5, 7200, 7201, 7205, 14400, 90000)]
    df = spark.createDataFrame(rows, "e int, s long, f boolean")
    expected = sorted(
        (e, s, sum(f2 for e2, s2, f2 in rows if e2 == e and s - 7200 <= s2 <= s - 1)) for e, s, f in rows
    )
    for limit in (1, 10**9):
        found = t.trailing_count(df, "e", "s", {"n": F.col("f").cast("int")}, task_rows=limit)
        assert sorted((r["e"], r["s"], r["n"]) for r in found.collect()) == expected


@pytest.mark.parametrize("frame", [(-10, -1), (-7200, -1), (-7200, 0), (-5, -5), (-900, -1), (-90 * 86_400, -86_400), (-100_000, -50)])
def test_block_sums_equal_the_plain_window(spark, frame):
    """Frames of one block, of whole blocks and of many, over seconds that lie on and off their edges."""
    seconds = sorted({(k * k * 977) % 9_000_000 for k in range(400)} | {900 * k for k in range(60)} | set(range(0, 40)))
    rows = spark.createDataFrame([(e, s, float(s % 97) / 7) for e in (1, 2) for s in seconds], "e int, s long, v double")
    wanted, held = rows.select("e", "s"), {"w": t.Frame(*frame), "x": t.Frame(frame[0] - 3, frame[1])}
    found = {(r["e"], r["s"]): r for r in t._tiled_totals(wanted, rows, "e", "s", ["v"], held).collect()}
    plain = {(r["e"], r["s"]): r for r in t._window_totals(rows, "e", "s", {"v": F.col("v")}, held).collect()}
    assert found.keys() == plain.keys()
    for key, row in plain.items():
        assert found[key]["v_w"] == pytest.approx(row["v_w"], abs=1e-9) and found[key]["v_x"] == pytest.approx(row["v_x"], abs=1e-9)


def test_quantiles_of_missed_brackets(events, same_rows):
    """A useless bracket sends the group to the full ranking; ties, nulls and NaN keep their ranks."""
    odd = events.withColumn("value", F.when(F.col("h") == 3, F.lit(float("nan"))).when(F.col("h") != 4, F.round("value")))
    quantiles = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.999, "q4": 1.0}
    for group in (["event_type"], []):
        exact = ordering._ranked_quantiles(odd.filter("value IS NOT NULL"), group, "value", quantiles, 10**9)
        same_rows(ordering.exact_quantiles(odd, group, "value", quantiles), exact)
        same_rows(ordering.exact_quantiles(odd, group, "value", quantiles, accuracy=2), exact)
    small = events.limit(3).select(F.col("event_id").alias("value"))
    same_rows(
        ordering.exact_quantiles(small, [], "value", {"q": 0.25}), ordering._ranked_quantiles(small, [], "value", {"q": 0.25}, 10**9)
    )
    assert ordering.exact_quantiles(events.limit(0), ["event_type"], "value", {"q": 0.5}).count() == 0


def test_stretches_are_counted_for_long_timelines_only(events, same_rows, monkeypatch):
    widths, measure = [], skew.timeline_shape
    monkeypatch.setattr(t, "timeline_shape", lambda *a, width_s=None: widths.append(width_s) or measure(*a, width_s=width_s))
    plain = CASES["trailing_count"](events, 10**9)
    assert widths and not any(widths)
    # Timelines so long that frames could be too much work, though their stretches show that they are not.
    largest = events.groupBy("user_id").count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(skew, "FRAME_WORK", 2 * largest**2 - 1)
    same_rows(plain, CASES["trailing_count"](events, 10**9))
    assert any(widths)


@pytest.mark.parametrize("heavy", [1_000, 3])
def test_ranks_come_back_without_an_exchange_of_all_cells(spark, same_rows, monkeypatch, heavy):
    """A frequent value, zeros of both signs and nulls; looked up from a broadcast side, or with light values in an exchange."""
    values = [(0.0 if i % 2 else -0.0, float(i % 7), float(i * i % 53)) if i % 3 else (5.0, None if i % 9 == 0 else 2.5, float(i)) for i in range(300)]
    rows = spark.createDataFrame(values, "a double, b double, c double")
    plain = rows.toPandas().dropna().rank().corr()
    monkeypatch.setattr(profile, "HEAVY", heavy)
    for broadcast_rows in (10**6, 0):
        found = profile.spearman_matrix(rows, ["a", "b", "c"], broadcast_rows=broadcast_rows)
        assert {(r["a"], r["b"]): round(r["corr"], 9) for r in found.collect()} == {
            (x, y): round(plain.loc[x, y], 9) for x in "abc" for y in "abc"
        }
    assert "unpivot" not in str(found._jdf.queryExecution().analyzed()).lower()


def test_positions_exchange_rows_once(events):
    """Ranges are numbered where they were sorted: no second exchange brings a range together."""
    numbered = ordering.positions(events, ["sec", "event_id"], task_rows=HOT)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and f"hashpartitioning({ordering.CHUNK}" not in plan.split("BroadcastExchange")[0]
    assert sorted(r["position"] for r in numbered.select("position").collect()) == list(range(1, events.count() + 1))
