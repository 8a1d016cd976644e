"""Windowed operators: small cases, hot-key paths against plain windows, stability."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adperf.operators import spread, tables, windows

HOT = {"share": 0.1, "min_rows": 0}


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def events(spark):
    """User 0 holds a third of all rows; some timestamps are missing or repeated."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        user = 0 if i % 3 == 0 else rng.randrange(1, 60)
        second = None if rng.random() < 0.02 else rng.randrange(0, 200_000) // 60 * 60
        rows.append((i, user, second, rng.choice(["a", "b", None])))
    df = spark.createDataFrame(rows, "id int, user int, second int, tag string")
    return df.withColumn("ts", F.timestamp_seconds("second")).cache()


def plain_sessions(df, gap=1800):
    w = Window.partitionBy("user").orderBy("ts", "id")
    seconds = F.unix_timestamp("ts")
    g = df.withColumn("time_since_last_action", seconds - F.lag(seconds).over(w))
    opened = F.when(F.col("time_since_last_action") > gap, 1).otherwise(0)
    return g.withColumn(
        "session_id", F.sum(opened).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )


def test_hot_user_of_null_timestamps_and_one_burst(spark):
    rows = [(i, 0, None if i % 2 else 1000 + i % 7) for i in range(400)] + [(400 + i, 1 + i % 9, i * 100) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, user int, second int").withColumn("ts", F.timestamp_seconds("second"))
    got = windows.sessionize(df, "user", "ts", ["id"], slices=6, **HOT)
    cols = ["id", "time_since_last_action", "session_id"]
    assert rows_of(got.select(*cols), "id") == rows_of(plain_sessions(df).select(*cols), "id")
    cut = windows.slice_by_range(df.filter("user = 0 and ts is not null"), F.asc("user"), F.asc("ts"), F.asc("id"), slices=6)
    assert max(r["count"] for r in cut.groupBy("_slice").count().collect()) < 2 * 200 / 6


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_hot_users_get_the_same_sessions(events, slices):
    got = windows.sessionize(events, "user", "ts", ["id"], slices=slices, **HOT)
    cols = ["id", "time_since_last_action", "session_id"]
    assert rows_of(got.select(*cols), "id") == rows_of(plain_sessions(events).select(*cols), "id")


def test_sessions_of_the_documented_case(spark):
    seconds = [0, 3600, 3900, 10_800]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(seconds)], "user int, id int, s int")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    ids = [r["session_id"] for r in windows.sessionize(df, "user", "ts", ["id"]).orderBy("id").collect()]
    assert ids == [0, 1, 1, 2]
    kept = windows.sessionize(df, "user", "ts", ["id"], compat=True)
    assert [r["session_id"] for r in kept.orderBy("id").collect()] == [0, 1, 0, 2]


@pytest.mark.parametrize("hot", [{}, HOT])
def test_group_stats_equal_window(events, hot):
    got = windows.group_stats_onto_rows(
        events.select("id", "user", "second"), ["user"], {"n": F.count("*"), "s": F.sum("second")}, **hot
    )
    w = Window.partitionBy("user")
    want = events.select(
        "id", "user", "second", F.count("*").over(w).alias("n"), F.sum("second").over(w).alias("s")
    )
    assert rows_of(got, "id") == rows_of(want, "id")


def test_null_keys_are_a_group(events):
    got = windows.group_stats_onto_rows(events.select("id", "tag"), ["tag"], {"n": F.count("*")}, **HOT)
    want = Counter(r["tag"] for r in events.collect())
    assert all(r["n"] == want[r["tag"]] for r in got.collect())
    assert got.count() == events.count()


def test_hot_list_is_bounded_and_right(events):
    hot = [r["user"] for r in spread.hot_keys(events, ["user"], 0.1, 0).collect()]
    assert hot == [0]


def test_inner_attach_drops_unknown_keys(events, spark):
    side = spark.createDataFrame([(0, "zero"), (5, "five")], "user int, name string")
    got = spread.attach_by_key(events.select("id", "user"), side, ["user"], "inner", **HOT)
    want = events.filter("user IN (0, 5)").count()
    assert got.count() == want and {r["name"] for r in got.collect()} == {"zero", "five"}


@pytest.mark.parametrize("hot", [{}, HOT])
def test_fill_uses_the_most_frequent_value(spark, hot):
    rows = [(1, 1, None), (2, 1, "M"), (3, 1, "F"), (4, 1, "M"), (5, 2, None), (6, 3, "F"), (7, 3, "M"), (8, 3, None)]
    df = spark.createDataFrame(rows, "id int, u int, g string")
    got = windows.fill_from_group(df, "u", "g", "Other", into="filled", **hot)
    assert [r["filled"] for r in got.orderBy("id").collect()] == ["M", "M", "F", "M", "Other", "F", "M", "F"]
    resolved = windows.fill_from_group(df, "u", "g", "Other", into="filled", resolve_conflicts=True, **hot)
    assert [r["filled"] for r in resolved.orderBy("id").collect()] == ["M"] * 4 + ["Other"] + ["F"] * 3


def test_top_per_group_ranks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "k string, v int")
    got = windows.top_per_group(df, ["k"], [F.desc("v")], 2)
    assert rows_of(got, "k", "rank") == [("a", 3, 1), ("a", 2, 2), ("b", 5, 1)]


@pytest.mark.parametrize("slices", [1, 4, 50])
def test_running_totals(spark, slices):
    values = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(float(v), v % 7, 1) for v in values], "s double, a long, b long")
    got = windows.running_totals(df, "s", ["a", "b"], slices=slices).orderBy(F.desc("s")).collect()
    a = b = 0
    for r in got:
        a, b = a + r["a"], b + r["b"]
        assert (r["cum_a"], r["cum_b"]) == (a, b)


@pytest.mark.parametrize("slices", [1, 5])
def test_running_totals_per_group(spark, slices):
    rng = random.Random(9)
    rows = [(rng.choice(["x", "y", None]), float(v), rng.randrange(9)) for v in rng.sample(range(9999), 300)]
    df = spark.createDataFrame(rows, "k string, s double, a long")
    got = windows.running_totals(df, "s", ["a"], by=["k"], slices=slices).orderBy("k", F.desc("s")).collect()
    sums = Counter()
    for r in got:
        sums[r["k"]] += r["a"]
        assert r["cum_a"] == sums[r["k"]]
    assert len(got) == 300


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "k string, n int")
    got = {(r["k"], r["n"]): r["share"] for r in windows.share_of_group(df, ["k"], "n", "share").collect()}
    assert got == {("a", 1): 0.25, ("a", 3): 0.75, (None, 5): 1.0}


def test_medians_are_exact(spark):
    rng = random.Random(5)
    rows = [("x", rng.choice([1.0, 2.0, 2.0, 2.0, 9.5])) for _ in range(301)]
    rows += [("y", rng.random()) for _ in range(400)] + [("z", 4.0), ("z", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["median_v"] for r in tables.medians(df, "k", "v").collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_results_do_not_depend_on_partitioning(events):
    def run(df):
        stats = windows.group_stats_onto_rows(df.select("id", "user"), ["user"], {"n": F.count("*")}, **HOT)
        return rows_of(stats, "id")

    assert run(events.repartition(1)) == run(events.repartition(13, "tag"))


@pytest.mark.parametrize("q", [0.0, 0.25, 0.9, 1.0])
def test_quantiles_are_exact(spark, q):
    rng = random.Random(8)
    df = spark.createDataFrame([(rng.choice([1.0, 5.0, rng.random() * 9]),) for _ in range(501)], "v double")
    got = tables.quantile(df, "v", q).first()[0]
    assert got == pytest.approx(df.agg(F.percentile("v", q)).first()[0], abs=1e-12)
