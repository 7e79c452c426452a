"""Series operators: literal frames, and cut series against uncut ones."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sonde.operators import impute, series

ORDER = ["ts", "event_id"]


def frame(spark, values, key="a"):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values)],
                                 "k string, t int, v double")


def values(df, name="v"):
    return [r[name] for r in df.orderBy("t").collect()]


def test_fill_leading_inner_trailing(spark):
    df = frame(spark, [None, 1.0, None, 3.0, None])
    assert values(series.ffill_bfill(df, ["v"], ["k"], ["t"])) == [1.0, 1.0, 1.0, 3.0, 3.0]
    only = series.ffill_bfill(df, ["v"], ["k"], ["t"], backward=False)
    assert values(only) == [None, 1.0, 1.0, 3.0, 3.0]


def test_fill_stays_inside_its_series(spark):
    df = frame(spark, [1.0, None]).unionByName(frame(spark, [None, None], "b"))
    out = series.ffill_bfill(df, ["v"], ["k"], ["t"])
    assert values(out.filter("k = 'b'")) == [None, None]


def test_empty_and_single_row(spark):
    empty = frame(spark, [1.0]).limit(0)
    assert series.ffill_bfill(empty, ["v"], ["k"], ["t"]).count() == 0
    assert series.lag_features(empty, "v", 2, [], ["t"]).count() == 0
    assert values(series.position(frame(spark, [5.0]), ["k"], ["t"]), "position") == [0]
    assert values(series.time_diff(
        frame(spark, [5.0]).withColumn("t", F.timestamp_seconds("t")), "t", ["k"], ["t"]),
        "time_diff") == [None]


@pytest.fixture(scope="module")
def events(tables):
    """A third of the rows belong to one series, a few to one with a null key."""
    hot = F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 50 == 1, None)
    return tables.obs().select(
        "event_id", "ts", "p_main", "p_aux", "well", "state",
        hot.otherwise(F.col("instance")).alias("instance"),
        F.lit(1).cast("bigint").alias("one")).cache()


OPERATORS = {
    "fill": lambda df, keys, n: series.ffill_bfill(df, ["p_main", "p_aux"], keys, ORDER, n),
    "forward": lambda df, keys, n: series.ffill_bfill(df, ["state"], keys, ORDER, n,
                                                      backward=False),
    "lags": lambda df, keys, n: series.lag_features(df, "p_main", 3, keys, ORDER, n, False),
    "diff": lambda df, keys, n: series.time_diff(df, "ts", keys, ORDER, rows_per_chunk=n),
    "windows": lambda df, keys, n: series.sequence_windows(
        df.fillna(0.0, ["p_main"]), ["p_main"], "well", 25, keys, ORDER, n),
    "total": lambda df, keys, n: series.running_total(df, ["one"], keys, ORDER, n),
    "position": lambda df, keys, n: series.position(df, keys, ORDER, rows_per_chunk=n),
}


@pytest.mark.parametrize("keys", [[], ["instance"]], ids=["global", "keyed"])
@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_cut_series_give_the_same_rows(events, name, keys):
    run = OPERATORS[name]
    want = Counter(map(str, run(events, keys, None).collect()))
    for size in (40, 7):  # 7 rows: windows of 25 reach over several chunks
        assert Counter(map(str, run(events, keys, size).collect())) == want


def test_chunks_stay_small(events):
    cut = series.cut_series(events, ["instance"], ORDER, 40)
    sizes = [r["n"] for r in cut.df.groupBy("instance", "_chunk").agg(
        F.count("*").alias("n")).collect()]
    assert cut.chunks > 0 and max(sizes) <= 4 * 40
    assert sum(sizes) == events.count()


def test_fill_keeps_present_values(events):
    out = series.ffill_bfill(events, ["p_main"], ["instance"], ORDER, 40)
    both = events.select("event_id", F.col("p_main").alias("was")).join(out, "event_id")
    assert both.filter("was IS NOT NULL AND was <> p_main").count() == 0
    assert out.count() == events.count()


def test_mean_step_equals_mean_of_steps(events):
    keyed = events.filter("instance IS NOT NULL")
    steps = series.time_diff(keyed, "ts", ["instance"], ORDER).groupBy("instance").agg(
        F.avg("time_diff").alias("m"))
    both = series.mean_time_step(keyed, "ts", ["instance"]).join(steps, "instance")
    assert both.filter("abs(m - avg_step_seconds) > 1e-3").count() == 0


@pytest.mark.parametrize("label, klass, state, want", [
    (5, [None, 0, None, None], [0, 0, 1, 0], [0, 0, 105, 5]),
    (3, [None, 0, None, None], [0, 0, 1, 0], [0, 0, 3, 3]),
    (5, [None, None], [1, 0], [105, 5]),
])
def test_class_repair(spark, label, klass, state, want):
    df = spark.createDataFrame(
        [("a", i, label, s, c) for i, (c, s) in enumerate(zip(klass, state))],
        "k string, t int, label int, state int, class int")
    for size in (None, 1):
        out = impute.class_repair(df, ["k"], ["t"], rows_per_chunk=size)
        assert values(out, "class") == want
