"""Column and row deletion, profiles, imputation, scans and sinks on literal frames."""

import math

import pytest
from pyspark.sql import functions as F

from sonde.functions import binary_target, composite_id, multiclass_target, value_type
from sonde.operators import impute, profile, quantiles, tables
from sonde import reference, sources
from sonde.cluster import scratch_path


def test_reference_lists():
    assert len(reference.TAGS) == 35 and len(reference.SENSOR_TAGS) == 23
    assert len(reference.CONTINUOUS_TAGS) == 14 and len(reference.CATEGORICAL_TAGS) == 9


def test_nan_counts_as_missing_only_where_it_exists(spark):
    df = spark.createDataFrame([(1.0, "x"), (math.nan, None), (None, "y")], "v double, s string")
    got = {r["Tag"]: r["missing_pct"] for r in profile.missing_by(df, [], ["v", "s"]).collect()}
    assert got == {"v": 66.7, "s": 33.3}


def test_missing_of_an_empty_table_is_null(spark):
    df = spark.createDataFrame([], "v double")
    assert profile.missing_by(df, [], ["v"]).first()["missing_pct"] is None


def test_hyphenated_names(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, None, 3.0)], "t int, `P-PDG` double, `T-TPT` double")
    flagged = tables.missing_flags(df, ["P-PDG", "T-TPT"])
    assert flagged.agg(F.sum("`P-PDG_missing`")).first()[0] == 1
    assert profile.distinct_by(df, [], df.columns).count() == 3
    filled = impute.fit_continuous(df, ["P-PDG", "T-TPT"]).transform(df)
    assert filled.na.drop().count() == 2


def test_target_maps(spark):
    klasses = [None, 0, 1, 3, 4, 9, 101, 102, 103, 105, 109]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(klasses)], "i int, c int")
    rows = df.select("i", binary_target(F.col("c")).alias("b"),
                     multiclass_target(F.col("c")).alias("m")).orderBy("i").collect()
    assert [r["b"] for r in rows] == [0, 0, 0, 1, 1, 0, 1, 1, 0, 1, 1]
    assert [r["m"] for r in rows] == [0, 0, 0, 3, 4, 0, 101, 102, 0, 105, 109]


def test_value_type_rules(spark):
    df = spark.createDataFrame(
        [("a", 0), ("DataType", 1), ("label", 10), ("well", 9), ("DataType", 9),
         ("timestamp", 9), ("P-PDG", 9), ("Instance", 9)], "tag string, n bigint")
    got = [r[0] for r in df.select(value_type(F.col("n"), F.col("tag"))).collect()]
    assert got == ["Empty", "Categorical", "Classifier", "Identifier", "Dataset", "Timestamp",
                   "Continuous", "Identifier"]


def test_composite_id(spark):
    df = spark.createDataFrame([("WELL-00001", "3", 4), ("DRAWN", "3", 4), ("SIMULATED", "1", 2)],
                               "well string, id string, label int")
    got = [r[0] for r in df.select(composite_id(F.col("well"), F.col("id"), F.col("label")))
           .collect()]
    assert got == ["3", "DRAWN - 3 - 4", "SIMULATED - 1 - 2"]


def test_column_drops(spark):
    df = spark.createDataFrame([(1, None, 1.0, None), (2, None, None, 2.0), (3, None, None, 3.0)],
                               "a int, b double, c double, d double")
    assert tables.drop_empty_columns(df).columns == ["a", "c", "d"]
    assert tables.drop_sparse_columns(df).columns == ["a", "d"]
    assert tables.drop_sparse_columns(df, max_missing=0.7).columns == ["a", "c", "d"]
    assert tables.drop_void_columns(df.withColumn("v", F.lit(None))).columns == df.columns


def test_half_present_is_kept(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert tables.drop_sparse_columns(df, 0.5).columns == ["v"]


def test_check_complete(spark):
    ok = spark.createDataFrame([(1.0, "x")], "v double, s string")
    tables.check_complete(ok, ["v"])
    with pytest.raises(ValueError, match="not numeric"):
        tables.check_complete(ok, ["s"])
    with pytest.raises(ValueError, match="nulls"):
        tables.check_complete(ok.withColumn("v", F.lit(None).cast("double")), ["v"])


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (1.0,), (1.0,), (None,)], "v double")
    assert impute.fit_categorical(df, ["v"]).values == {"v": 1.0}
    assert profile.most_frequent(df, "v").first()["v"] == 1.0


def test_imputers(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None), (None, None), (10.0, None)],
                               "v double, e double")
    assert impute.fit_continuous(df, ["v", "e"]).values == {"v": 5.0, "e": None}
    assert impute.fit_continuous(df, ["v"], "median", exact=True).values == {"v": 4.0}
    assert impute.fit_continuous(df, ["v"], "median").values == {"v": 4.0}
    out = impute.fit_continuous(df, ["v", "e"]).transform(df).collect()
    assert sorted(r["v"] for r in out) == [1.0, 4.0, 5.0, 10.0] and {r["e"] for r in out} == {None}
    with pytest.raises(ValueError):
        impute.fit_continuous(df, ["v"], "max")


def test_group_mean_leaves_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 4.0), (None, None)],
                               "k string, v double")
    got = sorted(map(str, impute.impute_group_mean(df, ["v"], ["k"]).collect()))
    assert got == sorted(["Row(k='a', v=1.0)", "Row(k='a', v=1.0)", "Row(k='b', v=None)",
                          "Row(k=None, v=4.0)", "Row(k=None, v=4.0)"])


@pytest.mark.parametrize("size", [None, 9])
def test_exact_quantiles(spark, size):
    import numpy as np

    rng = np.random.default_rng(3)
    data = [(float(a), float(b)) for a, b in zip(rng.integers(0, 30, 400), rng.normal(size=400))]
    df = spark.createDataFrame(data, "a double, b double")
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {r["Tag"]: r for r in quantiles.exact_quantiles(df, ["a", "b"], probs, size).collect()}
    for i, name in enumerate(("a", "b")):
        want = np.quantile([d[i] for d in data], probs)
        assert [got[name][f"q{j}"] for j in range(5)] == pytest.approx(list(want))


def test_describe_exact_and_approximate(spark):
    df = spark.createDataFrame([(float(v), None) for v in range(101)], "v double, e double")
    for exact in (True, False):
        got = {r["Tag"]: r for r in profile.describe_numeric(df, ["v", "e"], exact=exact).collect()}
        assert [got["v"][c] for c in ("n", "mean", "min", "p25", "p50", "p75", "max")] == [
            101, 50.0, 0.0, 25.0, 50.0, 75.0, 100.0]
        assert got["e"]["n"] == 0 and got["e"]["p50"] is None


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("g", 2.0), ("g", 2.0), ("g", None)], "g string, v double")
    rows = profile.histogram_bins(df, ["v"], "g", 30).collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(15, 2)]


def test_duplicates_with_nulls_and_hot_keys(spark):
    rows = [(i, "x", None) for i in range(20)] + [(20, "y", 1), (21, "y", 1), (22, "z", None)]
    df = spark.createDataFrame(rows, "id int, a string, b int")
    assert profile.duplicate_count(df, ["id"]).first()[0] == 20
    for hot in (1_000_000, 5):
        ids = {r["id"] for r in profile.duplicate_rows(df, ["id"], hot).collect()}
        assert ids == set(range(22))


def test_union_aligned_fills_both_sides(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert sorted((tuple(r) for r in tables.union_aligned(a, b).collect()), key=str) == [
        (1, 2, None), (4, None, 3)]


def test_rewriting_some_partitions_keeps_the_others(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "label int, v double")
    sources.write_partitioned(df, path, ["label"])
    sources.write_partitioned(df.filter("label = 2").withColumn("v", F.lit(9.0)), path, ["label"],
                              only_touched=True)
    back = spark.read.schema(df.schema).parquet(path)
    assert {(r["label"], r["v"]) for r in back.collect()} == {(1, 1.0), (2, 9.0)}
    plan = sources.read_partitions(back, "label", [2])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(label" in plan


def test_retention_and_overview_of_empty(spark, tables):
    df = tables.obs().limit(0)
    assert profile.data_overview(df, "id").first()["n_rows"] == 0
    assert profile.duplicate_count(df).first()[0] == 0
