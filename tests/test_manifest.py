"""Partition manifests: what is stale, what is written again, and what stays."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sonde.cluster import scratch_path
from sonde.operators import manifest


def table(spark, rows):
    return spark.createDataFrame(rows, "part string, id int, x double, note string")


ROWS = [(p, i, i / 4, None if i % 3 else f"n{i}") for p in ("01", "b", None) for i in range(6)]


def listing(path):
    return {f.parent.name: f.name for f in Path(path).glob("part=*/*.parquet")}


def test_digest_ignores_order_and_counts_copies(spark):
    df = table(spark, ROWS)
    a = manifest.manifest_of(df, ["part"]).orderBy("part").collect()
    assert a == manifest.manifest_of(df.repartition(5).orderBy(F.desc("id")), ["part"]).orderBy("part").collect()
    assert a != manifest.manifest_of(df.union(df.limit(1)), ["part"]).orderBy("part").collect()
    assert {r["part"]: (r["n_rows"], r["nulls"]["note"]) for r in a} == {"01": (6, 4), "b": (6, 4), None: (6, 4)}
    # Null, empty text and text that looks like two fields differ.
    one = [manifest.manifest_of(spark.createDataFrame([(1, a, b)], "p int, a string, b string"), ["p"]).first()["digest"]
           for a, b in ((None, "x"), ("", "x"), ("x", None), ("1:x", ""), ("-", "x"))]
    assert len(set(one)) == 5


def test_stale_partitions_and_rework(spark):
    path, df = scratch_path(spark, "recorded"), table(spark, ROWS)
    double = lambda d: d.withColumn("x", F.col("x") * 2)
    manifest.write_recorded(df, path, ["part"], double)
    reasons = lambda src: {r["part"]: r["reason"] for r in manifest.stale_partitions(src, path, ["part"]).collect()}
    assert reasons(df) == {}
    before = listing(path)
    later = table(spark, [r for r in ROWS if r[0] != "b"] + [("c", 1, 1.0, None), ("01", 9, None, None)])
    assert reasons(later) == {"01": "changed", "b": "gone", "c": "new"}
    found = manifest.rework_stale(later, path, ["part"], double)
    assert {r["part"]: r["reason"] for r in found.collect()} == {"01": "changed", "b": "gone", "c": "new"}
    after = listing(path)
    assert after["part=b"] == before["part=b"]
    null = "part=__HIVE_DEFAULT_PARTITION__"
    assert after[null] == before[null] and after["part=01"] != before["part=01"]
    got = spark.read.schema("id int, x double, note string, part string").parquet(path).filter("part = '01' OR part = 'c'")
    assert sorted((r["id"], r["x"]) for r in got.collect() if r["x"] is not None) == sorted(
        [(i, i / 2) for i in range(6)] + [(1, 2.0)])
    # Nothing is due twice; a folder without a source stays reported, and so does an empty column.
    assert reasons(later) == {"b": "gone", "c": "incomplete"}
    again = listing(path)
    manifest.rework_stale(later, path, ["part"], double)
    assert listing(path) == again


def test_a_lost_file_is_found(spark):
    path, df = scratch_path(spark, "recorded"), table(spark, ROWS)
    manifest.write_recorded(df, path, ["part"])
    # The folder is written over, past the record.
    df.filter("part = 'b' AND id < 5").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    found = manifest.rework_stale(df, path, ["part"])
    assert [tuple(r) for r in found.collect()] == [("b", "damaged")]
    assert manifest.stale_partitions(df, path, ["part"]).count() == 0
    assert spark.read.parquet(path).count() == len(ROWS)


@pytest.mark.parametrize("by", [["part"], ["part", "id"]])
def test_one_pass(spark, by):
    plan = manifest.manifest_of(table(spark, ROWS), by)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
