"""Physical plans: pushed filters, pruned columns, one shuffle per fill."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sonde.cluster import scratch_path, spread
from sonde.operators import split
from sonde.sources import load_instances

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_reaches_the_scan(spark):
    plan = plan_of(entry.queries()["limit_topk"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    plan = plan_of(entry.queries()["join_semi"](spark, FOLDER))
    assert "EqualTo(l_returnflag,R)" in plan


def test_fill_shuffles_and_sorts_once(spark):
    plan = plan_of(entry.queries()["ffill_bfill"](spark, FOLDER))
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1


def test_scoring_columns_are_pruned(tables):
    plan = plan_of(tables.obs().select("p_main", "label"))
    assert "props" not in plan.split("ReadSchema")[1]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_by_hash_shuffles_rows_once(tables, no_broadcast):
    df = tables.obs().select("event_id", "class")
    plan = plan_of(split.hash_rank(df, ["class"], ["event_id"]))
    # Rows once; the bucket sizes to be counted, to be summed by stratum, and to be joined.
    assert plan.count("Exchange") == 4


def test_split_report_reads_its_rows_once(tables):
    df = tables.obs().withColumn("split", F.lit("train"))
    assert plan_of(split.split_report(df, "class", "instance")).count("FileScan") == 1


def test_small_tables_are_spread_and_large_ones_kept(spark):
    assert spread(spark.range(5_000, numPartitions=1)).rdd.getNumPartitions() == 1
    assert spread(spark.range(30_000, numPartitions=1)).rdd.getNumPartitions() == 3
    assert spread(spark.range(500_000, numPartitions=20)).rdd.getNumPartitions() == 20


def test_tasks_of_large_tables_are_bounded(spark):
    assert spread(spark.range(6_000_000, numPartitions=8)).rdd.getNumPartitions() == 12


def test_recordings_of_several_files_have_one_number(spark):
    root = scratch_path(spark, "recordings")
    for name, n in (("a", 4), ("b", 3)):
        spark.range(100).repartition(n).write.parquet(f"{root}/Instance_{name}.parquet")
    spark.range(10).coalesce(1).write.parquet(f"{root}-more/deep/Instance_c.parquet")
    out = load_instances(spark, {"Real": root, "Drawn": f"{root}-more"}, spark.range(1).schema)
    got = out.groupBy("DataType", "Instance").count().collect()
    assert sorted(map(tuple, got)) == [("Drawn", 2, 10), ("Real", 0, 100), ("Real", 1, 100)]
