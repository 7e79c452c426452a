"""Blocks of series with halos, windows of any stride, numbered batches."""

import pytest
from pyspark.sql import functions as F

from sonde.cluster import scratch_path
from sonde.operators import sequences, series


@pytest.fixture(scope="module")
def table(spark):
    rows = [(k, i, float((k or 0) * 100 + i), i % 3) for k, n in ((1, 0), (2, 3), (3, 10), (4, 47), (None, 12))
            for i in range(n)]
    return spark.createDataFrame(rows, "k int, i int, x double, y int")


def plain(rows, length, step):
    out = []
    for k in (None, 2, 3, 4):
        own = sorted(r for r in rows if r[0] == k) if k else sorted(
            (r for r in rows if r[0] is None), key=lambda r: r[1])
        for e in range(length - 1, len(own), step):
            out.append((k, own[e][1], [[r[2]] for r in own[e - length + 1:e + 1]], own[e][3]))
    return out


@pytest.mark.parametrize("length, step, block", [(1, 1, 4), (3, 1, 4), (5, 2, 4), (4, 7, 10), (10, 3, 9), (48, 1, 50)])
def test_batches(spark, table, length, step, block):
    rows = [tuple(r) for r in table.collect()]
    want = plain(rows, length, step)
    path = scratch_path(spark, "batches")
    sequences.write_batches(table, path, ["x"], "y", ["k"], ["i"], length, step, 5, rows_per_block=block)
    got = sorted(tuple(r) for r in sequences.read_batches(spark, path).select(
        "batch", "place", F.struct("k", "i", "sequence", "y")).collect())
    assert [(b, p) for b, p, _ in got] == [divmod(n, 5) for n in range(len(want))]
    assert [tuple(r) for _, _, r in got] == want
    some = sequences.read_batches(spark, path, 1, 2).select("batch", "place", "k", "i").collect()
    assert {tuple(r) for r in some} == {(b, p, r["k"], r["i"]) for b, p, r in got if b in (1, 2)}


def test_same_windows_as_the_window_form(table):
    whole = series.sequence_windows(table, ["x"], "y", 4, ["k"], ["i"])
    blocks = sequences.blocks_of(table, ["x"], "y", ["k"], ["i"], 3, 5, rows_per_chunk=7)
    mine = sequences.windows_of(blocks, ["k"], ["i"], "y", 4).drop("number")
    assert sorted(map(str, mine.select(whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_windows_read_blocks_without_a_shuffle(spark, table):
    path = scratch_path(spark, "batches")
    sequences.write_batches(table, path, ["x"], "y", ["k"], ["i"], 4, 2, 5)
    plan = sequences.read_batches(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Python" not in plan
    one = sequences.read_batches(spark, path, 1, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in one and "GreaterThanOrEqual(stop,5)" in one and "LessThan(start,10)" in one


def test_odd_halos(table):
    with pytest.raises(ValueError):
        sequences.blocks_of(table, ["x"], "y", ["k"], ["i"], 9, 5)
    empty = sequences.blocks_of(table.limit(0), ["x"], "y", ["k"], ["i"], 2, 5)
    assert sequences.windows_of(empty, ["k"], ["i"], "y", 3).count() == 0
