"""The net's fit against the library's objective, gradients, and its walk in batches."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sonde.operators import models, nets


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(1500, 3))
    y = np.where(x[:, 0] > 0.3, 1, np.where(x[:, 1] * x[:, 2] > 0.2, 2, 0))
    made = [(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(made + [(9000, None, 1.0, 1.0, 0), (9001, float("nan"), 1.0, 1.0, 0)],
                                 "id int, a double, b double, c double, y int").repartition(3)


def test_gradient_over_blocks():
    r = np.random.default_rng(1)
    sizes, flat = [3, 4, 3, 2], r.normal(size=4 * 4 + 5 * 3 + 4 * 2)
    data = np.concatenate([r.normal(size=(1300, 3)), r.integers(0, 2, (1300, 1))], 1)
    whole = nets.sums(sizes, flat, [data])
    assert np.allclose(whole, nets.sums(sizes, flat, [data[:7], data[7:7], data[7:900], data[900:]]))
    assert whole[1] == 1300 and nets.sums(sizes, flat, [])[1] == 0
    for i in range(len(flat)):
        near = [nets.sums(sizes, flat + s * 1e-5 * np.eye(len(flat))[i], [data])[0] for s in (1, -1)]
        assert whole[2 + i] == pytest.approx((near[0] - near[1]) / 2e-5, abs=1e-3)


def test_minimum_of_a_valley():
    def valley(x):
        return ((1 - x[0]) ** 2 + 100 * (x[1] - x[0] ** 2) ** 2 + 1, np.array([
            -2 * (1 - x[0]) - 400 * x[0] * (x[1] - x[0] ** 2), 200 * (x[1] - x[0] ** 2)]))
    x, history = nets.minimized(valley, np.array([-1.2, 1.0]), 100, 1e-12)
    assert np.allclose(x, 1, atol=1e-4) and history == sorted(history, reverse=True)
    assert len(nets.minimized(valley, np.array([-1.2, 1.0]), 7, 1e-12)[1]) == 8


def test_fit_starts_where_the_library_does_and_ends_no_worse(rows):
    """Equal objective at the start; the library's model has the fitted weights and their loss."""
    net = models.perceptron(3, 3, (6, 5), 60)
    model, losses = nets.fit(rows, ["a", "b", "c"], net, "y")
    theirs = models.fit_on(rows, ["a", "b", "c"], net, "y").stages[-1].summary().objectiveHistory
    assert losses[0] == pytest.approx(theirs[0], rel=0.02) and losses[-1] < theirs[-1] * 1.1 + 0.01
    assert losses == sorted(losses, reverse=True) and 2 <= len(losses) <= 61
    full = rows.na.drop()
    own = vector_to_array("probability")[F.col("y")]
    assert model.transform(full).agg(F.avg(-F.log(own))).first()[0] == pytest.approx(losses[-1])
    with pytest.raises(Exception):
        model.transform(rows).collect()
    with pytest.raises(Exception, match="classes must be whole"):
        nets.fit(rows.withColumn("y", F.col("y") + 1), ["a", "b", "c"], net, "y")
    with pytest.raises(ValueError, match="nothing to fit on"):
        nets.fit(rows.filter("false"), ["a", "b", "c"], net, "y")


def test_an_evaluation_reads_arrays(spark):
    """Rows go to the workers as one array a batch, not one by one."""
    kept = nets._packed(spark.range(25_000, numPartitions=2).selectExpr("double(id) AS x0", "0.0D AS y"))
    shapes = kept.map(lambda b: b.shape).collect()
    kept.unpersist()
    assert len(shapes) <= 4 and sum(n for n, _ in shapes) == 25_000 and {w for _, w in shapes} == {2}


def test_walk_takes_batches(spark, rows):
    """A batch at a time, in an Arrow column; a row without an input has no shares."""
    model, _ = nets.fit(rows, ["a", "b", "c"], models.perceptron(3, 3, (6, 5), 3), "y")
    odd = spark.createDataFrame([(0.1, 0.2, 0.3), (None, 0.2, 0.3), (1e9, -1e9, 0.0)],
                                "a double, b double, c double")
    walked = odd.select(models.walk_net(["a", "b", "c"], models.net_weights(model)).alias("w"))
    assert "ArrowEvalPython" in walked._jdf.queryExecution().executedPlan().toString()
    got = [r["w"] for r in walked.collect()]
    assert got[1] == [None] * 3 and all(sum(got[i]) == pytest.approx(1) for i in (0, 2))
    assert odd.filter("false").select(models.walk_net(
        ["a", "b", "c"], models.net_weights(model)).alias("w")).collect() == []


def test_rows_are_kept_in_single_precision_where_it_holds_them(spark):
    """Sums of layers stay close to those of doubles, and are added up in doubles."""
    r = np.random.default_rng(2)
    sizes, flat = [3, 20, 4], r.normal(size=4 * 20 + 21 * 4)
    data = np.concatenate([r.normal(size=(5000, 3)), r.integers(0, 4, (5000, 1))], 1)
    df = spark.createDataFrame([tuple(map(float, row)) for row in data], "x0 double, x1 double, x2 double, y double")
    kept = nets._packed(df)
    blocks = kept.collect()
    kept.unpersist()
    assert {b.dtype for b in blocks} == {np.dtype(np.float32)}
    one, two = nets.sums(sizes, flat, blocks), nets.sums(sizes, flat, [data])
    assert one.dtype == np.float64 and one[1] == 5000 and one[0] == pytest.approx(two[0], rel=1e-6)
    assert np.linalg.norm(one - two) < 1e-5 * np.linalg.norm(two)
    wide = nets._packed(df.withColumn("x0", F.lit(1e300)))
    assert {b.dtype for b in wide.collect()} == {np.dtype(np.float64)}
    wide.unpersist()
