"""Splits, encoding, evaluation, models and oversampling."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonde.cluster import scratch_path
from sonde.operators import balance, evaluate, features, models, split
from sonde.plans import stacking

# A published confusion table (class, guess, rows) whose accuracy is 0.868728.
CONFUSION = [
    (0, 0, 3219562), (0, 1, 201497), (0, 2, 36838), (0, 3, 267800), (0, 4, 20251), (0, 5, 2163),
    (0, 6, 7560), (0, 7, 9888), (1, 0, 69234), (1, 1, 1212015), (2, 0, 1631), (2, 2, 526100),
    (3, 0, 82081), (3, 3, 410849), (3, 4, 497), (4, 0, 23527), (4, 3, 1770), (4, 4, 100222),
    (5, 0, 21074), (5, 5, 22116), (6, 0, 71059), (6, 4, 5373), (6, 6, 14358), (7, 0, 1624),
    (7, 7, 21688), (8, 0, 3955), (8, 1, 5868), (9, 0, 1471)]


def test_metrics_of_a_known_confusion_table(spark):
    df = spark.createDataFrame(CONFUSION, "y int, yhat int, n bigint")
    row = evaluate.metrics_of(evaluate.class_scores(df, "y", "yhat")).first()
    assert round(row["accuracy"], 6) == 0.868728
    assert round(row["weighted_precision"], 6) == 0.875215
    assert round(row["weighted_f1"], 6) == 0.866658


def test_split_sizes(spark):
    rows = [(label, i) for label, n in enumerate([1, 2, 4, 5, 10]) for i in range(n)]
    df = spark.createDataFrame(rows, "label int, instance int")
    done = split.group_split(df, "instance", ["label"]).filter("split = 'train'")
    got = {r["label"]: r["count"] for r in done.groupBy("label").count().collect()}
    assert got == {1: 1, 2: 3, 3: 4, 4: 8}


def test_rank_by_hash_matches_a_plain_window(tables):
    df = tables.obs().select("event_id", "label")
    for digits in (1, 4):
        got = split.hash_rank(df, ["label"], ["event_id"], digits=digits).select(
            "event_id", "_rank", "_size")
        want = df.selectExpr(
            "event_id", "row_number() OVER (PARTITION BY label ORDER BY "
            "md5(concat(event_id, '|42'))) AS _rank", "count(*) OVER (PARTITION BY label) AS _size")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_splits_are_disjoint_complete_and_repeatable(tables):
    df = tables.obs()
    train, test = split.stratified_group_split(df, "instance", "label")
    a = {r[0] for r in train.select("instance").distinct().collect()}
    b = {r[0] for r in test.select("instance").distinct().collect()}
    assert not a & b and train.count() + test.count() == df.count()
    again, _ = split.stratified_group_split(df.repartition(7), "instance", "label")
    assert a == {r[0] for r in again.select("instance").distinct().collect()}


def test_stratified_sample_edges(tables):
    df = tables.obs().select("event_id", "label")
    assert split.stratified_sample(df, ["label"], ["event_id"], 1.0).count() == df.count()
    assert split.stratified_sample(df, ["label"], ["event_id"], 0.0).count() == 0
    for digits in (1, 2):
        got = split.stratified_sample(df, ["label"], ["event_id"], 0.3, digits=digits)
        want = split.stratified_sample(df, ["label"], ["event_id"], 0.3)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_scaler_of_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    out = features.fit_scaler(df, ["a", "b"]).transform(df).collect()
    assert sorted(r["a"] for r in out) == pytest.approx([-0.7071068, 0.7071068])
    assert {r["b"] for r in out} == {0.0}


def test_scaler_equals_the_library_one(tables):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = tables.obs().select("event_id", "p_main", "p_aux").na.drop()
    mine = features.fit_scaler(df, ["p_main", "p_aux"]).transform(df)
    vec = VectorAssembler(inputCols=["p_main", "p_aux"], outputCol="v").transform(df)
    theirs = StandardScaler(inputCol="v", outputCol="s", withMean=True).fit(vec).transform(vec)
    both = mine.join(theirs.select("event_id", vector_to_array("s").alias("s")), "event_id")
    assert both.filter("abs(p_main - s[0]) > 1e-9 OR abs(p_aux - s[1]) > 1e-9").count() == 0


def test_auc_with_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "y int, s double")
    assert evaluate.auc_roc(df, "y", "s").first()[0] == pytest.approx(0.625)
    assert evaluate.auc_roc(df, "y", "s", 1).first()[0] == pytest.approx(0.625)
    assert evaluate.auc_roc(df.filter("y = 1"), "y", "s").first()[0] is None
    assert evaluate.auc_pr(df.filter("y = 0"), "y", "s").first()[0] is None


def test_auc_equals_the_library_one(tables):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = tables.preds()
    for metric, mine in (("areaUnderROC", evaluate.auc_roc), ("areaUnderPR", evaluate.auc_pr)):
        library = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="y01", metricName=metric, numBins=0).evaluate(
            df.withColumn("y01", F.col("y01").cast("double")))
        assert mine(df, "y01", "score", 50).first()[0] == pytest.approx(library, abs=1e-9)


def brute_force(points, k):
    x = np.array(points)
    out = {}
    for i, p in enumerate(x):
        d = np.sqrt(((x - p) ** 2).sum(axis=1))
        out[tuple(p)] = sorted(d[np.arange(len(x)) != i])[:k]
    return out


@pytest.mark.parametrize("d, size", [(1, None), (2, None), (3, None), (3, 20)])
def test_nearest_points_are_exact(spark, d, size):
    rng = np.random.default_rng(d)
    cloud = np.vstack([rng.normal(size=(80, d)), rng.normal(50, 0.01, size=(60, d)),
                       rng.uniform(-500, 500, size=(15, d))]).tolist()
    df = spark.createDataFrame([(p, 1) for p in cloud], "x array<double>, m bigint")
    got = balance.nearest_points(df, d, 5, size).collect()
    want = brute_force(cloud, 5)
    assert len(got) == len(cloud)
    for r in got:
        assert [n["dist"] for n in r["near"]] == pytest.approx(want[tuple(r["x"])])


def test_oversampling(spark):
    rng = np.random.default_rng(5)
    rare = rng.normal(size=(12, 2)).tolist() + [[7.0, 7.0]] * 9  # copies among the rare rows
    rows = [(0, *p) for p in rng.normal(size=(200, 2)).tolist()] + [(1, *p) for p in rare]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "id int, y int, a double, b double")
    out = balance.smote_minority(df, "y", ["a", "b"], ["id"]).collect()
    assert Counter(r["y"] for r in out) == {0: 200, 1: 200}
    made = np.array([(r["a"], r["b"]) for r in out if r["synthetic"]])
    lo, hi = np.min(rare, axis=0), np.max(rare, axis=0)
    assert len(made) == 179 and (made >= lo - 1e-9).all() and (made <= hi + 1e-9).all()
    # Copies have five copies as neighbours, so they only give more of themselves.
    assert sum(1 for p in made if tuple(p) == (7.0, 7.0)) >= 9 * (179 // 21)


def test_oversampling_of_balanced_classes_adds_nothing(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 1, 2.0)], "id int, y int, a double")
    assert balance.smote_minority(df, "y", ["a"], ["id"]).count() == 2


@pytest.fixture(scope="module")
def stacked(tables):
    df = tables.obs()
    return df, stacking.fit_stacked(
        df, ["p_main", "p_aux"], ["valve_a"], [1, 3, 5], models.gbt(1, 2), models.forest(3, 3))


def test_stacked_scores_every_row_once(stacked):
    df, model = stacked
    out = model.transform(df)
    assert out.count() == df.count()
    assert out.columns[:len(df.columns)] == df.columns
    probs = [f"probability_label_{k}" for k in (1, 3, 5)]
    assert all(out.filter(f"{p} IS NULL OR {p} < 0 OR {p} > 1").count() == 0 for p in probs)
    assert out.filter("predicted_class IS NULL").count() == 0
    same = out.select("event_id", "p_main").exceptAll(df.select("event_id", "p_main"))
    assert same.count() == 0


def test_stacked_takes_nan_as_missing(stacked):
    df, model = stacked
    empty = df.limit(20).withColumn("p_main", F.lit(None).cast("double"))
    nan = empty.withColumn("p_main", F.lit(float("nan")))
    cols = ["event_id", "prediction", "probability", "probability_label_3"]
    assert model.transform(nan).select(cols).exceptAll(
        model.transform(empty).select(cols)).count() == 0


def test_stacked_plan_is_one_scan_without_python(stacked):
    df, model = stacked
    plan = model.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Join" not in plan and "Exchange" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_stacked_save_and_load(spark, stacked):
    df, model = stacked
    path = scratch_path(spark, "stacked")
    model.save(spark, path)
    again = stacking.StackedModel.load(spark, path, ["p_main", "p_aux", "valve_a"])
    cols = ["event_id", "prediction", "probability", "probability_label_3"]
    assert model.transform(df).select(cols).exceptAll(again.transform(df).select(cols)).count() == 0
    with pytest.raises(ValueError, match="expects"):
        stacking.StackedModel.load(spark, path, ["p_aux", "p_main", "valve_a"])


def test_model_load_checks_inputs(spark, tables):
    df = tables.obs().select("p_main", F.lit(1).alias("y")).na.drop()
    path = scratch_path(spark, "m")
    models.save_model(models.fit_on(df, ["p_main"], models.forest(1, 1), "y"), path)
    with pytest.raises(ValueError):
        models.load_model(path, ["other"])


def test_labels_without_rows_are_skipped(tables):
    train = tables.obs().na.fill(0.0, ["p_main"]).withColumn("target", F.col("event_id") % 2)
    fitted = models.fit_per_label(train, ["p_main"], [1, 77], models.gbt(1, 1))
    assert list(fitted) == [1]
    assert not models.enough_rows(train.filter("label = 77"), train)
    only = train.filter("label = 3")
    both = models.fit_per_label(train, ["p_main"], [1, 3], models.gbt(1, 1), test=only)
    assert list(both) == [3]


def test_pandas_free_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r["y"]: r["weight"] for r in features.class_weights(df, "y").collect()}
    assert got == pytest.approx({0: 4 / 6, 1: 2.0})
