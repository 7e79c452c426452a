"""Boosted trees, forests and nets as rows: against fits and walks done one row at a time."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sonde.catalog import learning
from sonde.operators import boosting, models


def plain_fit(x, y, m, cuts, settings, classes):
    """Margins [row, class] after the fit, by loops over rows, nodes and cuts."""
    margins = np.zeros((len(x), classes))
    unit, shrink = boosting.UNIT, settings.shrink * boosting.UNIT
    bins = np.array([[sum(c < v for c in cuts[f]) for f, v in enumerate(row)] for row in x])
    losses = []
    for _ in range(settings.rounds):
        if settings.loss == "softmax":
            p = np.exp(margins) / np.exp(margins).sum(1, keepdims=True)
            hit = np.eye(classes)[y]
            losses.append(-np.log(p[np.arange(len(y)), y]).mean())
        else:
            p = 1 / (1 + np.exp(-margins))
            hit = y[:, None] > 0 if settings.loss == "binary" else np.eye(classes)[y]
        g = np.floor((p - hit) * unit + 0.5)
        h = np.floor(p * (1 - p) * unit + 0.5)
        for model in np.unique(m):
            for c in range(classes):
                stack = [(np.flatnonzero(m == model), 0)]
                while stack:
                    rows, depth = stack.pop()
                    best = (1.0, None)
                    a, b = g[rows, c].sum(), h[rows, c].sum()
                    for f in range(x.shape[1]) if depth < settings.depth else ():
                        for cut in range(settings.bins):
                            left = rows[bins[rows, f] <= cut]
                            if not settings.least <= len(left) <= len(rows) - settings.least:
                                continue
                            s, t = g[left, c].sum(), h[left, c].sum()
                            gain = (s * s / (t + shrink) + (a - s) * (a - s) / (b - t + shrink)
                                    - a * a / (b + shrink))
                            if gain > best[0]:
                                best = (gain, (f, cut))
                    if best[1] is None:
                        margins[rows, c] += -settings.step * a / (b + shrink)
                    else:
                        right = bins[rows, best[1][0]] > best[1][1]
                        stack += [(rows[~right], depth + 1), (rows[right], depth + 1)]
    return margins, losses


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(240, 3)), 2)
    y = (x[:, 0] > 0.3).astype(int) + (x[:, 1] * x[:, 2] > 0)
    m = rng.integers(0, 3, 240)
    rows = [(i, *map(float, r), int(a), int(b)) for i, (r, a, b) in enumerate(zip(x, y, m))]
    return x, y, m, spark.createDataFrame(rows, "id int, a double, b double, c double, y int, m int")


def test_cuts_are_quantiles(spark):
    df = spark.createDataFrame([(float(i // 2), 1.0) for i in range(100)], "a double, b double")
    cuts = boosting.quantile_cuts(df, ["a", "b"], 5)
    assert cuts == [[9.0, 19.0, 29.0, 39.0], [1.0]]
    assert boosting.quantile_cuts(df.limit(0), ["a"], 5) == [[]]


@pytest.mark.parametrize("loss, cells", [("binary", 4_000_000), ("softmax", 4_000_000), ("ovr", 50)])
def test_fit_equals_plain_loops(points, monkeypatch, loss, cells):
    """Also with histograms in parts and margins written between rounds."""
    x, y, m, df = points
    monkeypatch.setattr(boosting, "CELLS", cells)
    monkeypatch.setattr(boosting, "STORE", 2)
    s = boosting.Settings(rounds=5, depth=3, bins=8, least=3, loss=loss)
    if loss == "binary":
        fitted = boosting.fit(df.withColumn("t", (F.col("y") > 0).cast("int")), ["a", "b", "c"], "t", s, "m")
        want, _ = plain_fit(x, y, m, boosting.quantile_cuts(df, ["a", "b", "c"], 8), s, 1)
        got = df.select("id", *[fitted.margin(k).alias(k) for k in fitted.models]).orderBy("id").collect()
        assert np.allclose([r[str(k)] for r, k in zip(got, m)], want[:, 0], atol=1e-9)
    else:
        fitted = boosting.fit(df, ["a", "b", "c"], "y", s)
        want, losses = plain_fit(x, y, m * 0, boosting.quantile_cuts(df, ["a", "b", "c"], 8), s, 3)
        got = df.select("id", F.array(*[fitted.margin("all", c) for c in fitted.classes]).alias("s"),
                        fitted.probabilities("all").alias("p")).orderBy("id").collect()
        assert np.allclose([r["s"] for r in got], want, atol=1e-9)
        e = np.exp(want)
        share = e / e.sum(1, keepdims=True) if loss == "softmax" else e / (1 + e)
        assert np.allclose([r["p"] for r in got], share, atol=1e-9)
        if loss == "softmax":
            assert [v["all"] for v in fitted.losses][:-1] == pytest.approx(losses)
    loss_of = [sum(v.values()) for v in fitted.losses]
    assert len(loss_of) == 6 and all(a > b for a, b in zip(loss_of, loss_of[1:]))


def test_nodes_are_the_model(spark, points):
    _, _, _, df = points
    df = df.withColumn("t", (F.col("y") > 0).cast("int"))
    s = boosting.Settings(rounds=4, depth=3)
    fitted = boosting.fit(df, ["a", "b", "c"], "t", s, "m")
    again = boosting.BoostedTrees.from_nodes(fitted.nodes(spark), ["a", "b", "c"], fitted.models, ["1"], s)
    assert list(again.rows()) == list(fitted.rows())
    library = models.boosted_models(fitted)
    scored = models.score_per_label(df, library)
    for k in fitted.models:
        both = scored.select((F.col(f"probability_label_{k}") - fitted.probability(k)).alias("d"))
        assert both.filter("abs(d) > 1e-12").count() == 0
    shares = {}
    for model, _, share in fitted.importances():
        shares[model] = shares.get(model, 0) + share
    assert all(v == pytest.approx(1.0) for v in shares.values()) and len(shares) == 3


def test_trees_do_not_depend_on_row_order(points):
    _, _, _, df = points
    s = boosting.Settings(rounds=3, depth=3, loss="softmax")
    a = boosting.fit(df, ["a", "b"], "y", s)
    b = boosting.fit(df.orderBy(F.desc("c")).repartition(5), ["a", "b"], "y", s)
    assert list(a.rows()) == list(b.rows())


def test_odd_rows_and_targets(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1, 1), (None, 1, 1), (nan, 0, 1), (2.0, None, 1), (2.0, 0, None),
                                (3.0, 0, 2), (-0.0, 0, 1), (0.0, 1, 1)], "a double, y int, m int")
    fitted = boosting.fit(df, ["a"], "y", boosting.Settings(rounds=2, depth=2), "m", models=[1, 2, 9])
    assert fitted.models == ("1", "2")
    # One class alone gives leaves only, pulled towards it.
    assert all(r[4] is None for r in fitted.rows() if r[0] == "2")
    assert df.select(fitted.probability("2")).first()[0] < 0.5
    with pytest.raises(ValueError):
        boosting.fit(df.limit(0), ["a"], "y", boosting.Settings(), "m")


def shuffled(df, column):
    """The rows with the values of one column dealt anew."""
    rows = df.collect()
    values = [r[column] for r in rows]
    values = values[1:] + values[:1]
    out = [{**r.asDict(), column: v} for r, v in zip(rows, values)]
    return df.sparkSession.createDataFrame(out, df.schema)


def test_walks_agree_and_notice_shuffled_predictions(spark, points):
    _, _, _, df = points
    rows = df.withColumns({"event_id": F.col("id"), "final_class": F.col("y")})
    forest = models.fit_on(rows, ["a", "b", "c"], models.forest(7, 4), "y")
    net = models.fit_on(rows, ["a", "b", "c"], models.perceptron(3, 3, (5, 4), 30), "y")
    for model in (forest, net):
        scored = model.transform(rows)
        if model is forest:
            wide = scored.select("event_id", *[vector_to_array("features")[i].alias(f"f{i}") for i in range(3)])
            walked = models.walk_forest(wide, models.forest_nodes(model), ["f0", "f1", "f2"], ["event_id"], 4)
        else:
            walked = scored.select("event_id", models.walk_net(
                ["a", "b", "c"], models.net_weights(model)).alias("walked"))
        good = learning._agreed(scored, walked).collect()
        assert sum(r["n"] for r in good) == 240 and all(r["n"] == r["n_same"] for r in good)
        wrong = learning._agreed(shuffled(scored, "probability"), walked).collect()
        assert sum(r["n_same"] for r in wrong) < 120


def test_walk_of_a_forest_copies_no_row_per_tree(spark, points):
    """Rows without a key, with equal keys, and without a value; no join and no copy per tree."""
    _, _, _, df = points
    model = models.fit_on(df, ["a", "b", "c"], models.forest(5, 4), "y")
    odd = spark.createDataFrame([(1, 0.5, None, 1.0), (1, 0.5, None, 1.0), (None, 0.1, 0.2, 0.3),
                                 (2, -3.0, 0.0, float("nan"))], "id int, a double, b double, c double")
    walked = models.walk_forest(odd, models.forest_nodes(model), ["a", "b", "c"], ["id"], 4)
    plan = walked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    got = {r["id"]: r["walked"] for r in walked.collect()}
    table, want = models.forest_nodes(model).collect(), {}
    at = {(r["tree"], r["node"]): r for r in table}
    for key, *x in odd.collect():
        ends = []
        for tree in range(5):
            r = at[tree, 0]
            while r["shares"] is None:
                v = x[r["feature"]]
                r = at[tree, r["left"] if v is not None and v <= r["cut"] else r["right"]]
            ends.append(r["shares"])
        want[key] = np.mean(ends, 0)
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


def test_gradients_are_made_once_a_round_in_bounded_blocks(spark):
    """Sums over several blocks of one task, against sums over all rows."""
    rows = spark.range(140_000, numPartitions=1).selectExpr(
        "0 AS m", "int(id % 3 = 0) AS y", "tinyint(id % 5) AS b0", "tinyint(id % 7) AS b1")
    packed = boosting._packed(rows, 2, 1)
    sizes = [r[0] for r in packed.selectExpr("length(m) DIV 4").collect()]
    assert sum(sizes) == 140_000 and max(sizes) <= boosting.BLOCK < 140_000
    settings = boosting.Settings(depth=1, bins=8)
    none = boosting._Round.of(np.full((1, 3), -1), np.zeros((1, 3), int), np.zeros((1, 3)), 1)
    made = boosting._advanced(packed, None, 1, 1, 2, settings)
    sums, lost = boosting._histogram(made, none, 1, 2, settings, 0, range(1), True)
    i = np.arange(140_000)
    g = np.where(i % 3 == 0, -0.5, 0.5) * boosting.UNIT
    for f, bins in enumerate((i % 5, i % 7)):
        assert (sums[0, f, :, 0] == np.bincount(bins, g, 8)).all()
        assert (sums[0, f, :, 1] == np.bincount(bins, minlength=8) * (boosting.UNIT / 4)).all()
        assert (sums[0, f, :, 2] == np.bincount(bins, minlength=8)).all()
    assert lost[0] == pytest.approx(140_000 * np.log(2))


@pytest.mark.parametrize("classes", [None, [0, 1, 2, 3]])
def test_a_class_alone_gives_the_same_trees(points, monkeypatch, classes):
    """One task a class against a job a level; also for a class without rows."""
    _, _, _, df = points
    s = boosting.Settings(rounds=4, depth=3, bins=8, least=2, loss="ovr")
    alone = boosting.fit(df.repartition(3), ["a", "b", "c"], "y", s, classes=classes)
    monkeypatch.setattr(boosting, "ALONE", 0)
    together = boosting.fit(df, ["a", "b", "c"], "y", s, classes=classes)
    assert list(alone.rows()) == list(together.rows())
    assert [v["all"] for v in alone.losses] == pytest.approx([v["all"] for v in together.losses])


def test_one_vs_rest_is_boosted_together_and_scored_by_the_library(points, monkeypatch):
    x, y, _, df = points
    calls, fit = [], boosting.fit
    monkeypatch.setattr(boosting, "fit", lambda *a, **k: calls.append(fit(*a, **k)) or calls[-1])
    estimator = models.boosted_one_vs_rest(6, 3)
    model = models.fit_on(df.withColumn("a", F.when(F.col("id") > 0, F.col("a"))), ["a", "b", "c"],
                          estimator, "y")
    trees = calls[0]
    assert len(calls) == 1 and trees.settings == boosting.Settings(6, 3, 0.1, 32, loss="ovr")
    out = model.transform(df).select("y", "prediction", vector_to_array("rawPrediction").alias("raw"),
                                     trees.probabilities("all").alias("p")).collect()
    assert all(r["prediction"] == np.argmax(r["p"]) for r in out)
    assert np.allclose([[1 / (1 + np.exp(-2 * v)) for v in r["raw"]] for r in out], [r["p"] for r in out])
    assert np.mean([r["prediction"] == r["y"] for r in out]) > 0.85
    assert not models.boosts_one_vs_rest(models.forest())
