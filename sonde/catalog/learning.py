"""Model training and scoring.

Boosted trees are fitted a second time by their SQL twins, which gives every node of the trees and
every probability again.  Gaussian Bayes is compared row by row with its closed form, and the
logistic fit by its vanishing gradient.  Forests and nets of ``pyspark.ml`` draw random numbers that
SQL cannot repeat: their queries walk the stored nodes (or layers) in batches of rows, and count the
rows on which model and walk agree.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer as MlImputer
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sonde.catalog.base import EVENT_CLASS_LIST, MULTI_SQL, Tables, query
from sonde.catalog.splitting import _BITS, _SPLIT
from sonde.cluster import scratch_path, spread, staged
from sonde.functions import binary_target, multiclass_target, normal_flag
from sonde.operators import (
    balance, boosting, evaluate, features, impute, models, nets, series, split, tables)
from sonde.plans import stacking
from sonde.reference import EVENT_LABELS

CONTINUOUS, CATEGORICAL = ["p_main", "p_aux", "p_sparse"], ["valve_a"]
SENSORS = [*CONTINUOUS, *CATEGORICAL]
INPUTS = SENSORS + [f"{s}_missing" for s in SENSORS]

# Observations with their split and both targets, for the SQL twins.
_ROWS = (f"s AS ({_SPLIT}), d AS (SELECT o.*, split, {MULTI_SQL} AS final_class, "
         f"CASE WHEN class IN {EVENT_CLASS_LIST} THEN 1 ELSE 0 END AS target "
         "FROM obs o JOIN s USING (label, instance))")
_LEARNED = ("k AS (SELECT label, count(DISTINCT target) AS kinds FROM d WHERE split = 'train' "
            f"AND label IN {tuple(EVENT_LABELS)} GROUP BY label)")


_FILLED = ", ".join(
    [f"coalesce({c}, (SELECT avg({c}) FROM d WHERE split = 'train')) AS {c}" for c in CONTINUOUS]
    + [f"coalesce({c}, (SELECT {c} FROM d WHERE split = 'train' AND {c} IS NOT NULL "
       f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in CATEGORICAL]
    + [f"CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_missing"
       for c in SENSORS])
_SCALES = (
    [f"({c} - (SELECT avg({c}) FROM filled WHERE split = 'train')) / "
     f"(SELECT stddev_samp({c}) FROM filled WHERE split = 'train')" for c in SENSORS]
    + [f"{c}_missing" for c in SENSORS])
_SCALED = ", ".join(_SCALES)
_NAMED = ", ".join(f"{x} AS {c}" for x, c in zip(_SCALES, INPUTS))
_READY = (f"filled AS (SELECT event_id, label, split, final_class, target, {_FILLED} FROM d), "
          f"ready AS (SELECT event_id, label, split, final_class, target, {_NAMED} FROM filled)")
_FEATURES = ", ".join(INPUTS)

# Layer 1 as SQL: every row in the model of its own label.
LAYER_1 = boosting.Settings()
_OWN = (f"SELECT event_id AS rid, split = 'train' AS train, label::VARCHAR AS m, '1' AS c, "
        f"target AS hit, {_FEATURES} FROM ready WHERE label IN {tuple(EVENT_LABELS)}")
_EACH = (f"SELECT event_id AS rid, true AS train, label::VARCHAR AS m, '1' AS c, target AS hit, "
         f"{_FEATURES} FROM ready WHERE split = 'train' AND label IN {tuple(EVENT_LABELS)} "
         f"UNION ALL SELECT event_id, false, k::VARCHAR, '1', 0, {_FEATURES} FROM ready, "
         "(SELECT DISTINCT label AS k FROM ready WHERE split = 'train' AND label IN "
         f"{tuple(EVENT_LABELS)}) WHERE split = 'test'")
MILLIONTHS = "CAST(floor({} * 1e6 + 0.5) AS BIGINT)"
_LOGISTIC = MILLIONTHS.format("1 / (1 + exp(-s))")


def _millionths(value):
    return F.floor(value * F.lit(1e6) + F.lit(0.5)).cast("bigint")




def _split(t: Tables):
    """Observations with flags, fitted fills and both targets, split by series."""
    # Four fits and the models read it: written once.
    df = spread(staged(split.attach_split(
        t.obs(), split.group_split(t.obs(), "instance", ["label"]), ["label", "instance"])))
    flagged = tables.missing_flags(df, SENSORS)
    train = flagged.filter("split = 'train'")
    fill = impute.Imputer({**impute.fit_continuous(train, CONTINUOUS).values,
                           **impute.fit_categorical(train, CATEGORICAL).values})
    ready = features.fit_scaler(fill.transform(train), SENSORS).transform(fill.transform(flagged))
    ready = ready.withColumns({"target": binary_target(F.col("class")),
                               "final_class": multiclass_target(F.col("class"))})
    coded = features.frequency_index(ready.filter("split = 'train'"), "final_class", "y")
    ready = coded.transform(ready)
    return ready.filter("split = 'train'"), ready.filter("split = 'test'"), coded


def _learned(fitted, truth: str, guess: str, balanced: bool = False) -> bool:
    """Whether training rows are told apart at least as well as by one constant guess.

    The measure is accuracy, or mean recall for fits on balanced weights.
    """
    per = fitted.groupBy(truth).agg(
        F.count("*").alias("n"), F.count(F.when(F.col(truth) == F.col(guess), 1)).alias("hits"))
    row = per.agg(F.sum("hits").alias("hits"), F.max("n").alias("most"), F.count("*").alias("k"),
                  F.sum(F.col("hits") / F.col("n")).alias("recalls")).first()
    return row["recalls"] >= 1 if balanced else row["hits"] >= row["most"]


def _agreed(scored, walked, klass: str = "final_class"):
    """Per true class: rows, and those on which the model's shares are the walk's.

    ``scored`` has event_id, the class, probability and prediction; ``walked`` event_id and walked.
    """
    both = scored.select("event_id", F.col(klass), "prediction",
                         vector_to_array("probability").alias("p")).join(walked, "event_id", "left")
    w = F.col("walked")
    near = F.forall(F.zip_with("p", w, lambda a, b: F.abs(a - b) < 1e-9), lambda good: good)
    same = (F.size("p") == F.size(w)) & near & (
        F.get(w, F.col("prediction").cast("int")) >= F.array_max(w) - 1e-9)
    return both.groupBy(klass).agg(F.count("*").alias("n"), F.count(F.when(
        F.coalesce(same, F.lit(False)), 1)).alias("n_same"))


def _forest_checked(model, test, klass: str = "final_class"):
    forest = model.stages[-1]
    # Walk and comparison read the scores: every tree predicts a row once.
    scored = staged(model.transform(test).select(
        "event_id", klass, "features", "prediction", "probability"), "scored")
    vector = vector_to_array("features")
    names = [f"_f{i}" for i in range(forest.numFeatures)]
    wide = scored.select("event_id", *[vector[i].alias(c) for i, c in enumerate(names)])
    walked = models.walk_forest(wide, models.forest_nodes(model), names, ["event_id"],
                                forest.getMaxDepth())
    return _agreed(scored, walked, klass)


_AGREED = f"""
WITH {_ROWS} SELECT final_class, count(*) AS n, count(*) AS n_same FROM d
WHERE split = 'test' GROUP BY final_class"""

# Constants of a fit that only its own checks can see.
_CHECKED = f"""
WITH {_ROWS} SELECT final_class, count(*) AS n, count(*) AS n_known, count(*) AS n_sound,
  true AS learned FROM d WHERE split = 'test' GROUP BY final_class"""


def _checked(model, train, test, truth: str, width: int):
    """Per true class of the test rows: support, known guesses, and the train fit."""
    fit = _learned(model.transform(train), truth, "prediction")
    return model.transform(test).groupBy("final_class").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("prediction").between(0, width - 1), 1)).alias("n_known"),
        F.count("*").alias("n_sound")).withColumn("learned", F.lit(fit))


def _layer_1_fit(train):
    return boosting.fit(train, INPUTS, "target", LAYER_1, key="label", models=EVENT_LABELS)


@query("gbt_per_label", f"""
WITH {_ROWS}, {_READY}, {boosting.fit_sql(_OWN, INPUTS, LAYER_1)}
SELECT rid AS event_id, m::INT AS label, hit AS target, {_LOGISTIC} AS p FROM fitted
WHERE NOT train""")
def _per_label(t: Tables):
    """Probability of the event, by the model of the row's own label, of every test row."""
    train, test, _ = _split(t)
    fitted = models.fit_per_label(train, INPUTS, EVENT_LABELS)
    own = F.coalesce(*[F.when(F.col("label") == k, F.col(f"{stacking.PREFIX}{k}"))
                       for k in sorted(fitted)])
    scored = models.score_per_label(test.filter(F.col("label").isin(list(fitted))), fitted)
    return scored.select("event_id", "label", "target", _millionths(own).alias("p"))


@query("score_layer1", f"""
WITH {_ROWS}, {_READY}, {boosting.fit_sql(_EACH, INPUTS, LAYER_1)}
SELECT rid AS event_id, p_main, m AS model, {_LOGISTIC} AS p
FROM fitted JOIN obs ON event_id = rid WHERE NOT train""")
def _layer_1(t: Tables):
    """Every test row, scored by the models of all labels, beside its raw value."""
    train, test, _ = _split(t)
    fitted = models.fit_per_label(train, INPUTS, EVENT_LABELS)
    scored = models.score_per_label(test.select("event_id", *INPUTS), fitted)
    wide = scored.select("event_id", *[
        _millionths(F.col(f"{stacking.PREFIX}{k}")).alias(str(k)) for k in sorted(fitted)])
    raw = t.obs().select("event_id", "p_main")
    return wide.unpivot(["event_id"], [str(k) for k in sorted(fitted)], "model", "p").join(
        raw, "event_id")


@query("boosted_nodes", f"""
WITH {_ROWS}, {_READY}, {boosting.fit_sql(_OWN, INPUTS, LAYER_1, steps=True)},
cutting AS (SELECT DISTINCT m, (t - 1) // {LAYER_1.depth} AS tree, was, f, b, gain FROM fitted
  WHERE t > 0 AND f >= 0),
ending AS (SELECT DISTINCT m, (t - 1) // {LAYER_1.depth} AS tree, ended, v FROM fitted
  WHERE t > 0 AND t % {LAYER_1.depth} = 0)
SELECT m AS model, CAST(tree AS INT) AS tree, CAST(was AS INT) AS node, {INPUTS}[f + 1] AS feature,
  CAST(floor(every.cuts[f + 1][b + 1] * 1e6 + 0.5) AS BIGINT) AS cut,
  CAST(2 * was + 1 AS INT) AS "left", CAST(2 * was + 2 AS INT) AS "right", NULL AS value
FROM cutting, every
UNION ALL SELECT m, CAST(tree AS INT), CAST(ended AS INT), NULL, NULL, NULL, NULL,
  CAST(floor(v * 1e9 + 0.5) AS BIGINT) FROM ending""")
def _boosted_nodes(t: Tables):
    """All nodes of the layer-1 trees, from the table the fit has written."""
    train, _, _ = _split(t)
    nodes = staged(_layer_1_fit(train).nodes(t.spark), "nodes")
    return nodes.select("model", "tree", "node", "feature", _millionths(F.col("cut")).alias("cut"),
                        "left", "right", F.floor(F.col("value") * F.lit(1e9) + F.lit(0.5))
                        .cast("bigint").alias("value"))


@query("feature_importance", f"""
WITH {_ROWS}, {_READY}, {boosting.fit_sql(_OWN, INPUTS, LAYER_1, steps=True)},
cutting AS (SELECT DISTINCT m, t, was, f, gain FROM fitted WHERE f >= 0),
whole AS (SELECT m, sum(gain) AS total FROM cutting GROUP BY m),
part AS (SELECT m, f, sum(gain) AS own FROM cutting GROUP BY m, f)
SELECT model, {INPUTS}[u.f + 1] AS feature,
  {MILLIONTHS.format("coalesce(own / total, 0)")} AS importance
FROM (SELECT DISTINCT m AS model FROM fitted WHERE train) k, (SELECT unnest(range({len(INPUTS)})) AS f) u
LEFT JOIN part ON part.m = model AND part.f = u.f LEFT JOIN whole ON whole.m = model""")
def _importance(t: Tables):
    """Shares of the gain by model and feature."""
    train, _, _ = _split(t)
    each = t.spark.createDataFrame(_layer_1_fit(train).importances(),
                                   "model string, feature string, importance double")
    return each.select("model", "feature", _millionths(F.col("importance")).alias("importance"))


# A joint loss over all classes.
SOFTMAX = boosting.Settings(rounds=10, depth=4, loss="softmax")
_CLASSES = ("SELECT event_id AS rid, split = 'train' AS train, 'all' AS m, k::VARCHAR AS c, "
            f"(final_class = k)::INT AS hit, {_FEATURES} FROM ready, (SELECT DISTINCT final_class "
            "AS k FROM ready WHERE split = 'train')")


@query("softmax_boost", f"""
WITH {_ROWS}, {_READY}, {boosting.fit_sql(_CLASSES, INPUTS, SOFTMAX)},
shares AS (SELECT rid, c, e / sum(e) OVER (PARTITION BY rid) AS p FROM
  (SELECT rid, c, exp(s - max(s) OVER (PARTITION BY rid)) AS e FROM fitted WHERE NOT train))
SELECT rid AS event_id, c AS predicted, {MILLIONTHS.format("p")} AS p FROM shares
QUALIFY row_number() OVER (PARTITION BY rid ORDER BY p DESC, c::INT) = 1""")
def _softmax(t: Tables):
    """The likeliest class of every test row and its probability."""
    train, test, _ = _split(t)
    fitted = boosting.fit(train, INPUTS, "final_class", SOFTMAX)
    names = F.array(*[F.lit(c) for c in fitted.classes])
    scored = test.select("event_id", fitted.probabilities("all").alias("all"))
    best = F.array_max("all")
    return scored.select("event_id", F.element_at(names, F.array_position("all", best).cast("int"))
                         .alias("predicted"), _millionths(best).alias("p"))


@query("softmax_loss", f"""
WITH {_ROWS}, {_READY}, {boosting.fit_sql(_CLASSES, INPUTS, SOFTMAX, steps=True)},
shares AS (SELECT t, rid, hit, e / sum(e) OVER (PARTITION BY t, rid) AS p FROM
  (SELECT t, rid, hit, exp(s - max(s) OVER (PARTITION BY t, rid)) AS e FROM fitted
   WHERE train AND t % {SOFTMAX.depth} = 0))
SELECT CAST(t // {SOFTMAX.depth} AS INT) AS round, {MILLIONTHS.format("avg(-ln(p))")} AS log_loss
FROM shares WHERE hit = 1 GROUP BY t""")
def _softmax_loss(t: Tables):
    """Log loss of the training rows after every round."""
    train, _, _ = _split(t)
    fitted = boosting.fit(train, INPUTS, "final_class", SOFTMAX)
    rows = [(i, float(loss["all"])) for i, loss in enumerate(fitted.losses)]
    return t.spark.createDataFrame(rows, "round int, log_loss double").withColumn(
        "log_loss", _millionths(F.col("log_loss")))


@query("rf_multiclass", _AGREED)
def _forest(t: Tables):
    train, test, _ = _split(t)
    return _forest_checked(models.fit_on(train, INPUTS, models.forest(), "y"), test)


@query("mlp_multiclass", _AGREED + " HAVING count(*) > 0")
def _mlp(t: Tables):
    """The net's shares against a forward pass over its weight rows; the loss must have fallen."""
    train, test, coded = _split(t)
    net = models.perceptron(len(INPUTS), len(coded.labels))
    model, losses = nets.fit(train, INPUTS, net, "y")
    if not losses[-1] < losses[0]:
        raise ValueError(f"the loss did not fall: {losses[0]} to {losses[-1]}")
    scored = model.transform(test)
    walked = staged(scored.select("event_id", models.walk_net(
        INPUTS, models.net_weights(model)).alias("walked")), "walked")
    return _agreed(scored, walked)


@query("naive_bayes", f"""
WITH {_ROWS}, filled AS (SELECT event_id, split, final_class, {_FILLED} FROM d),
x AS (SELECT event_id, split, final_class, unnest([{_SCALED}]) AS v,
        unnest(range({len(INPUTS)})) AS f FROM filled),
tot AS (SELECT f, avg(v * v) - avg(v) * avg(v) AS var FROM x WHERE split = 'train' GROUP BY f),
par AS (SELECT final_class AS c, f, avg(v) AS mu, count(*) AS n,
          avg(v * v) - avg(v) * avg(v) + 1e-9 * (SELECT max(var) FROM tot) AS var
        FROM x WHERE split = 'train' GROUP BY final_class, f),
score AS (SELECT event_id, c, ln(any_value(n)) - sum(ln(var) + (v - mu) * (v - mu) / var) / 2 AS g
          FROM x JOIN par USING (f) WHERE split = 'test' GROUP BY event_id, c)
SELECT event_id, arg_max(c, g) AS predicted FROM score GROUP BY event_id""")
def _bayes(t: Tables):
    train, test, coded = _split(t)
    model = models.fit_on(train, INPUTS, models.gaussian_bayes(), "y")
    names = F.array(*[F.lit(int(c)) for c in coded.labels])
    return model.transform(test).select("event_id", F.try_element_at(
        names, F.col("prediction").cast("int") + 1).alias("predicted"))


@query("ovr_gbt", _CHECKED)
def _boosted(t: Tables):
    train, test, coded = _split(t)
    model = models.fit_on(train, INPUTS, models.boosted_one_vs_rest(parallelism=8), "y")
    return _checked(model, train, test, "y", len(coded.labels))


@query("logreg", f"""
WITH {_ROWS} SELECT unnest({INPUTS + ["intercept"]}) AS term, true AS flat,
  (SELECT count(*) FROM d WHERE split = 'train') AS n""")
def _logistic(t: Tables):
    """The gradient of the fitted loss, per term: the mean of weight x (p - target) x input."""
    train, _, _ = _split(t)
    heavy, line = models.weighted(train, "target", models.logistic())
    fitted = models.fit_on(heavy, INPUTS, line, "target").transform(heavy)
    miss = F.col("weight") * (vector_to_array("probability")[1] - F.col("target"))
    terms = {**{c: F.col(c) for c in INPUTS}, "intercept": F.lit(1.0)}
    wide = fitted.agg(F.count("*").alias("n"), *[
        (F.abs(F.avg(miss * x)) < 1e-3).alias(c) for c, x in terms.items()])
    return wide.unpivot(["n"], list(terms), "term", "flat")


@query("rf_weighted", _AGREED)
def _meta_forest(t: Tables):
    """Base-model probabilities as extra inputs of a forest on balanced rows."""
    train, test, coded = _split(t)
    base = models.fit_on(train, INPUTS, models.gaussian_bayes(), "y")

    def with_meta(df):
        out = base.transform(df).withColumn("_p", vector_to_array("probability"))
        k = base.stages[-1].numClasses
        return out.select(*df.columns, *[F.col("_p")[i].alias(f"meta_{i}") for i in range(k)]), k

    (rows, k), (held, _) = with_meta(train), with_meta(test)
    heavy, trees = models.weighted(rows, "y", models.forest())
    model = models.fit_on(heavy, INPUTS + [f"meta_{i}" for i in range(k)], trees, "y")
    return _forest_checked(model, held)


@query("two_level", f"""
WITH {_ROWS} SELECT label, count(*) AS n, count(*) AS n_known, true AS learned FROM d
WHERE split = 'test' GROUP BY label""")
def _two_level(t: Tables):
    """Normal or not first; the event type, by boosted trees, only for rows that look abnormal."""
    train, test, _ = _split(t)
    train = train.withColumn("normal", F.coalesce(normal_flag(F.col("class")), F.lit(0)))
    heavy, line = models.weighted(train, "normal", models.logistic())
    gate = models.fit_on(heavy, INPUTS, line, "normal")
    odd = train.filter("normal = 0")
    coded = features.frequency_index(odd, "label", "kind")
    odd = coded.transform(odd)
    kind = models.fit_on(odd, INPUTS, models.boosted_one_vs_rest(20, 5, parallelism=8), "kind")
    out = gate.transform(test).select(
        "event_id", "label", *INPUTS, F.col("prediction").alias("looks_normal"))
    guess = F.when(F.col("looks_normal") == 1, -1).otherwise(F.col("prediction").cast("int"))
    fit = (_learned(gate.transform(heavy), "normal", "prediction", True)
           and _learned(kind.transform(odd), "kind", "prediction"))
    return kind.transform(out).groupBy("label").agg(
        F.count("*").alias("n"),
        F.count(F.when(guess.between(-1, len(coded.labels) - 1), 1)).alias("n_known")
    ).withColumn("learned", F.lit(fit))


@query("indexed_forest", f"""
SELECT label, count(*) AS n, count(*) AS n_same
FROM obs WHERE {_BITS} >= {int(0.8 * 2 ** 60)} GROUP BY label""")
def _indexed(t: Tables):
    """One chain of stages on the label: indexed wells and lags, fills, scaling, forest."""
    df = series.lag_features(t.obs(), "well", 3, [], ["ts", "event_id"])
    df = spread(staged(split.hash_split(df, ["event_id"])))
    text = ["well", *[f"well_lag{k}" for k in (1, 2, 3)]]
    coded, filled = [f"{c}_index" for c in text], [f"{c}_imputed" for c in SENSORS]
    train = df.filter("split = 'train'")
    ready = Pipeline(stages=[
        StringIndexer(inputCols=text, outputCols=coded, handleInvalid="keep"),
        StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="keep"),
        MlImputer(inputCols=SENSORS, outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=[*coded, *filled], outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features"),
    ]).fit(train)
    trees = models.fit_forest(ready.transform(train), models.forest(), "label_index")
    return _forest_checked(PipelineModel([*ready.stages, trees]), df.filter("split = 'test'"), "label")


@query("ablation", f"""
WITH {_ROWS} SELECT unnest({["nothing", *SENSORS]}) AS left_out,
  (SELECT count(*) FROM d WHERE split = 'test') AS n,
  (SELECT count(*) FROM d WHERE split = 'test') AS n_same""")
def _ablation(t: Tables):
    """Forests without one sensor each, every one against a walk over its own nodes."""
    train, test, _ = _split(t)
    out = None
    for left_out in ["", *SENSORS]:
        kept = [f for f in INPUTS if f not in (left_out, f"{left_out}_missing")]
        model = models.fit_on(train, kept, models.forest(), "y")
        row = _forest_checked(model, test).agg(F.sum("n").alias("n"), F.sum("n_same").alias(
            "n_same")).select(F.lit(left_out or "nothing").alias("left_out"), "n", "n_same")
        out = row if out is None else out.unionByName(row)
    return out


@query("model_roundtrip", """
SELECT count(*) AS n_rows, count(*) AS n_same FROM obs WHERE p_main IS NOT NULL""")
def _roundtrip(t: Tables):
    """A saved and reloaded model gives the same answer for every row."""
    df = t.obs().filter("p_main IS NOT NULL").select(
        "event_id", "p_main", F.coalesce("valve_a", F.lit(0.0)).alias("valve_a"),
        binary_target(F.col("class")).alias("target"))
    path, names = scratch_path(t.spark, "model"), ["p_main", "valve_a"]
    model = models.fit_on(df, names, models.logistic(5), "target", scale=True)
    models.save_model(model, path)
    again = models.load_model(path, names)
    raw = ["raw_features", "features", "rawPrediction", "probability", "prediction"]
    one = model.transform(df).withColumn("a", vector_to_array("probability")[1]).drop(*raw)
    both = again.transform(one).withColumn("b", vector_to_array("probability")[1])
    return both.agg(F.count("*").alias("n_rows"),
                    F.count(F.when(F.col("a") == F.col("b"), 1)).alias("n_same"))


# All rows to score; their numbers must not be those of the training rows.
_ALL = _EACH.replace("WHERE split = 'test'", "WHERE true").replace(
    "SELECT event_id, false", "SELECT -1 - event_id, false")


@query("score_stacked", f"""
WITH {_ROWS}, {_READY}, {boosting.fit_sql(_ALL, INPUTS, LAYER_1)},
scores AS (SELECT -1 - rid AS event_id, string_agg({_LOGISTIC}::VARCHAR, ',' ORDER BY m::INT) AS scores
  FROM fitted WHERE NOT train GROUP BY rid)
SELECT event_id, instance, label, p_main, valve_a, class, true AS known_class, scores
FROM obs LEFT JOIN scores USING (event_id)""")
def _stacked(t: Tables):
    """Every observation with its class and the scores of all label models, in millionths."""
    df = split.attach_split(t.obs(), split.group_split(t.obs(), "instance", ["label"]),
                            ["label", "instance"])
    model = stacking.fit_stacked(df.filter("split = 'train'"), CONTINUOUS, CATEGORICAL)
    scores = [_millionths(F.col(f"{stacking.PREFIX}{k}")).cast("string")
              for k in sorted(model.layer_1)]
    return model.transform(t.obs()).select(
        "event_id", "instance", "label", "p_main", "valve_a", "class",
        F.col("predicted_class").isin(list(model.classes)).alias("known_class"),
        F.concat_ws(",", *scores).alias("scores"))


@query("stacked_forest", _AGREED)
def _stacked_forest(t: Tables):
    """Layer 2 of the stacked model on the test rows, against a walk over its nodes."""
    df = split.attach_split(t.obs(), split.group_split(t.obs(), "instance", ["label"]),
                            ["label", "instance"])
    model = stacking.fit_stacked(df.filter("split = 'train'"), CONTINUOUS, CATEGORICAL)
    test = df.filter("split = 'test'").withColumn("final_class", multiclass_target(F.col("class")))
    return _forest_checked(model.layer_2, model.layer_1_scores(test))


_WHOLE = "p_main IS NOT NULL AND p_aux IS NOT NULL"


@query("smote_minority", f"""
WITH c AS (SELECT label, count(*) AS n FROM obs WHERE {_WHOLE} GROUP BY label),
low AS (SELECT label FROM c ORDER BY n, label LIMIT 1)
SELECT c.label, CASE WHEN c.label = low.label THEN (SELECT max(n) FROM c) ELSE n END AS n_rows,
  CASE WHEN c.label = low.label THEN (SELECT max(n) FROM c) - n ELSE 0 END AS n_synthetic,
  (SELECT count(*) FROM obs o WHERE o.label = c.label AND {_WHOLE}) AS n_original
FROM c, low""")
def _smote(t: Tables):
    more = balance.smote_minority(t.obs(), "label", ["p_main", "p_aux"], ["event_id"])
    made = F.when(F.col("synthetic"), 1)
    return more.groupBy("label").agg(
        F.count("*").alias("n_rows"), F.count(made).alias("n_synthetic"),
        F.count(F.when(~F.col("synthetic"), 1)).alias("n_original"))
