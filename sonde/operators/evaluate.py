"""Evaluation tables.  All but the rank measures derive from one aggregate, the confusion table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.cluster import staged
from sonde.functions import col
from sonde.operators.series import running_total


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion_matrix(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(col(truth), col(guess)).agg(F.count("*").alias("n"))


def binary_confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """The four counts of a 0/1 classifier, in one aggregate."""
    def cell(t: int, g: int, name: str) -> Column:
        return F.count(F.when((col(truth) == t) & (col(guess) == g), 1)).alias(name)

    return df.agg(cell(1, 1, "tp"), cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"))


def binary_metrics(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall and F1; 0 where a denominator is 0."""
    four = binary_confusion(df, truth, guess)
    rates = four.withColumns({
        "precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": _ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", _ratio(F.lit(2.0) * p * r, p + r))


def class_scores(confusion: DataFrame, truth: str, guess: str, count: str = "n") -> DataFrame:
    """Precision, recall, F1 and support per class, from a confusion table."""
    n = col(count)
    hit = F.when(col(truth) == col(guess), n).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(col(truth).alias("klass"), n.alias("support"), zero.alias("predicted"),
                 hit.cast("bigint").alias("hits")),
        F.struct(col(guess).alias("klass"), zero.alias("support"), n.alias("predicted"),
                 zero.alias("hits")))
    per = confusion.select(F.explode(sides).alias("s")).select("s.*").groupBy("klass").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    p, r = F.col("precision"), F.col("recall")
    return per.withColumns({
        "precision": _ratio(F.col("hits"), F.col("predicted")),
        "recall": _ratio(F.col("hits"), F.col("support")),
    }).withColumn("f1", _ratio(F.lit(2.0) * p * r, p + r))


def multiclass_metrics(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, as one row."""
    return metrics_of(class_scores(confusion_matrix(df, truth, guess), truth, guess))


def metrics_of(per: DataFrame) -> DataFrame:
    total = F.sum("support")

    def weighted(name: str) -> Column:
        return (F.sum(F.col(name) * F.col("support")) / total).alias(f"weighted_{name}")

    return per.agg((F.sum("hits") / total).alias("accuracy"), weighted("precision"),
                   weighted("recall"), weighted("f1"))


def classification_report(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Scores per class plus their plain and support-weighted means, in one pass.

    Every class counts towards three rows: its own, the plain mean and the weighted mean.
    """
    per = class_scores(confusion_matrix(df, truth, guess), truth, guess)
    rows = F.array(
        F.struct(F.col("klass").cast("string").alias("class"), F.lit(1.0).alias("w")),
        F.struct(F.lit("macro avg").alias("class"), F.lit(1.0).alias("w")),
        F.struct(F.lit("weighted avg").alias("class"),
                 F.col("support").cast("double").alias("w")))
    names = ("precision", "recall", "f1")
    return per.select(F.explode(rows).alias("r"), *names, "support").groupBy(
        F.col("r.class").alias("class")).agg(
        *[F.try_divide(F.sum(F.col(n) * F.col("r.w")), F.sum("r.w")).alias(n) for n in names],
        F.sum("support").alias("support"))


def accuracy_by_group(df: DataFrame, group: str, truth: str, guess: str) -> DataFrame:
    right = F.when(col(truth) == col(guess), 1.0).otherwise(0.0)
    return df.groupBy(col(group)).agg(F.avg(right).alias("accuracy"), F.count("*").alias("n"))


def _score_counts(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score: equal scores meet before any ordering.

    The table is written once, because ordering reads it several times.
    """
    return staged(df.groupBy(col(score).cast("double").alias("s")).agg(
        F.count(F.when(col(truth) == 1, 1)).alias("pos"),
        F.count(F.when(col(truth) == 0, 1)).alias("neg")))


def auc_roc(df: DataFrame, truth: str, score: str, rows_per_chunk: int | None = None
            ) -> DataFrame:
    """Share of (positive, negative) pairs that the score orders right; ties count half.

    Null when one of the classes is absent.
    """
    ordered = running_total(_score_counts(df, truth, score), ["pos", "neg"], [], ["s"],
                            rows_per_chunk)
    wins = F.sum(F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.col("neg") * F.lit(0.5)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ordered.agg(F.when(pairs > 0, wins / pairs).alias("auc_roc"))


def auc_pr(df: DataFrame, truth: str, score: str, rows_per_chunk: int | None = None) -> DataFrame:
    """Area under precision over recall, by trapezoids; the first point is extended to recall 0."""
    counts = _score_counts(df, truth, score).withColumn("d", -F.col("s"))
    ordered = running_total(counts, ["pos", "neg"], [], ["d"], rows_per_chunk)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    seen_before = tp + fp - F.col("pos") - F.col("neg")
    here = F.try_divide(tp, tp + fp)
    before = F.when(seen_before > 0, (tp - F.col("pos")) / seen_before).otherwise(here)
    area = F.sum(F.col("pos") * (here + before) / F.lit(2.0))
    return ordered.agg(F.when(F.sum("pos") > 0, area / F.sum("pos")).alias("auc_pr"))


def soft_vote(df: DataFrame, probabilities: Sequence[str], name: str = "vote") -> DataFrame:
    """Mean of several probability arrays and the class with the highest mean (lowest on a tie)."""
    total = col(probabilities[0])
    for p in probabilities[1:]:
        total = F.zip_with(total, col(p), lambda a, b: a + b)
    mean = F.transform(total, lambda x: x / F.lit(float(len(probabilities))))
    voted = df.withColumn("mean_probability", mean)
    best = F.array_position("mean_probability", F.array_max("mean_probability")) - 1
    return voted.withColumn(name, best)


def missing_classes(df: DataFrame, klass: str, split: str = "split") -> DataFrame:
    """Classes that occur in one of train and test only."""
    sides = df.filter(col(klass).isNotNull()).groupBy(col(klass)).agg(
        F.max((col(split) == "train").cast("int")).alias("a"),
        F.max((col(split) == "test").cast("int")).alias("b"))
    return sides.filter(F.col("a") != F.col("b")).select(
        col(klass), F.when(F.col("a") == 1, "test").otherwise("train").alias("missing_in"))
