"""Model inputs: scaling, encoding, class weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.cluster import checkpointed, small_side
from sonde.functions import col, lookup
from sonde.operators.series import position


@dataclass(frozen=True)
class Scaler:
    """Mean and deviation per column, fitted on a training set."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Scale in place; rows with a null input are dropped, a constant column becomes 0."""
        fitted = dict(zip(self.columns, zip(self.means, self.deviations)))

        def scaled(name: str):
            if name not in fitted:
                return col(name)
            mean, dev = fitted[name]
            if not dev:
                return F.lit(0.0).alias(name)
            return ((col(name) - F.lit(mean)) / F.lit(dev)).alias(name)

        whole = df.na.drop(subset=[f"`{c}`" for c in self.columns])
        return whole.select(*[scaled(c) for c in df.columns])


def fit_scaler(train: DataFrame, cols: Sequence[str], population: bool = False) -> Scaler:
    """One aggregate over the rows without nulls in ``cols``; sample deviation by default."""
    dev = F.stddev_pop if population else F.stddev_samp
    whole = train.na.drop(subset=[f"`{c}`" for c in cols])
    row = whole.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[dev(col(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    n = range(len(cols))
    return Scaler(tuple(cols), tuple(row[f"m{i}"] for i in n),
                  tuple(row[f"s{i}"] or 0.0 for i in n))


def frequency_index(df: DataFrame, column: str, name: str) -> StringIndexerModel:
    """Index by falling frequency, ties by name; unseen values get one index past the last."""
    return StringIndexer(inputCol=column, outputCol=name, handleInvalid="keep",
                         stringOrderType="frequencyDesc").fit(df)


def label_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Distinct values in sorted order with codes 0, 1, ..: the map and, read back, its inverse."""
    known = df.select(col(column)).filter(col(column).isNotNull()).distinct()
    return position(checkpointed(known), [], [column], name)


def label_encode(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    return lookup(df, small_side(label_codes(df, column, name)), [column])


def one_hot(df: DataFrame, code: str, width: int, name: str = "one_hot") -> DataFrame:
    """Array of ``width`` numbers with a 1 at the place of the code."""
    return df.withColumn(name, F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.when(col(code) == i, 1).otherwise(0)))


def class_weights(df: DataFrame, klass: str, name: str = "weight") -> DataFrame:
    """Balanced weight n / (classes * rows of the class): one row per class."""
    counts = checkpointed(df.filter(col(klass).isNotNull()).groupBy(col(klass)).agg(
        F.count("*").alias("n")))
    total = counts.agg((F.sum("n") / F.count("*")).alias("t")).scalar()
    return counts.withColumn(name, total / F.col("n"))


def attach_weights(df: DataFrame, klass: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, klass, name).select(col(klass), name)
    return lookup(df, small_side(weights), [klass])
