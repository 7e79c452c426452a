"""Imputation as fit -> fitted values -> transform, plus group means and class repair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.cluster import small_side
from sonde.functions import col, lookup, present
from sonde.operators.quantiles import exact_quantiles
from sonde.operators.series import fill_values
from sonde.reference import TRANSIENT_LABELS


@dataclass(frozen=True)
class Imputer:
    """One replacement value per column; a column without a value is left as it is."""

    values: Mapping[str, object]

    def transform(self, df: DataFrame) -> DataFrame:
        def filled(name: str):
            value = self.values.get(name)
            if value is None:
                return col(name)
            literal = F.lit(value).cast(df.schema[name].dataType)
            return F.coalesce(present(df, name), literal).alias(name)

        return df.select(*[filled(c) for c in df.columns])


def fit_continuous(df: DataFrame, cols: Sequence[str], strategy: str = "mean",
                   exact: bool = False, rows_per_chunk: int | None = None) -> Imputer:
    """Mean or median of every column, in one aggregate.

    The median is approximate (relative error 0.0001) unless ``exact`` is set.
    """
    cols = list(cols)
    if strategy not in ("mean", "median"):
        raise ValueError(f"unknown strategy {strategy!r}: use 'mean' or 'median'")
    if not cols:
        return Imputer({})
    df = df.select(*[present(df, c) for c in cols])
    if strategy == "median" and exact:
        rows = exact_quantiles(df, cols, [0.5], rows_per_chunk).collect()  # one row per column
        return Imputer({r["Tag"]: r["q0"] for r in rows})
    stat = F.avg if strategy == "mean" else (lambda c: F.percentile_approx(c, 0.5, 10_000))
    row = df.agg(*[stat(col(c)).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    return Imputer({c: row[f"v{i}"] for i, c in enumerate(cols)})


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value of every numeric column (smallest on a tie), in one pass."""
    long = df.select(*[col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], [col(c) for c in cols], "Tag", "v").filter("v IS NOT NULL AND NOT isnan(v)")
    counts = long.groupBy("Tag", "v").agg(F.count("*").alias("n"))
    return counts.groupBy("Tag").agg(F.min(F.struct(-F.col("n"), F.col("v").alias("v")))["v"]
                                     .alias("mode"))


def fit_categorical(df: DataFrame, cols: Sequence[str]) -> Imputer:
    if not cols:
        return Imputer({})
    return Imputer({r["Tag"]: r["mode"] for r in column_modes(df, cols).collect()})


def impute_group_mean(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Fill nulls with the mean of the row's group; a group without values stays null.

    Means are pre-aggregated and looked up, so a group of any size never meets in one task.
    """
    means = small_side(df.groupBy(*[col(k) for k in keys]).agg(
        *[F.avg(col(c)).alias(f"_m_{c}") for c in cols]))
    wide = lookup(df, means, keys)
    return wide.select(*[
        F.coalesce(col(c), col(f"_m_{c}")).alias(c) if c in cols else col(c) for c in df.columns])


def class_repair(df: DataFrame, keys: Sequence[str], order: Sequence[str], klass: str = "class",
                 state: str = "state", label: str = "label",
                 rows_per_chunk: int | None = None) -> DataFrame:
    """Fill null classes of a series.

    Nulls before the first class of the series become 0.  Later nulls, and all nulls of a series
    without any class, become 100 + label while the state is 1 and the label has a transient
    phase, and the label otherwise.
    """
    wide = fill_values(df, [klass], keys, order, rows_per_chunk)
    seen, first = col(f"_f_{klass}"), col(f"_s_{klass}")
    rule = (
        F.when(seen.isNull() & first.isNotNull(), F.lit(0))
        .when((col(state) == 1) & col(label).isin(TRANSIENT_LABELS), col(label) + 100)
        .otherwise(col(label))
    )
    fixed = F.coalesce(col(klass), rule).cast(df.schema[klass].dataType).alias(klass)
    return wide.select(*[fixed if c == klass else col(c) for c in df.columns])
