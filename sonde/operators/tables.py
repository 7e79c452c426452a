"""Column selection and row deletion that depends on how much of a column is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonde.cluster import small_side
from sonde.functions import col, is_missing, lookup


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns but the excluded ones, in table order."""
    return [c for c in df.columns if c not in set(exclude)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def columns_by_type(typed: DataFrame, kinds: Sequence[str], skip: Sequence[str] = ()
                    ) -> list[str]:
    """Tags of the given kinds from a value-type table (one row per column of a data table)."""
    rows = typed.filter(F.col("value_type").isin(list(kinds))).select("Tag").sort("Tag").collect()
    return [r["Tag"] for r in rows if r["Tag"] not in skip]


def present_shares(df: DataFrame) -> dict[str, float]:
    """Share of present values of every column, from one aggregate over the table."""
    row = df.agg(F.count("*").alias("n"), *[
        F.count(F.when(~is_missing(df, c), 1)).alias(f"c{i}") for i, c in enumerate(df.columns)
    ]).first()
    return {c: (row[f"c{i}"] / row["n"] if row["n"] else 0.0) for i, c in enumerate(df.columns)}


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop the columns in which nothing is present."""
    return df.drop(*[c for c, share in present_shares(df).items() if share == 0.0])


def drop_sparse_columns(df: DataFrame, min_present: float | None = 0.5,
                        max_missing: float | None = None) -> DataFrame:
    """Drop columns with less than ``min_present`` present, or more than ``max_missing`` missing."""
    shares = present_shares(df)
    if max_missing is not None:
        bad = [c for c, s in shares.items() if 1.0 - s > max_missing]
    else:
        bad = [c for c, s in shares.items() if s < min_present]
    return df.drop(*bad)


def drop_void_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)])


def drop_incomplete_instances(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keep only the series that have at least one value in every one of ``cols``."""
    counted = df.groupBy(col(key)).agg(*[F.count(col(c)).alias(f"n{i}")
                                         for i, c in enumerate(cols)])
    whole = counted
    for i in range(len(cols)):
        whole = whole.filter(F.col(f"n{i}") > 0)
    return lookup(df, small_side(whole.select(col(key))), [key], "left_semi")


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are null there."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def columns_not_in(df: DataFrame, tags: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(tags)]


def missing_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``<c>_missing`` (1 where null or NaN, else 0) for every column, in one projection."""
    return df.select("*", *[
        F.when(is_missing(df, c), F.lit(1)).otherwise(F.lit(0)).alias(f"{c}_missing") for c in cols
    ])


def check_complete(df: DataFrame, features: Sequence[str]) -> None:
    """Raise when a feature is not numeric or any column has nulls."""
    wrong = [c for c in features if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        raise ValueError(f"not numeric: {wrong}")
    row = df.agg(*[F.count(F.when(col(c).isNull(), 1)).alias(f"c{i}")
                   for i, c in enumerate(df.columns)]).first()
    nulls = {c: row[f"c{i}"] for i, c in enumerate(df.columns) if row[f"c{i}"]}
    if nulls:
        raise ValueError(f"nulls found: {nulls}")
