"""Table sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from sonde.functions import col


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str],
                      only_touched: bool = False) -> None:
    """Write one folder per value of ``by``.

    The rebalance hint gathers rare values into common tasks and splits a hot value by size, so
    neither many small files nor one endless writer comes of skew.  ``only_touched`` replaces
    just the folders that occur in ``df``.
    """
    mode = "dynamic" if only_touched else "static"
    (df.hint("rebalance", *[col(c) for c in by]).write.mode("overwrite")
       .option("partitionOverwriteMode", mode).partitionBy(*by).parquet(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export.  ``single_file`` is for reports, which are a few rows each."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def append_metrics(spark: SparkSession, path: str, run: str, kind: str,
                   values: Mapping[str, float]) -> None:
    """Append the parameters or metrics of one run as ``(run, kind, key, value)`` rows."""
    rows = [(run, kind, key, float(value)) for key, value in values.items()]
    schema = "run string, kind string, key string, value double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
