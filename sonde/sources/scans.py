"""Table scans.  Schemas are always explicit: nothing is inferred from file contents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonde.cluster import checkpointed, small_side
from sonde.functions import col, lookup
from sonde.operators.series import position


def scan_parquet(spark: SparkSession, path: str | Sequence[str],
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a directory tree of ``key=value`` folders becomes partition columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             header: bool = True) -> DataFrame:
    """Typed CSV scan."""
    paths = path if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("header", header).csv(paths)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def read_partitions(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Only the named partitions of a partitioned table; the scan skips the other folders."""
    return df.filter(col(column).isin(list(values)))


def number_instances(df: DataFrame, source: str, source_order: Sequence[str],
                     series: str, name: str = "Instance") -> DataFrame:
    """Number the series of all sources: 0-based inside a source, sources one after another.

    The list of series is one small row each, so it is ranked by source and looked up again.
    """
    place = F.array_position(F.array(*[F.lit(s) for s in source_order]), col(source))
    listed = checkpointed(df.select(col(source), col(series)).distinct())
    ranked = position(listed.withColumn("_place", place), [], ["_place", series], name)
    return lookup(df, small_side(ranked.drop("_place")), [source, series])


def load_instances(spark: SparkSession, roots: Mapping[str, str], schema: T.StructType,
                   ) -> DataFrame:
    """Read a folder of recordings for each source in one scan.

    A recording is a single Parquet file, or a folder of part files as Spark writes it.  Adds
    ``DataType`` (the source) and ``Instance`` (the recording's place in path order, counted on
    from source to source).
    """
    recording = F.regexp_replace("_metadata.file_path", r"/part-[^/]*$", "")
    parts = [
        spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)
        .withColumn("DataType", F.lit(source)).withColumn("_path", recording)
        for source, root in roots.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return number_instances(every, "DataType", list(roots), "_path").drop("_path")
