"""Manifests of partitioned tables: what a partition held when it was written, so that partitions
that need rework are found by comparing, not listed by hand.

A partition has a row count, an order-free digest of its rows and a count of nulls per column.  A
table written with ``write_recorded`` keeps two of them beside its files: of the rows it was made from
and of the rows that were stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.functions import col, lookup
from sonde.sources.sinks import write_partitioned

# Beside the partition folders; scans skip names that begin with an underscore.
RECORD = "_manifest"


def row_digest(columns: Sequence[str]) -> Column:
    """60 bits of the MD5 of a row: each column its text length and text, ``-`` for null."""
    def framed(name: str) -> Column:
        text = col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    text = F.concat(*[framed(c) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def manifest_of(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per partition: by, n_rows, digest, nulls (column to count, all columns but ``by``).

    The digest is the sum of the rows' digests: it does not depend on their order, counts repeated
    rows, and is one aggregate that tasks combine before the shuffle.
    """
    rest = sorted(c for c in df.columns if c not in by)
    nulls = F.map_from_arrays(F.array(*[F.lit(c) for c in rest]), F.array(*[
        F.count(F.when(col(c).isNull(), 1)) for c in rest]))
    return df.groupBy(*[col(b) for b in by]).agg(
        F.count("*").alias("n_rows"),
        F.sum(row_digest(rest).cast("decimal(38,0)")).alias("digest"), nulls.alias("nulls"))


def _record(spark: SparkSession, source: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Manifests of the source rows and of what lies in the folders now, joined by partition."""
    found = spark.read.parquet(path).schema
    for name in by:  # folder names are read as the source's type, not as what they look like
        found[name].dataType = source.schema[name].dataType
    stored = manifest_of(spark.read.schema(found).parquet(path), by)
    both = [source_side.select(*[col(b).cast("string").alias(b) for b in by], F.struct(
        "n_rows", "digest", "nulls").alias(name))
        for name, source_side in (("source", manifest_of(source, by)), ("stored", stored))]
    return lookup(*both, by, "left")


def write_recorded(source: DataFrame, path: str, by: Sequence[str],
                   transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Write ``transform(source)`` partitioned by ``by``, and the manifests of both beside it.

    ``transform`` keeps the partition columns and works on every partition for itself.
    """
    write_partitioned(transform(source), path, by)
    _record(source.sparkSession, source, path, by).write.mode("overwrite").parquet(f"{path}/{RECORD}")


def stale_partitions(source: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Partitions to look at: by (as text) and ``reason``.

    ``new``: not written yet; ``changed``: the source is not what it was; ``damaged``: the folder
    does not hold what was stored; ``gone``: the source has no such rows any more; ``incomplete``:
    a column of the source is null throughout.  The first that applies, in this order, is given.
    """
    spark = source.sparkSession
    known = spark.read.parquet(f"{path}/{RECORD}").select(
        *by, F.col("source").alias("then"), F.col("stored").alias("kept"))
    now = _record(spark, source, path, by)
    every = now.select(*by).unionByName(known.select(*by)).distinct()
    all_ = lookup(lookup(every, now, by), known, by)

    def differ(a: str, b: str) -> Column:
        return ~(F.col(f"{a}.n_rows").eqNullSafe(F.col(f"{b}.n_rows"))
                 & F.col(f"{a}.digest").eqNullSafe(F.col(f"{b}.digest")))
    bare = F.exists(F.map_values("source.nulls"), lambda n: n == F.col("source.n_rows"))
    reason = (F.when(F.col("source").isNull(), "gone").when(F.col("then").isNull(), "new")
              .when(differ("source", "then"), "changed").when(differ("stored", "kept"), "damaged")
              .when(bare, "incomplete"))
    return all_.select(*by, reason.alias("reason")).filter("reason IS NOT NULL")


def rework_stale(source: DataFrame, path: str, by: Sequence[str],
                 transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Write the new, changed and damaged partitions again; other folders keep their files.

    Returns the partitions found (see ``stale_partitions``).  Folders of partitions that are gone are
    left in place, for the caller to decide on.
    """
    spark = source.sparkSession
    found = spark.createDataFrame(
        stale_partitions(source, path, by).collect(),  # at most one small row per partition
        ", ".join(f"`{b}` string" for b in by) + ", reason string")
    again = found.filter(F.col("reason").isin("new", "changed", "damaged"))
    texts = source.withColumns({f"_{b}": col(b).cast("string") for b in by})
    keys = again.select(*[F.col(b).alias(f"_{b}") for b in by])
    due = lookup(texts, keys, [f"_{b}" for b in by], "left_semi").drop(*[f"_{b}" for b in by])
    if not again.isEmpty():
        write_partitioned(transform(due), path, by, only_touched=True)
        # The record is read before it is replaced: a small row per partition.
        rows = _record(spark, source, path, by)
        gone = found.filter("reason = 'gone'").select(*by)
        rows = rows.unionByName(lookup(spark.read.parquet(f"{path}/{RECORD}"), gone, by, "left_semi"))
        fresh = spark.createDataFrame(rows.collect(), rows.schema)
        fresh.write.mode("overwrite").parquet(f"{path}/{RECORD}")
    return found
