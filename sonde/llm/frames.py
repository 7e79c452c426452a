"""What the operators share: private column names, staged tables, Arrow batch helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.cluster import scratch_path

# Null ids are carried as the smallest long and turned back into null in results.
NULL_ID = -(2 ** 63)

# Python workers get batches of this many texts; one batch and its results are held at a time.
ROWS_PER_BATCH = 512


def keyed(docs: DataFrame, *more: str, id_column: str = "doc_id") -> DataFrame:
    """The columns an operator reads and no others, so that extra columns never clash."""
    return docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("id"),
                       *[F.col(f"`{c}`").alias(c) for c in more])


def real_id(name: str = "id") -> Column:
    """The id as it was given."""
    return F.when(F.col(name) != F.lit(NULL_ID), F.col(name))


def staged(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write a table to the shared folder and scan it from there; lost tasks stop here.

    A scan holds a group of rows at once: ``wide`` ones, of a megabyte or so, are written in small
    groups.
    """
    path = scratch_path(df.sparkSession, name)
    small = {"parquet.block.size": 4 << 20, "parquet.block.size.row.check.min": 1} if wide else {}
    df.write.options(compression="zstd", **small).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_BATCH):
    """Arrow batches, cut into short ones.

    Workers live on after their tasks: what Arrow holds of earlier batches goes back first.
    """
    for batch in batches:
        pa.default_memory_pool().release_unused()
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lists(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def sampled(df: DataFrame, want: int, *keys: str) -> DataFrame:
    """About ``want`` rows by a hash of ``keys``, never more than twice as many.

    A row's place does not depend on the others, and what is passed on does not grow with the
    number of partitions, as the parts of a sorted limit would.
    """
    share = want / max(df.count(), 1)
    place = F.xxhash64(*keys, F.lit("sample")) / F.lit(2.0 ** 64) + F.lit(0.5)
    return df.filter(place < share).limit(2 * want)
