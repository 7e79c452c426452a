"""Series stored as blocks of rows, and sliding windows of any stride as slices of them.

A block is one row: arrays of a bounded number of consecutive rows of a series, and before them the
last rows of the block before (its halo).  Every window ends in one block and lies in that block and
its halo, so windows are read without a shuffle, and nothing is copied per window before that: a
row is stored once, a halo row twice.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.cluster import staged
from sonde.functions import col, lookup
from sonde.operators.series import position, running_total

ROWS_PER_BLOCK = 4096


def blocks_of(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str],
              order: Sequence[str], halo: int, rows_per_block: int = ROWS_PER_BLOCK,
              rows_per_chunk: int | None = None) -> DataFrame:
    """One row per block: keys, block, first (place of its first own row), halo (rows before that
    one in ``rows``), rows (structs of at: the order columns, x: the features, y: the target).

    A group has at most ``rows_per_block`` + ``halo`` rows, however long a series is.
    """
    if not 0 <= halo <= rows_per_block:
        raise ValueError("a halo reaches into the block before, not further")
    placed = position(df, keys, order, "_place", rows_per_chunk)
    own = F.expr(f"_place DIV {rows_per_block}")
    late = F.pmod(F.col("_place"), F.lit(rows_per_block)) >= rows_per_block - halo
    at = F.struct(*[col(o) for o in order])
    x = F.array(*[col(f).cast("double") for f in features])
    copies = placed.select(
        *[col(k) for k in keys], F.col("_place"), at.alias("at"), x.alias("x"), col(target).alias("y"),
        F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))).alias("block"))
    blocks = copies.groupBy(*[col(k) for k in keys], "block").agg(F.sort_array(F.collect_list(
        F.struct("_place", "at", "x", "y"))).alias("rows"))
    first = F.col("block") * rows_per_block
    return blocks.select(
        *[col(k) for k in keys], "block", first.alias("first"),
        F.size(F.filter("rows", lambda r: r["_place"] < first)).alias("halo"),
        F.transform("rows", lambda r: F.struct(r["at"], r["x"], r["y"])).alias("rows")
    ).filter(F.size("rows") > F.col("halo"))  # a halo after the last row has no block of its own


def _starts(length: int, step: int) -> tuple[Column, Column]:
    """Number of windows that end before the block's first own row, and before its end."""
    def ended(rows: Column) -> Column:
        # Windows end at places length - 1, length - 1 + step, ..
        return F.greatest(F.lit(0), F.floor((rows - F.lit(length)) / F.lit(step)) + 1).cast("long")
    own = F.col("first") + F.size("rows") - F.col("halo")
    return ended(F.col("first")), ended(own)


def windows_of(blocks: DataFrame, keys: Sequence[str], order: Sequence[str], target: str,
               length: int, step: int = 1) -> DataFrame:
    """Windows of ``length`` rows, every ``step``-th of a series from its first on: keys, order
    columns of the last row, ``number`` (from 0 in the series), ``sequence`` and the target.

    The blocks need a halo of ``length`` - 1 rows.  Series shorter than that give nothing.
    """
    before, after = _starts(length, step)
    wanted = F.when(after > before, F.sequence(before, after - 1))
    found = blocks.select(*blocks.columns, F.explode(wanted).alias("number"))
    last = F.lit(length - 1) + F.col("number") * step - F.col("first") + F.col("halo")
    part = F.slice("rows", (last - (length - 2)).cast("int"), F.lit(length))
    end = F.get(F.col("rows"), last.cast("int"))
    extra = [c for c in blocks.columns if c not in (*keys, "block", "first", "halo", "rows")]
    return found.select(
        *[col(k) for k in keys], *[end["at"][o].alias(o) for o in order], "number",
        F.transform(part, lambda r: r["x"]).alias("sequence"), end["y"].alias(target), *extra)


def write_batches(df: DataFrame, path: str, features: Sequence[str], target: str,
                  keys: Sequence[str], order: Sequence[str], length: int, step: int = 1,
                  batch: int = 1024, rows_per_block: int = ROWS_PER_BLOCK) -> None:
    """Store a table of series for reading as numbered batches of ``batch`` windows.

    Windows are numbered through all series, in the order of the keys.  A block knows the number of
    its first window, from running totals over one small row per block; blocks are written in this
    order, so a reader of some batches skips the files of the others.
    """
    blocks = staged(blocks_of(df, features, target, keys, order, length - 1, rows_per_block), "blocks")
    before, after = _starts(length, step)
    counts = blocks.select(*[col(k) for k in keys], "block", (after - before).alias("n"))
    totals = running_total(counts, ["n"], [], [*keys, "block"]).select(
        *[col(k) for k in keys], "block", (F.col("cum_n") - F.col("n")).alias("start"), "n")
    numbered = lookup(blocks, totals, [*keys, "block"]).filter("n > 0")
    numbered = numbered.withColumn("stop", F.col("start") + F.col("n") - 1).drop("n")
    (numbered.repartitionByRange(F.col("start")).sortWithinPartitions("start")
     .write.mode("overwrite").parquet(f"{path}/blocks"))
    meta = {"keys": list(keys), "order": list(order), "features": list(features), "target": target,
            "length": length, "step": step, "batch": batch}
    df.sparkSession.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/meta")


def read_batches(spark: SparkSession, path: str, first: int = 0, last: int | None = None
                 ) -> DataFrame:
    """Batches ``first`` to ``last`` (all by default): batch, place (from 0 in the batch), keys,
    order columns of the last row, sequence, target."""
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    size, keys, order = meta["batch"], meta["keys"], meta["order"]
    blocks = spark.read.parquet(f"{path}/blocks").filter(F.col("stop") >= first * size)
    if last is not None:
        blocks = blocks.filter(F.col("start") < (last + 1) * size)
    before, _ = _starts(meta["length"], meta["step"])
    found = windows_of(blocks.withColumn("_shift", F.col("start") - before).drop("start", "stop"),
                       keys, order, meta["target"], meta["length"], meta["step"])
    index = F.col("number") + F.col("_shift")
    out = found.select(
        F.floor(index / F.lit(size)).cast("long").alias("batch"),
        F.pmod(index, F.lit(size)).cast("int").alias("place"),
        *[col(c) for c in (*keys, *order)], "sequence", col(meta["target"]))
    out = out.filter(F.col("batch") >= first)
    return out if last is None else out.filter(F.col("batch") <= last)
