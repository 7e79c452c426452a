"""Oversampling of the rarest class by interpolation between near neighbours (SMOTE)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.cluster import checkpointed, small_side, staged
from sonde.functions import col
from sonde.operators.series import cut_series
from sonde.operators.split import hash_rank

MAX_LEVEL = 40


def _squared_distance(a: Column, b: Column, d: int) -> Column:
    total = F.lit(0.0)
    for i in range(d):
        total = total + (a[i] - b[i]) * (a[i] - b[i])
    return total


def _on_curve(points: DataFrame, cuts: Sequence[Sequence[float]], bits: int) -> DataFrame:
    """Add ``_z``, the place on a Z-order curve: the bits of the coordinates' ranks, interleaved."""
    d = len(cuts)
    ends = [[float("-inf"), *axis, float("inf")] for axis in cuts]
    ranks = Bucketizer(splitsArray=ends, inputCols=[f"_v{i}" for i in range(d)],
                       outputCols=[f"_r{i}" for i in range(d)])
    ranked = ranks.transform(points.withColumns({f"_v{i}": F.col("x")[i] for i in range(d)}))
    place = F.lit(0).cast("bigint")
    for i in range(d):
        rank = F.col(f"_r{i}").cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            place = place + F.shiftleft(bit, b * d + i)
    return ranked.select("x", "m", place.alias("_z"))


def nearest_points(points: DataFrame, d: int, k: int = 5, rows_per_chunk: int | None = None
                   ) -> DataFrame:
    """The exact ``k`` nearest other points of every point, without comparing all pairs.

    ``points`` has distinct arrays ``x`` of ``d`` numbers and their multiplicity ``m``.

    1. The points are sorted along a Z-order curve over equal-count steps of every axis.  The
       k-th best of the 4k points around a point on the curve bounds the distance of its k-th
       neighbour from above.
    2. Every point searches a grid whose cells are at least as wide as its own bound, so its
       neighbours lie in its cell or in the ones next to it.  Dense regions have small bounds
       and therefore fine grids.  Only pairs within the bound are kept and ranked.
    """
    bits = min(10, 60 // d) or 1
    steps = [(i + 1) / 2 ** bits for i in range(2 ** bits - 1)]
    spans = points.agg(*[
        f(F.col("x")[i]).alias(f"{tag}{i}") for i in range(d)
        for tag, f in (("lo", F.min), ("hi", F.max), ("sd", F.stddev_pop),
                       ("cut", lambda c: F.percentile_approx(c, steps, 10_000)))
    ]).first()
    axes = sorted(range(d), key=lambda i: -(spans[f"sd{i}"] or 0.0))[:3]
    reach = math.sqrt(sum((spans[f"hi{i}"] - spans[f"lo{i}"]) ** 2 for i in range(d))) or 1.0

    # The place is computed once per row and written, as several passes read it.
    placed = staged(_on_curve(points, [sorted(set(spans[f"cut{i}"])) for i in range(d)], bits))
    ch = cut_series(placed, [], ["_z", "x"], rows_per_chunk)
    around = ch.window.rowsBetween(-2 * k, 2 * k)
    near = F.sort_array(F.transform(F.collect_list("x").over(around),
                                    lambda o: F.sqrt(_squared_distance(o, F.col("x"), d))))
    # The point itself is among its surroundings, at distance 0.
    bound = F.coalesce(F.get(near, F.lit(k)), F.lit(reach))
    level = F.ceil(F.log2(F.greatest(bound, F.lit(reach * 2.0 ** -MAX_LEVEL)) / F.lit(reach)))
    bounded = checkpointed(ch.df.select(
        "x", "m", bound.alias("r"), level.cast("int").alias("level")))

    def cell(i: int) -> Column:
        return F.floor((F.col("x")[i] - F.lit(spans[f"lo{i}"]))
                       / (F.lit(reach) * F.pow(F.lit(2.0), F.col("level")))).cast("bigint")

    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    asks = bounded.select(F.col("x").alias("qx"), "r", "level", *[
        cell(i).alias(f"c{i}") for i in axes])
    for i in axes:
        asks = asks.withColumn("_o", F.explode(step)).withColumn(
            f"c{i}", F.col(f"c{i}") + F.col("_o")).drop("_o")
    levels = [r[0] for r in bounded.select("level").distinct().collect()]  # at most MAX_LEVEL + 1
    holds = bounded.select("x", "m").withColumn(
        "level", F.explode(F.array(*[F.lit(v) for v in levels]))).select(
        "x", "m", "level", *[cell(i).alias(f"c{i}") for i in axes])
    # A cell is described by its level and place; bounds make crowded cells rare, and adaptive
    # execution splits the ones that remain.
    pairs = asks.join(holds, ["level", *[f"c{i}" for i in axes]])
    distance = F.sqrt(_squared_distance(F.col("qx"), F.col("x"), d))
    close = pairs.withColumn("dist", distance).filter(
        (F.col("dist") <= F.col("r")) & (F.col("dist") > 0))
    best = Window.partitionBy("qx").orderBy("dist", "x")
    return (close.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k)
            .groupBy("qx").agg(F.sort_array(F.collect_list(F.struct("dist", "x", "m")))
                               .alias("near"))
            .withColumnRenamed("qx", "x"))


def smote_minority(df: DataFrame, label: str, features: Sequence[str], key: Sequence[str],
                   k: int = 5, seed: int = 42, rows_per_chunk: int | None = None) -> DataFrame:
    """Raise the rarest class to the size of the largest one with interpolated rows.

    A new row lies between a row of the class and one of its ``k`` nearest rows of that class.
    New rows are spread evenly over the class; the neighbour and the place between the two come
    from a hash of the new row's number.  Output: label, features and ``synthetic``.
    """
    whole = df.na.drop(subset=[f"`{f}`" for f in features])
    d = len(features)
    sizes = whole.groupBy(col(label)).agg(F.count("*").alias("n"))
    ends = sizes.agg(F.min(F.struct("n", col(label).alias("c"))).alias("low"),
                     F.max("n").alias("high")).first()
    rare, have, need = ends["low"]["c"], ends["low"]["n"], ends["high"] - ends["low"]["n"]
    kept = whole.select(col(label), *[col(f) for f in features]).withColumn(
        "synthetic", F.lit(False))
    if need == 0:
        return kept
    if have < 2:
        raise ValueError("the rarest class needs at least two rows")

    # Adding 0.0 turns -0.0 into 0.0, so that equal points are equal arrays.
    x = F.array(*[col(f).cast("double") + F.lit(0.0) for f in features])
    rows = whole.filter(col(label) == rare).select(*[col(c) for c in key], x.alias("x"))
    points = checkpointed(rows.groupBy("x").agg(F.count("*").alias("m")))
    found = nearest_points(points, d, k, rows_per_chunk)
    copies = F.array_repeat(F.col("x"), F.least(F.col("m") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform("near", lambda p: F.array_repeat(
        p["x"], F.least(p["m"], F.lit(k)).cast("int"))))
    near = points.join(found, "x", "left").select("x", F.slice(
        F.concat(copies, F.coalesce(others, F.array().cast("array<array<double>>"))), 1, k)
        .alias("near"))

    ranked = hash_rank(rows, [], key, seed).select(
        (F.col("_rank") - 1).cast("bigint").alias("slot"), "x")
    base = small_side(ranked.join(near, "x"))
    new = df.sparkSession.range(need).withColumn("slot", F.col("id") % F.lit(have))
    pick = F.pmod(F.xxhash64("id", F.lit(seed)), F.size("near")).cast("int")
    share = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    mixed = new.join(base, "slot").withColumns({"_to": F.get("near", pick), "_u": share})
    made = mixed.select(
        F.lit(rare).cast(df.schema[label].dataType).alias(label), *[
            (F.col("x")[i] + F.col("_u") * (F.col("_to")[i] - F.col("x")[i]))
            .cast(df.schema[f].dataType).alias(f) for i, f in enumerate(features)],
        F.lit(True).alias("synthetic"))
    return kept.unionByName(made)
