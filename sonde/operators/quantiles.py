"""Exact quantiles of many columns without sorting a whole column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.cluster import staged
from sonde.functions import col
from sonde.operators.series import running_total


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    rows_per_chunk: int | None = None) -> DataFrame:
    """Quantiles with linear interpolation: one row per column, ``q0``, ``q1`` .. per prob.

    Equal values are counted first; running counts over the distinct values (in chunks) give
    every value its range of ranks, and only the values at the wanted ranks are kept.
    """
    long = df.select(*[col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], [col(c) for c in cols], "Tag", "v").filter("v IS NOT NULL AND NOT isnan(v)")
    # Counted once and written: the passes below read it several times.
    counts = staged(long.groupBy("Tag", "v").agg(F.count("*").alias("n")))
    ranked = running_total(counts, ["n"], ["Tag"], ["v"], rows_per_chunk)
    totals = counts.groupBy("Tag").agg(F.sum("n").alias("_total"))
    place = F.transform(F.array(*[F.lit(float(p)) for p in probs]),
                        lambda p: p * (F.col("_total") - 1))
    wanted = ranked.join(F.broadcast(totals), "Tag").withColumn("_at", place)  # a row per column

    def holds(rank):
        return (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))

    picks = []
    for i in range(len(probs)):
        at = F.col("_at")[i]
        picks += [F.max(F.when(holds(F.floor(at)), F.col("v"))).alias(f"lo{i}"),
                  F.max(F.when(holds(F.ceil(at)), F.col("v"))).alias(f"hi{i}"),
                  F.max(at - F.floor(at)).alias(f"w{i}")]
    found = wanted.groupBy("Tag").agg(*picks)
    return found.select("Tag", *[
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}")).alias(f"q{i}")
        for i in range(len(probs))])
