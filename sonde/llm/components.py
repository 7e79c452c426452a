"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.frames import staged


def _signature(edges: DataFrame):
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return tuple(row)


def _ordered(a, b):
    return [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node it reaches.

    ``links`` has two long columns ``a`` and ``b``; loops and repeats do no harm, nulls are not
    links.  Alternates large and small stars: each node's neighbours above it, then those below
    it, are hooked to the smallest one.  A star is one minimum per node (combined before the
    shuffle) and one equi-join, whose hot keys adaptive execution splits; no neighbour list is
    ever built.  Each round is written to the shared folder.  Paths of n nodes need about
    log(n) rounds; an error is raised if ``rounds`` are not enough.
    """
    edges = staged(links.select(*_ordered(F.col("a"), F.col("b")))
                   .filter("hi > lo").distinct(), "links")
    before = _signature(edges)
    for _ in range(rounds):
        if before[0] == 0:
            break
        both = edges.selectExpr("hi AS u", "lo AS v").union(edges.selectExpr("lo AS u", "hi AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .selectExpr("v AS hi", "m AS lo").filter("hi > lo").distinct())
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(below, "hi").filter("lo > m").selectExpr("lo AS hi", "m AS lo")
                 .union(below.selectExpr("hi", "m AS lo")).distinct())
        edges = staged(small, "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (edges.selectExpr("hi AS node", "lo AS root")
            .union(edges.selectExpr("lo AS node", "lo AS root").distinct()))
