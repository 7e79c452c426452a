"""Splits and samples that repeat exactly: the random order is an md5 of the key and a seed.

Ranks inside a stratum are found without sorting a stratum in one task: md5 text is uniform, so
its first hex digits cut every stratum into even buckets.  A rank is the size of the earlier
buckets plus the rank inside the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.cluster import small_side, staged
from sonde.functions import col, lookup, md5_of

BUCKET_DIGITS = 4  # 65,536 buckets per stratum


def hash_rank(df: DataFrame, strata: Sequence[str], key: Sequence[str], seed: int = 42,
              digits: int = BUCKET_DIGITS) -> DataFrame:
    """Add ``_rank`` (1-based, in md5 order inside the stratum) and ``_size`` (of the stratum).

    ``df`` is read twice, for the bucket sizes and for the ranks.
    """
    marked = df.withColumn("_h", md5_of(key, seed))
    # A struct is equal to another where both hold a null, so stratum and bucket are one plain
    # key, and the join below finds the rows where the window's shuffle has put them.
    parts = F.struct(*[col(s).alias(f"s{i}") for i, s in enumerate(strata)],
                     F.substring("_h", 1, digits).alias("bucket"))
    marked = marked.withColumn("_bucket", parts)
    inside = Window.partitionBy("_bucket").orderBy("_h", *[col(k) for k in key])
    sizes = marked.groupBy("_bucket").agg(F.count("*").alias("_in"))
    # At most 16**digits rows per stratum from here on.
    stratum = Window.partitionBy(*[F.col("_bucket")[f"s{i}"] for i in range(len(strata))])
    before = sizes.select(
        "_bucket", F.sum("_in").over(stratum).alias("_size"),
        (F.sum("_in").over(stratum.orderBy(F.col("_bucket")["bucket"]).rowsBetween(
            Window.unboundedPreceding, 0)) - F.col("_in")).alias("_before"))
    out = marked.withColumn("_rank", F.row_number().over(inside)).join(before, "_bucket")
    ranked = F.col("_rank") + F.col("_before")
    return out.select(*[col(c) for c in df.columns], ranked.alias("_rank"), "_size")


def split_of_rank(rank: Column, size: Column, ratio: float, small: int = 4) -> Column:
    """Train or test for a rank: strata of up to ``small`` members give only their last to test."""
    many = size > small
    return (
        F.when(many & (rank <= size * F.lit(ratio)), "train").when(many, "test")
        .when(rank < size, "train").otherwise("test")
    )


def group_split(df: DataFrame, key: str, strata: Sequence[str] = (), ratio: float = 0.8,
                small: int = 4, seed: int = 42) -> DataFrame:
    """One row per series with its ``split``; a series is never in both."""
    series = df.select(*[col(s) for s in strata], col(key)).distinct()
    ranked = hash_rank(staged(series), strata, [key], seed)
    return ranked.select(*[col(s) for s in strata], col(key), split_of_rank(
        F.col("_rank"), F.col("_size"), ratio, small).alias("split"))


def attach_split(df: DataFrame, splits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the ``split`` of its series to every row."""
    return lookup(df, small_side(splits.select(*[col(k) for k in keys], "split")), keys, "inner")


def stratified_group_split(df: DataFrame, key: str, label: str, ratio: float = 0.8,
                           seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; series are ranked at random inside their label."""
    whole = attach_split(df, group_split(df, key, [label], ratio, seed=seed), [label, key])
    return (whole.filter("split = 'train'").drop("split"),
            whole.filter("split = 'test'").drop("split"))


def disjoint_group_split(df: DataFrame, key: str, klass: str, ratio: float = 0.8,
                         seed: int = 42) -> DataFrame:
    """Split series by class when a series can have several classes.

    A series counts only for its smallest class, as if classes were handled in order and series
    already placed were skipped.  A class with a single new series gives it to train.
    """
    first = df.groupBy(col(key)).agg(F.min(col(klass)).alias("first_class"))
    ranked = hash_rank(staged(first), ["first_class"], [key], seed)
    rank, size = F.col("_rank"), F.col("_size")
    test = F.ceil(size * F.lit(round(1 - ratio, 10)))
    return ranked.select(col(key), "first_class", F.when(
        (size <= 1) | (rank <= size - test), "train").otherwise("test").alias("split"))


def three_way_split(df: DataFrame, key: str, klass: str, ratio: float = 0.8, seed: int = 42
                    ) -> DataFrame:
    """Train, validation and test members of every class.

    The same series may occur in several classes and so in several splits.
    """
    members = staged(df.select(col(klass), col(key)).distinct())
    ranked = hash_rank(members, [klass], [key], seed)
    share = F.lit(round(1 - ratio, 10))
    size = F.col("_size")
    n_test = F.ceil(size * share)
    n_val = F.ceil((size - n_test) * share)
    return ranked.select(col(klass), col(key), F.when(
        F.col("_rank") <= size - n_test - n_val, "train").when(
        F.col("_rank") <= size - n_test, "val").otherwise("test").alias("split"))


def hash_bucket(key: Sequence[str], buckets: int = 100, seed: int = 42) -> Column:
    """Bucket of a row from its key alone: a row-wise random split needs no shuffle."""
    return F.pmod(F.conv(F.substring(md5_of(key, seed), 1, 8), 16, 10).cast("bigint"),
                  F.lit(buckets))


def below(key: Sequence[str], share: float, seed: int = 42) -> Column:
    """Whether 60 bits of the row's hash, as a number from 0 to 1, are less than ``share``."""
    bits = F.conv(F.substring(md5_of(key, seed), 1, 15), 16, 10).cast("bigint")
    return bits < F.lit(int(share * 2 ** 60))


def hash_split(df: DataFrame, key: Sequence[str], ratio: float = 0.8, seed: int = 42
               ) -> DataFrame:
    """Rows whose hash falls below the ratio are train; the ratio is not rounded."""
    train = below(key, ratio, seed)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def hash_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Rows whose hash falls below the fraction, which is not rounded."""
    return df.filter(below(key, fraction, seed))


def stratified_sample(df: DataFrame, strata: Sequence[str], key: Sequence[str], fraction: float,
                      seed: int = 42, digits: int = BUCKET_DIGITS) -> DataFrame:
    """The same share of every stratum, to the row (``key`` is unique in a stratum).

    Only the hash at which each stratum is cut is computed by ranking, and only inside the one
    bucket that holds it.  The rows themselves are then filtered in place, without a shuffle.
    """
    by = [col(s) for s in strata]
    marked = df.withColumn("_h", md5_of(key, seed))
    hashes = marked.select(*by, "_h", F.substring("_h", 1, digits).alias("_bucket"))
    sizes = hashes.groupBy(*by, "_bucket").agg(F.count("*").alias("_in"))
    stratum = Window.partitionBy(*by)  # at most 16**digits rows
    upto = stratum.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    edges = sizes.select(
        *by, "_bucket", "_in", F.sum("_in").over(upto).alias("_upto"),
        F.floor(F.sum("_in").over(stratum) * F.lit(fraction)).alias("_take"),
    ).filter((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_in") < F.col("_take")))
    edges = edges.select(*by, "_bucket", (F.col("_take") - F.col("_upto") + F.col("_in"))
                         .alias("_need"))
    cuts = (
        lookup(hashes, small_side(edges), [*strata, "_bucket"], "inner")
        .withColumn("_rank", F.row_number().over(stratum.orderBy("_h")))
        .filter(F.col("_rank") == F.col("_need")).select(*by, F.col("_h").alias("_cut"))
    )
    kept = lookup(marked, small_side(cuts), strata, "inner").filter(F.col("_h") <= F.col("_cut"))
    return kept.select(*[col(c) for c in df.columns])


def split_overlap(splits: DataFrame, key: str) -> DataFrame:
    """Number of series in train and test at once; 0 for a sound split."""
    sides = splits.groupBy(col(key)).agg(
        F.max((F.col("split") == "train").cast("int")).alias("a"),
        F.max((F.col("split") == "test").cast("int")).alias("b"))
    return sides.agg(F.count(F.when((F.col("a") == 1) & (F.col("b") == 1), 1)).alias("overlap"))


def split_counts(df: DataFrame, label: str, key: str) -> DataFrame:
    return df.groupBy("split", col(label)).agg(F.countDistinct(col(key)).alias("n_instances"))


def split_report(df: DataFrame, klass: str, key: str) -> DataFrame:
    """Rows and distinct series of every split, and of every class in it."""
    seen = df.groupBy("split", col(klass), col(key)).agg(F.count("*").alias("n"))
    sets = [[F.col("split"), col(klass)], [F.col("split")]]
    return seen.groupingSets(sets, F.col("split"), col(klass)).agg(
        F.sum("n").alias("n_rows"), F.countDistinct(col(key)).alias("n_ids"))
