"""A training-data pipeline: five stages over ``documents``, each one operator of sonde.llm.

A stage takes what its predecessor kept and decides on all of it.  All stages but the last return
the columns of the documents; the last returns the packed pieces.  Stages decide on rows, not on
ids: doc_id may be null, or name different texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.cluster import scratch_path, staged
from sonde.llm import decontaminate, langid, packing, pii, simhash
from sonde.llm.queries import BYTE_BPE, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return langid.accepted(docs, langid.fit(docs))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number of their own per row, and the name of that column.

    The numbers are written with the rows, so that later reads agree on them.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    return docs.join(gone, row, "left_anti").drop(row)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group one row stays: the smallest doc_id (null after all others)."""
    rows, row = _numbered(docs)
    marks = simhash.near_duplicates(rows.withColumn("doc_id", F.col(row))).select(
        F.col("doc_id").alias(row), F.col("component_id").alias("group"))
    # Only ids and numbers meet here.
    named = marks.join(rows.select(row, F.col("doc_id").alias("id")), row)
    place = F.struct(F.col("id").isNull().alias("none"), "id", row)
    kept = named.groupBy("group").agg(F.min(place)[row].alias(row))
    return _without(rows, row, marks.select(row).join(kept, row, "left_anti"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    rows, row = _numbered(docs)
    hits = decontaminate.contaminated(rows.withColumn("doc_id", F.col(row)),
                                      table(spark, sf_dir, "benchmark"))
    return _without(rows, row, hits.select(F.col("doc_id").alias(row)).distinct())


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is masked; no document goes."""
    return pii.redacted(docs, pii.fit(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    # The executors still hold what the stages before have grown to: fewer words are kept.
    return packing.packed(docs, BYTE_BPE, remembered=REMEMBERED)


# Words whose ids a worker of the last stage keeps between batches.
REMEMBERED = 200_000

STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# The language classifier, the tagger and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
