"""The operators' queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sonde.cluster import scratch_path
from sonde.llm import (decontaminate, langid, merkle, negatives, neighbors, packing, paragraphs,
                       pii, sharding, simhash, suffixes, tokenfile, toxicity)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_suffix_dedup")
def suffix_dedup(spark, folder):
    return suffixes.removed(table(spark, folder, "documents"))


@query("op2_best_fit_packing")
def best_fit_packing(spark, folder):
    return packing.packed(table(spark, folder, "documents"), BYTE_BPE)


@query("op3_personal_data")
def personal_data(spark, folder):
    docs = table(spark, folder, "documents")
    return pii.personal_data(docs, pii.fit(docs))


@query("op4_sharding", sharding.oracle())
def shard_placement(spark, folder):
    return sharding.placed(table(spark, folder, "documents"))


@query("op5_simhash")
def simhash_near_dedup(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op6_language_id")
def language_id(spark, folder):
    docs = table(spark, folder, "documents")
    return langid.predict(docs, langid.fit(docs))


@query("op7_embedding_near_dedup")
def embedding_near_dedup(spark, folder):
    return neighbors.near_duplicates(table(spark, folder, "embeddings"))


@query("op8_token_files")
def token_files(spark, folder):
    out = scratch_path(spark, "tokens")
    tokenfile.write(table(spark, folder, "documents"), out, WORD_BPE)
    return tokenfile.digests(spark, out)


@query("op9_paragraph_dedup")
def paragraph_dedup(spark, folder):
    return paragraphs.repeated(table(spark, folder, "documents"))


@query("op10_decontamination")
def decontamination(spark, folder):
    return decontaminate.contaminated(table(spark, folder, "documents"),
                                      table(spark, folder, "benchmark"))


@query("op11_toxicity")
def toxic_documents(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query("op12_merkle_manifest", merkle.oracle())
def merkle_manifest(spark, folder):
    return merkle.verified(table(spark, folder, "documents"))


@query("op13_hard_negatives", negatives.oracle())
def hard_negatives(spark, folder):
    return negatives.mined(table(spark, folder, "embeddings"))
