"""Registry of queries, table schemas, and the observation view over ``events``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Schemas of the test tables that the queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

# The observation table: sensor series with gaps, derived from ``events``.  Both engines accept
# the same expressions.
OBS = [
    "event_id", "ts", "user_id AS instance", "CAST(user_id % 10 AS INT) AS label",
    "concat('WELL-', lpad(CAST(user_id % 7 AS STRING), 5, '0')) AS well",
    "CAST(user_id AS STRING) AS id",
    "CASE user_id % 3 WHEN 0 THEN 'Real' WHEN 1 THEN 'Simulated' ELSE 'Drawn' END AS data_type",
    "CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS p_main",
    "CASE WHEN user_id % 11 = 0 OR event_id % 3 = 0 THEN NULL ELSE value * 2 END AS p_aux",
    "CASE WHEN event_id % 7 < 4 THEN NULL ELSE value + 1 END AS p_sparse",
    "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 3 AS DOUBLE) / 2 END AS valve_a",
    "CAST(NULL AS DOUBLE) AS empty_a",
    "CAST(CASE WHEN event_id % 8 = 0 THEN NULL ELSE event_id % 2 END AS INT) AS state",
    "CAST(CASE WHEN event_id % 8 = 0 OR user_id % 13 = 0 THEN NULL "
    "WHEN user_id % 10 IN (0) THEN 0 WHEN user_id % 10 IN (3, 4) THEN user_id % 10 "
    "WHEN event_type = 'error' THEN user_id % 10 "
    "WHEN event_type IN ('click', 'view') THEN 100 + user_id % 10 ELSE 0 END AS INT) AS class",
]
OBS_COLUMNS = ["event_id", "ts", "instance", "label", "well", "id", "data_type", "p_main", "p_aux",
               "p_sparse", "valve_a", "empty_a", "state", "class"]
OBS_SQL = "SELECT " + ", ".join(OBS) + " FROM events"

EVENT_CLASS_LIST = "(3, 4, 101, 102, 105, 106, 107, 108, 109)"
MULTI_SQL = f"CAST(CASE WHEN class IN {EVENT_CLASS_LIST} THEN class ELSE 0 END AS INT)"
PREDS_SQL = (
    "SELECT event_id, well, y, yhat, CAST(y > 0 AS INT) AS y01, CAST(yhat > 0 AS INT) AS yhat01, "
    "score FROM (SELECT event_id, well, y, "
    "CAST(CASE WHEN event_id % 6 = 0 THEN 0 ELSE y END AS INT) AS yhat, score FROM "
    f"(SELECT event_id, well, {MULTI_SQL} AS y, p_main AS score FROM obs "
    "WHERE p_main IS NOT NULL) a) b")


class Tables:
    """The test tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def obs(self) -> DataFrame:
        return self.table("events").selectExpr(*OBS)

    def preds(self) -> DataFrame:
        from pyspark.sql import functions as F

        from sonde.functions import multiclass_target

        y, yhat = F.col("y"), F.col("yhat")
        base = self.obs().filter("p_main IS NOT NULL").select(
            "event_id", "well", multiclass_target(F.col("class")).alias("y"),
            F.col("p_main").alias("score"))
        guessed = base.withColumn("yhat", F.when(F.col("event_id") % 6 == 0, 0).otherwise(y))
        return guessed.select("event_id", "well", "y", "yhat", (y > 0).cast("int").alias("y01"),
                              (yhat > 0).cast("int").alias("yhat01"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``obs`` and ``preds`` in the SQL are expanded to their definitions."""
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            views = [f"obs AS ({OBS_SQL})"] if "obs" in sql or "preds" in sql else []
            views += [f"preds AS ({PREDS_SQL})"] if "preds" in sql else []
            body = sql.strip()
            if views and body.upper().startswith("WITH "):
                ORACLES[name] = "WITH " + ", ".join(views) + ", " + body[5:]
            elif views:
                ORACLES[name] = "WITH " + ", ".join(views) + " " + body
            else:
                ORACLES[name] = body
        return fn
    return register
