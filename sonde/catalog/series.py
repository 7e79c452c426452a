"""Ordered operators on series."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonde.catalog.base import Tables, query
from sonde.cluster import scratch_path
from sonde.operators import impute, sequences, series

_ORDER = ["ts", "event_id"]


def _fill_sql(c: str, by: str = "instance", both: bool = True) -> str:
    part = f"PARTITION BY {by} " if by else ""
    back = (f"last_value({c} IGNORE NULLS) OVER ({part}ORDER BY ts, event_id "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    ahead = (f"first_value({c} IGNORE NULLS) OVER ({part}ORDER BY ts, event_id "
             "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
    return f"coalesce({back}, {ahead}) AS {c}" if both else f"{back} AS {c}"


@query("ffill_bfill", f"""
SELECT event_id, instance, {_fill_sql('p_main')}, {_fill_sql('p_aux')}, {_fill_sql('p_sparse')},
  {_fill_sql('valve_a')} FROM obs""")
def _fill(t: Tables):
    cols = ["p_main", "p_aux", "p_sparse", "valve_a"]
    return series.ffill_bfill(t.obs().select("event_id", "ts", "instance", *cols), cols,
                              ["instance"], _ORDER).drop("ts")


@query("ffill_bfill_by_label", f"""
SELECT event_id, label, {_fill_sql('p_main', 'label')}, {_fill_sql('p_aux', 'label')} FROM obs""")
def _fill_label(t: Tables):
    cols = ["p_main", "p_aux"]
    return series.ffill_bfill(t.obs().select("event_id", "ts", "label", *cols), cols, ["label"],
                              _ORDER).drop("ts")


@query("ffill_global", f"""
SELECT event_id, {_fill_sql('valve_a', '', False)}, {_fill_sql('state', '', False)} FROM obs""")
def _fill_global(t: Tables):
    cols = ["valve_a", "state"]
    return series.ffill_bfill(t.obs().select("event_id", "ts", *cols), cols, [], _ORDER,
                              backward=False).drop("ts")


@query("time_diff", """
SELECT event_id, instance, round(date_diff('microsecond', lag(ts) OVER (
  PARTITION BY instance ORDER BY ts, event_id), ts) / 1e6, 6) AS time_diff FROM obs""")
def _diff(t: Tables):
    return series.time_diff(t.obs().select("event_id", "ts", "instance"), "ts", ["instance"],
                            _ORDER).drop("ts").withColumn("time_diff", F.round("time_diff", 6))


@query("avg_time_step", """
WITH d AS (SELECT instance, date_diff('microsecond', lag(ts) OVER (
  PARTITION BY instance ORDER BY ts, event_id), ts) / 1e6 AS s FROM obs)
SELECT instance, round(avg(s), 3) AS avg_step_seconds FROM d GROUP BY instance""")
def _avg_step(t: Tables):
    return series.mean_time_step(t.obs(), "ts", ["instance"]).withColumn(
        "avg_step_seconds", F.round("avg_step_seconds", 3))


@query("lag_features", """
SELECT * FROM (SELECT event_id, well, lag(well, 1) OVER w AS well_lag1,
  lag(well, 2) OVER w AS well_lag2, lag(well, 3) OVER w AS well_lag3
  FROM obs WINDOW w AS (ORDER BY ts, event_id)) q
WHERE well_lag1 IS NOT NULL AND well_lag2 IS NOT NULL AND well_lag3 IS NOT NULL""")
def _lags(t: Tables):
    return series.lag_features(t.obs().select("event_id", "ts", "well"), "well", 3, [],
                               _ORDER).drop("ts")


@query("sequence_windows", """
WITH s AS (SELECT instance, event_id, class, count(*) OVER w AS n,
    first_value(coalesce(p_main, 0)) OVER w AS first_step, coalesce(p_main, 0) AS last_step,
    round(sum(coalesce(p_main, 0)) OVER w, 6) AS total
  FROM obs WINDOW w AS (PARTITION BY instance ORDER BY ts, event_id
    ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT instance, event_id, class, n AS steps, first_step, last_step, total FROM s WHERE n = 60""")
def _sequences(t: Tables):
    df = t.obs().select("event_id", "ts", "instance", "class",
                        F.coalesce("p_main", F.lit(0.0)).alias("p_main"), "valve_a")
    seqs = series.sequence_windows(df.fillna({"valve_a": 0.0}), ["p_main", "valve_a"], "class", 60,
                                   ["instance"], _ORDER)
    first = F.col("sequence")[0][0]
    total = F.aggregate("sequence", F.lit(0.0), lambda a, s: a + s[0])
    return seqs.select("instance", "event_id", "class",
                       F.size("sequence").cast("bigint").alias("steps"),
                       first.alias("first_step"),
                       F.element_at("sequence", -1)[0].alias("last_step"),
                       F.round(total, 6).alias("total"))


# Length and step of the stored windows, and windows of a batch.
_STRIDES, _BATCH = [(60, 1), (60, 7), (16, 5), (1, 3)], 256


@query("sequence_batches", " UNION ALL ".join(f"""
SELECT {n} AS length, {step} AS step, idx // {_BATCH} AS batch, CAST(idx % {_BATCH} AS INT) AS place,
  instance, event_id, class, steps, first_step, last_step, total FROM (
  SELECT *, row_number() OVER (ORDER BY instance, rn) - 1 AS idx FROM (
    SELECT instance, event_id, class, row_number() OVER o AS rn, count(*) OVER w AS steps,
      first_value(coalesce(p_main, 0)) OVER w AS first_step, coalesce(p_main, 0) AS last_step,
      round(sum(coalesce(p_main, 0)) OVER w, 6) AS total FROM obs
    WINDOW o AS (PARTITION BY instance ORDER BY ts, event_id), w AS (PARTITION BY instance
      ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)) r
  WHERE rn >= {n} AND (rn - {n}) % {step} = 0) q""" for n, step in _STRIDES))
def _batches(t: Tables):
    """Windows of several lengths and steps, written as blocks and read as numbered batches."""
    df = t.obs().select("event_id", "ts", "instance", "class",
                        F.coalesce("p_main", F.lit(0.0)).alias("p_main"), "valve_a")
    df, out = df.fillna({"valve_a": 0.0}), None
    for n, step in _STRIDES:
        path = scratch_path(t.spark, "batches")
        sequences.write_batches(df, path, ["p_main", "valve_a"], "class", ["instance"], _ORDER, n,
                                step, _BATCH, rows_per_block=100)
        total = F.aggregate("sequence", F.lit(0.0), lambda a, s: a + s[0])
        part = sequences.read_batches(t.spark, path).select(
            F.lit(n).alias("length"), F.lit(step).alias("step"), "batch", "place", "instance",
            "event_id", "class", F.size("sequence").cast("bigint").alias("steps"),
            F.col("sequence")[0][0].alias("first_step"),
            F.element_at("sequence", -1)[0].alias("last_step"), F.round(total, 6).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@query("impute_group_mean", """
SELECT event_id, well, class, round(coalesce(p_main, avg(p_main) OVER w), 6) AS p_main,
  round(coalesce(p_aux, avg(p_aux) OVER w), 6) AS p_aux
FROM obs WHERE class IS NOT NULL WINDOW w AS (PARTITION BY well, class)""")
def _group_mean(t: Tables):
    df = t.obs().na.drop(subset=["class"]).select("event_id", "well", "class", "p_main", "p_aux")
    return impute.impute_group_mean(df, ["p_main", "p_aux"], ["well", "class"]).withColumns(
        {c: F.round(c, 6) for c in ("p_main", "p_aux")})


@query("class_repair", """
WITH f AS (SELECT event_id, instance, label, state, class,
    last_value(class IGNORE NULLS) OVER (PARTITION BY instance ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen,
    count(class) OVER (PARTITION BY instance) AS n FROM obs)
SELECT event_id, instance, CAST(CASE WHEN class IS NOT NULL THEN class
  WHEN seen IS NULL AND n > 0 THEN 0
  WHEN state = 1 AND label IN (1, 2, 5, 6, 7, 8, 9) THEN 100 + label
  ELSE label END AS INT) AS class FROM f""")
def _repair(t: Tables):
    df = t.obs().select("event_id", "ts", "instance", "label", "state", "class")
    return impute.class_repair(df, ["instance"], _ORDER).select("event_id", "instance", "class")
