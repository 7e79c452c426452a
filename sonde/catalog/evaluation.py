"""Evaluation tables over predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonde.catalog.base import Tables, query
from sonde.cluster import scratch_path
from sonde.operators import evaluate
from sonde.sources import append_metrics, scan_parquet

_FOUR = ("SELECT count(*) FILTER (WHERE y01 = 1 AND yhat01 = 1) AS tp, "
         "count(*) FILTER (WHERE y01 = 0 AND yhat01 = 0) AS tn, "
         "count(*) FILTER (WHERE y01 = 0 AND yhat01 = 1) AS fp, "
         "count(*) FILTER (WHERE y01 = 1 AND yhat01 = 0) AS fn FROM preds")
_RATES = (f"SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM (SELECT *, "
          f"tp::DOUBLE / greatest(tp + fp, 1) AS p, tp::DOUBLE / greatest(tp + fn, 1) AS r "
          f"FROM ({_FOUR}) a) b")
_PER = """SELECT klass, support, predicted, hits,
  CASE WHEN predicted > 0 THEN hits::DOUBLE / predicted ELSE 0 END AS p,
  CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0 END AS r,
  CASE WHEN hits > 0 THEN 2.0::DOUBLE * hits / (support + predicted) ELSE 0 END AS f
FROM (SELECT klass, CAST(sum(s) AS BIGINT) AS support, CAST(sum(g) AS BIGINT) AS predicted,
    CAST(sum(h) AS BIGINT) AS hits FROM (
  SELECT y AS klass, 1 AS s, 0 AS g, CAST(y = yhat AS INT) AS h FROM preds UNION ALL
  SELECT yhat, 0, 1, 0 FROM preds) u GROUP BY klass) v"""


def _rounded(df, names, digits=9):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("confusion_matrix", "SELECT y, yhat, count(*) AS n FROM preds GROUP BY y, yhat")
def _confusion(t: Tables):
    return evaluate.confusion_matrix(t.preds(), "y", "yhat")


@query("binary_confusion", _FOUR)
def _four(t: Tables):
    return evaluate.binary_confusion(t.preds(), "y01", "yhat01")


@query("binary_metrics", f"SELECT tp, tn, fp, fn, round(p, 9) AS precision, round(r, 9) AS recall, "
       f"round(f, 9) AS f1 FROM ({_RATES}) q")
def _binary(t: Tables):
    return _rounded(evaluate.binary_metrics(t.preds(), "y01", "yhat01"),
                    ["precision", "recall", "f1"])


@query("multiclass_metrics", f"""
SELECT round(sum(hits)::DOUBLE / sum(support), 9) AS accuracy,
  round(sum(p * support) / sum(support), 9) AS weighted_precision,
  round(sum(r * support) / sum(support), 9) AS weighted_recall,
  round(sum(f * support) / sum(support), 9) AS weighted_f1 FROM ({_PER}) q""")
def _multi(t: Tables):
    df = evaluate.multiclass_metrics(t.preds(), "y", "yhat")
    return _rounded(df, df.columns)


@query("classification_report", f"""
WITH per AS ({_PER})
SELECT CAST(klass AS VARCHAR) AS class, round(p, 9) AS precision, round(r, 9) AS recall,
  round(f, 9) AS f1, support FROM per UNION ALL
SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9),
  CAST(sum(support) AS BIGINT) FROM per UNION ALL
SELECT 'weighted avg', round(sum(p * support) / sum(support), 9),
  round(sum(r * support) / sum(support), 9), round(sum(f * support) / sum(support), 9),
  CAST(sum(support) AS BIGINT) FROM per""")
def _report(t: Tables):
    return _rounded(evaluate.classification_report(t.preds(), "y", "yhat"),
                    ["precision", "recall", "f1"])


@query("accuracy_by_group", """
SELECT well, round(avg(CASE WHEN y = yhat THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy,
  count(*) AS n FROM preds GROUP BY well""")
def _by_well(t: Tables):
    return _rounded(evaluate.accuracy_by_group(t.preds(), "well", "y", "yhat"), ["accuracy"])


@query("auc_roc", """
WITH r AS (SELECT y01, rank() OVER (ORDER BY score)
    + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS mean_rank FROM preds)
SELECT round((sum(mean_rank) FILTER (WHERE y01 = 1) - p * (p + 1) / 2) / (p * n), 9) AS auc_roc
FROM r, (SELECT count(*) FILTER (WHERE y01 = 1)::DOUBLE AS p,
  count(*) FILTER (WHERE y01 = 0)::DOUBLE AS n FROM preds) c GROUP BY p, n""")
def _roc(t: Tables):
    return _rounded(evaluate.auc_roc(t.preds(), "y01", "score"), ["auc_roc"])


@query("auc_pr", """
WITH s AS (SELECT score, sum(y01) AS pos, count(*) AS n FROM preds GROUP BY score),
c AS (SELECT score, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM s
  WINDOW w AS (ORDER BY score DESC)),
d AS (SELECT pos, tp::DOUBLE / seen AS here, lag(tp::DOUBLE / seen) OVER (ORDER BY seen) AS back
  FROM c)
SELECT round(sum(pos * (here + coalesce(back, here)) / 2) / sum(pos), 9) AS auc_pr FROM d""")
def _pr(t: Tables):
    return _rounded(evaluate.auc_pr(t.preds(), "y01", "score"), ["auc_pr"])


def _probs(a: int, b: int, c: int) -> str:
    x, y, z = (f"(1 + event_id % {m})" for m in (a, b, c))
    total = f"({x} + {y} + {z})"
    return ", ".join(f"CAST({v} AS DOUBLE) / CAST({total} AS DOUBLE)" for v in (x, y, z))


_VOTERS = [(5, 7, 11), (11, 5, 7), (7, 11, 5)]


@query("soft_vote", "WITH v AS (SELECT event_id, " + ", ".join(
    f"[{_probs(*m)}] AS m{i}" for i, m in enumerate(_VOTERS)) + """ FROM obs),
p AS (SELECT event_id, """ + ", ".join(
    f"(m0[{k}] + m1[{k}] + m2[{k}]) / 3.0::DOUBLE AS p{k}" for k in (1, 2, 3)) + """ FROM v)
SELECT event_id, round(greatest(p1, p2, p3), 9) AS top, CAST(CASE WHEN p1 >= p2 AND p1 >= p3 THEN 0
  WHEN p2 >= p3 THEN 1 ELSE 2 END AS BIGINT) AS vote FROM p""")
def _vote(t: Tables):
    df = t.obs().selectExpr("event_id", *[
        f"array({_probs(*m)}) AS m{i}" for i, m in enumerate(_VOTERS)])
    voted = evaluate.soft_vote(df, ["m0", "m1", "m2"])
    return voted.select("event_id", F.round(F.array_max("mean_probability"), 9).alias("top"),
                        F.col("vote").cast("bigint").alias("vote"))


@query("metrics_log", f"""
SELECT 'run-a' AS run, 'metric' AS kind, key, round(value, 9) AS value FROM ({_RATES}) q
UNPIVOT (value FOR key IN (p, r, f)) UNION ALL
SELECT 'run-a', 'param', 'rows', count(*)::DOUBLE FROM preds""")
def _log(t: Tables):
    path = scratch_path(t.spark, "metrics")
    row = evaluate.binary_metrics(t.preds(), "y01", "yhat01").first()  # one row of metrics
    append_metrics(t.spark, path, "run-a", "metric",
                   {"p": row["precision"], "r": row["recall"], "f": row["f1"]})
    append_metrics(t.spark, path, "run-a", "param", {"rows": t.preds().count()})
    return _rounded(scan_parquet(t.spark, path), ["value"])
