"""Imputation and the cleaning chains."""

from __future__ import annotations

from pyspark.ml.feature import Imputer as MlImputer
from pyspark.sql import functions as F

from sonde.catalog.base import EVENT_CLASS_LIST, MULTI_SQL, Tables, query
from sonde.functions import multiclass_target
from sonde.operators import impute
from sonde.plans import cleaning

LAYOUT = cleaning.Layout(series="instance", order=("ts", "event_id"))
CONTINUOUS = ["p_main", "p_aux", "p_sparse"]
CATEGORICAL = ["valve_a"]


def _last(c: str, by: str = "instance") -> str:
    return (f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY ts, event_id "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def _filled(c: str, by: str = "instance") -> str:
    return (f"coalesce({_last(c, by)}, first_value({c} IGNORE NULLS) OVER (PARTITION BY {by} "
            "ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) "
            f"AS {c}")


_SENSORS = [*CONTINUOUS, *CATEGORICAL]
_FILLED_SQL = ("SELECT event_id, ts, instance, label, well, id, data_type, state, class, "
               + ", ".join(_filled(c) for c in _SENSORS) + " FROM obs")


@query("clean_instances", "SELECT event_id, instance, "
       + ", ".join(_SENSORS) + f" FROM ({_FILLED_SQL}) q")
def _clean(t: Tables):
    return cleaning.clean_instances(t.obs(), ["empty_a"], _SENSORS, LAYOUT).select(
        "event_id", "instance", *_SENSORS)


@query("multiclass_target", f"SELECT event_id, class, {MULTI_SQL} AS target FROM obs")
def _multi(t: Tables):
    return t.obs().select("event_id", "class", multiclass_target(F.col("class")).alias("target"))


@query("impute_mean", "SELECT event_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM obs)), 6) AS {c}" for c in CONTINUOUS)
    + ", empty_a FROM obs")
def _mean(t: Tables):
    df = t.obs().select("event_id", *CONTINUOUS, "empty_a")
    done = impute.fit_continuous(df, [*CONTINUOUS, "empty_a"], "mean").transform(df)
    return done.withColumns({c: F.round(c, 6) for c in CONTINUOUS})


@query("impute_median", "SELECT event_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT median({c}) FROM obs)), 6) AS {c}" for c in CONTINUOUS)
    + ", empty_a FROM obs")
def _median(t: Tables):
    df = t.obs().select("event_id", *CONTINUOUS, "empty_a")
    done = impute.fit_continuous(df, [*CONTINUOUS, "empty_a"], "median", exact=True).transform(df)
    return done.withColumns({c: F.round(c, 6) for c in CONTINUOUS})


def _mode(c: str) -> str:
    return (f"coalesce({c}, (SELECT {c} FROM obs WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}")


@query("impute_mode", f"SELECT event_id, {_mode('valve_a')}, {_mode('state')} FROM obs")
def _modes(t: Tables):
    df = t.obs().select("event_id", "valve_a", "state")
    return impute.fit_categorical(df, ["valve_a", "state"]).transform(df)


@query("imputer_ml", "SELECT event_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM obs)), 6) AS {c}_imputed" for c in CONTINUOUS)
    + " FROM obs")
def _imputer(t: Tables):
    df = t.obs().select("event_id", *CONTINUOUS)
    out = [f"{c}_imputed" for c in CONTINUOUS]
    model = MlImputer(inputCols=CONTINUOUS, outputCols=out, strategy="mean").fit(df)
    return model.transform(df).select("event_id", *[F.round(c, 6).alias(c) for c in out])


# Union of the three sources, composite id, fill by id, drop of sparse columns and series, repair.
@query("clean_chain_1", f"""
WITH named AS (SELECT o.* REPLACE (CASE data_type WHEN 'Real' THEN id
    WHEN 'Simulated' THEN 'SIMULATED - ' || id || ' - ' || label
    ELSE 'DRAWN - ' || id || ' - ' || label END AS id) FROM obs o),
filled AS (SELECT event_id, ts, id, label, state, class, {_filled('p_main', 'id')},
  {_filled('p_aux', 'id')}, {_filled('valve_a', 'id')} FROM named),
whole AS (SELECT id FROM filled GROUP BY id
  HAVING count(p_main) > 0 AND count(p_aux) > 0 AND count(valve_a) > 0),
marked AS (SELECT *, {_last('class', 'id')} AS seen, count(class) OVER (PARTITION BY id) AS n
  FROM filled SEMI JOIN whole USING (id))
SELECT event_id, id, label, p_main, p_aux, valve_a, CAST(CASE WHEN class IS NOT NULL THEN class
  WHEN seen IS NULL AND n > 0 THEN 0
  WHEN state = 1 AND label IN (1, 2, 5, 6, 7, 8, 9) THEN 100 + label ELSE label END AS INT) AS class
FROM marked""")
def _chain_1(t: Tables):
    df = t.obs().withColumn("well", F.expr(
        "CASE data_type WHEN 'Real' THEN well WHEN 'Simulated' THEN 'SIMULATED' ELSE 'DRAWN' END"))
    kept = df.select("event_id", "ts", "id", "label", "well", "state", "class", "data_type",
                     "p_main", "p_aux", "valve_a", "empty_a")
    parts = [kept.filter(F.col("data_type") == s).drop("data_type")
             for s in ("Real", "Simulated", "Drawn")]
    return cleaning.clean_whole_series(parts, ["p_main", "p_aux", "valve_a"], LAYOUT).select(
        "event_id", "id", "label", "p_main", "p_aux", "valve_a", "class")


def _imputed(c: str) -> str:
    if c in CONTINUOUS:
        return f"round(coalesce({c}, (SELECT avg({c}) FROM filled)), 6) AS {c}"
    return _mode(c).replace("FROM obs", "FROM filled")


# Fill by instance, target, missing flags, then mean and mode.
@query("clean_chain_2", f"""
WITH filled AS ({_FILLED_SQL})
SELECT event_id, instance, label, well, id, data_type, state, class,
  CAST(CASE WHEN class IN {EVENT_CLASS_LIST} THEN 1 ELSE 0 END AS INT) AS target, """
       + ", ".join(f"CAST(f.{c} IS NULL AS INT) AS {c}_missing" for c in _SENSORS) + ", "
       + ", ".join(_imputed(c) for c in _SENSORS) + " FROM filled f")
def _chain_2(t: Tables):
    done = cleaning.clean_and_impute(t.obs(), ["empty_a"], CONTINUOUS, CATEGORICAL, LAYOUT)
    return done.withColumns({c: F.round(c, 6) for c in CONTINUOUS}).drop("ts")
