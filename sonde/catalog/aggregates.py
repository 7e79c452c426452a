"""Profiles: distinct and missing values, cross-tabulations, histograms, duplicates, intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonde.catalog.base import OBS_COLUMNS, Tables, query
from sonde.functions import col
from sonde.operators import profile, tables
from sonde.reference import SOURCES

_SENSORS = ["p_main", "p_aux", "p_sparse", "valve_a", "empty_a"]
_LABELS = list(range(10))


def _long_sql(expr: str, cols, keys: str = "", name: str = "v", where: str = "obs") -> str:
    """UNION ALL of one aggregate per column."""
    lead = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS \"Tag\", {expr.format(c=c)} AS {name} FROM {where}{group}"
        for c in cols)


_MISS = "round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 1)"
_DIST = "count(DISTINCT {c})"


@query("row_count", "SELECT count(*) AS n_rows, count(DISTINCT class) AS n_classes FROM obs")
def _rows(t: Tables):
    return t.obs().agg(F.count("*").alias("n_rows"), F.countDistinct("class").alias("n_classes"))


@query("unique_values_table", _long_sql(_DIST, OBS_COLUMNS, name="unique_values")
       + " UNION ALL SELECT 'not_there', count(*) * 0 FROM obs")
def _unique(t: Tables):
    df = t.obs()
    ref = t.spark.createDataFrame([(c,) for c in [*df.columns, "not_there"]], "Tag string")
    return profile.unique_values_table(ref, df, "unique_values", absent=0)


@query("missing_values_table", _long_sql(_MISS, OBS_COLUMNS, name="missing_pct")
       + " UNION ALL SELECT 'not_there', max(100.0::DOUBLE) FROM obs")
def _missing(t: Tables):
    df = t.obs()
    ref = t.spark.createDataFrame([(c,) for c in [*df.columns, "not_there"]], "Tag string")
    return profile.missing_values_table(ref, df, "missing_pct", absent=100.0)


def _pivot_sql(inner: str, keys: str, values, value: str) -> str:
    """Spread the ``label`` or source column of a long result."""
    column = keys
    cells = ", ".join(
        f"max(CASE WHEN {column} = {v!r} THEN {value} END) AS \"{n}\"" for v, n in values)
    return f"SELECT \"Tag\", {cells} FROM ({inner}) q GROUP BY \"Tag\""


@query("missing_by_label", _pivot_sql(_long_sql(_MISS, _SENSORS, "label", "pct"), "label",
                                      [(k, f"label_{k}") for k in _LABELS], "pct"))
def _missing_label(t: Tables):
    long = profile.missing_by(t.obs(), ["label"], _SENSORS)
    return profile.spread(long, ["Tag"], "label", _LABELS, "missing_pct", "label_")


@query("missing_by_instance", _long_sql(_MISS, _SENSORS, "label, well, instance", "missing_pct"))
def _missing_instance(t: Tables):
    return profile.missing_by(t.obs(), ["label", "well", "instance"], _SENSORS)


@query("missing_by_source", _pivot_sql(
    _long_sql(_MISS, _SENSORS, "data_type", "pct"), "data_type", [(s, s) for s in SOURCES], "pct"))
def _missing_source(t: Tables):
    long = profile.missing_by(t.obs(), ["data_type"], _SENSORS)
    return profile.spread(long, ["Tag"], "data_type", SOURCES, "missing_pct")


@query("all_null_columns", "SELECT data_type, \"Tag\" FROM ("
       + _long_sql(_MISS, _SENSORS, "data_type", "pct") + ") q WHERE pct = 100")
def _all_null(t: Tables):
    long = profile.missing_by(t.obs(), ["data_type"], _SENSORS, digits=None)
    return long.filter("missing_pct = 100").select("data_type", "Tag")


@query("unique_by_label", _pivot_sql(
    _long_sql(_DIST, [*_SENSORS, "class", "well"], "label", "n"), "label",
    [(k, f"label_{k}") for k in _LABELS], "n"))
def _unique_label(t: Tables):
    long = profile.distinct_by(t.obs(), ["label"], [*_SENSORS, "class", "well"])
    return profile.spread(long, ["Tag"], "label", _LABELS, "unique_values", "label_")


@query("value_type_table", "SELECT \"Tag\", unique_values, CASE WHEN unique_values = 0 THEN 'Empty' "
       "WHEN unique_values <= 3 THEN 'Categorical' "
       "WHEN \"Tag\" IN ('label', 'class', 'state') THEN 'Classifier' "
       "WHEN \"Tag\" IN ('well', 'id', 'instance') THEN 'Identifier' "
       "WHEN \"Tag\" = 'data_type' THEN 'Dataset' WHEN \"Tag\" = 'ts' THEN 'Timestamp' "
       "ELSE 'Continuous' END AS value_type FROM ("
       + _long_sql(_DIST, OBS_COLUMNS, name="unique_values") + ") q")
def _types(t: Tables):
    return profile.value_type_table(t.obs())


@query("instances_by_label", """
SELECT label, count(DISTINCT instance) AS n_instances FROM obs GROUP BY label""")
def _by_label(t: Tables):
    return t.obs().groupBy("label").agg(F.countDistinct("instance").alias("n_instances"))


@query("well_frequency", """
SELECT well, count(DISTINCT instance) AS n_instances FROM obs GROUP BY well
ORDER BY n_instances DESC, well""")
def _wells(t: Tables):
    return t.obs().groupBy("well").agg(F.countDistinct("instance").alias("n_instances")).orderBy(
        F.col("n_instances").desc(), "well")


@query("compare_identifiers", """
SELECT label, count(DISTINCT instance) AS instance, count(DISTINCT id) AS id,
  count(DISTINCT well) AS well FROM obs GROUP BY label""")
def _identifiers(t: Tables):
    return profile.compare_identifiers(t.obs(), "label", ["instance", "id", "well"])


@query("compare_identifiers_delta", """
WITH c AS (SELECT coalesce(CAST(class AS VARCHAR), 'Unknown') AS class,
  count(DISTINCT instance) AS instance, count(DISTINCT well) AS well FROM obs GROUP BY 1)
SELECT class, instance, well, instance - well AS "Delta" FROM c UNION ALL
SELECT 'Grand Total', CAST(sum(instance) AS BIGINT), CAST(sum(well) AS BIGINT),
  CAST(sum(instance - well) AS BIGINT) FROM c""")
def _delta(t: Tables):
    return profile.identifier_delta(t.obs(), "class", "instance", "well")


def _cross_sql(row: str, column: str, values, within: str = "", totals: bool = False) -> str:
    lead = f"coalesce(CAST({within} AS VARCHAR), 'Unknown') AS {within}, " if within else ""
    cells = (f"SELECT {lead}coalesce(CAST({row} AS VARCHAR), 'Unknown') AS r, "
             f"coalesce(CAST({column} AS VARCHAR), 'Unknown') AS c, "
             f"count(DISTINCT instance) AS n FROM obs GROUP BY ALL")
    sums = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN c = '{v}' THEN n END), 0) AS BIGINT) AS \"{v}\""
        for v in values)
    if not totals:
        by = f"{within}, r" if within else "r"
        return f"SELECT {by} AS {row}, {sums} FROM ({cells}) q GROUP BY {by}"
    total = "CAST(sum(n) AS BIGINT) AS \"Row Total\""
    return (f"SELECT CASE WHEN grouping(r) = 1 THEN 'Grand Total' ELSE r END AS {row}, {sums}, "
            f"{total} FROM ({cells}) q GROUP BY ROLLUP (r)")


_STATES = ["0", "1", "Unknown"]


@query("crosstab_distinct", _cross_sql("well", "label", [str(k) for k in _LABELS]))
def _crosstab(t: Tables):
    return profile.crosstab_distinct(t.obs(), "well", "label", "instance",
                                     [str(k) for k in _LABELS])


@query("crosstab_by_label", _cross_sql("class", "state", _STATES, within="label"))
def _crosstab_label(t: Tables):
    return profile.crosstab_distinct(t.obs(), "class", "state", "instance", _STATES,
                                     within=["label"])


@query("crosstab_totals", _cross_sql("class", "state", _STATES, totals=True))
def _crosstab_totals(t: Tables):
    return profile.crosstab_distinct(t.obs(), "class", "state", "instance", _STATES, totals=True)


@query("crosstab_other", """
WITH cells AS (SELECT coalesce(CAST(class AS VARCHAR), 'Unknown') AS r,
  coalesce(CAST(state AS VARCHAR), 'Unknown') AS c, count(DISTINCT instance) AS n
  FROM obs GROUP BY ALL)
SELECT CASE WHEN grouping(r) = 1 THEN 'Grand Total' ELSE r END AS class,
  CAST(coalesce(sum(n) FILTER (WHERE c = '1'), 0) AS BIGINT) AS "1",
  CAST(coalesce(sum(n) FILTER (WHERE c <> '1'), 0) AS BIGINT) AS "Other",
  CAST(sum(n) AS BIGINT) AS "Row Total" FROM cells GROUP BY ROLLUP (r)""")
def _crosstab_other(t: Tables):
    return profile.crosstab_distinct(t.obs(), "class", "state", "instance", ["1"], totals=True,
                                     other="Other")


@query("crosstab_found", _cross_sql("class", "state", _STATES, totals=True))
def _crosstab_found(t: Tables):
    return profile.crosstab_distinct(t.obs(), "class", "state", "instance", totals=True)


@query("unique_by_source", _cross_sql("label", "data_type", SOURCES, totals=True))
def _unique_source(t: Tables):
    return profile.crosstab_distinct(t.obs(), "label", "data_type", "instance", SOURCES,
                                     totals=True)


@query("value_counts", "SELECT class, count(*) AS n FROM obs GROUP BY class")
def _counts(t: Tables):
    return profile.value_counts(t.obs(), "class")


@query("class_distribution", """
SELECT class, count(*) AS n, round(count(*) * 1.0::DOUBLE / sum(count(*)) OVER (), 9) AS share
FROM obs GROUP BY class""")
def _distribution(t: Tables):
    return profile.class_distribution(t.obs(), "class").withColumn("share", F.round("share", 9))


@query("value_counts_by_source", """
SELECT class, count(*) FILTER (WHERE data_type = 'Real') AS "Real",
  count(*) FILTER (WHERE data_type = 'Simulated') AS "Simulated",
  count(*) FILTER (WHERE data_type = 'Drawn') AS "Drawn", count(*) AS "Total"
FROM obs GROUP BY class""")
def _counts_source(t: Tables):
    return profile.value_counts_by_source(t.obs(), "class", "data_type", SOURCES)


@query("label_hist_by_id", """
WITH per AS (
  SELECT data_type, well, round(avg(label), 6) AS mean_label FROM obs WHERE data_type = 'Real'
  GROUP BY data_type, well UNION ALL
  SELECT data_type, well, round(avg(label), 6) FROM obs WHERE data_type <> 'Real'
  GROUP BY data_type, well, label)
SELECT data_type, mean_label, count(*) AS n FROM per GROUP BY data_type, mean_label""")
def _label_hist(t: Tables):
    return profile.label_hist_by_id(t.obs(), "data_type", "well", "label", "Real")


@query("source_share", """
WITH c AS (SELECT data_type, count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM obs
  GROUP BY data_type)
SELECT data_type, n_rows, n_ids,
  round(n_rows * 100.0::DOUBLE / (SELECT sum(n_rows) FROM c), 0) AS row_pct,
  round(n_ids * 100.0::DOUBLE / (SELECT sum(n_ids) FROM c), 0) AS id_pct FROM c""")
def _share(t: Tables):
    return profile.source_share(t.obs(), "data_type", "id")


@query("data_overview", """
SELECT count(*) AS n_rows, CAST(14 AS BIGINT) AS n_columns, CAST(4 AS BIGINT) AS n_other,
  CAST(10 AS BIGINT) AS n_numeric, count(DISTINCT id) AS n_ids FROM obs""")
def _overview(t: Tables):
    return profile.data_overview(t.obs(), "id")


_NUMERIC = ["p_main", "p_aux", "p_sparse", "valve_a", "empty_a", "class"]


@query("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS \"Tag\", count({c}) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, "
    f"round(CAST(max({c}) AS DOUBLE), 6) AS max FROM obs" for c in _NUMERIC))
def _describe(t: Tables):
    return profile.describe_numeric(t.obs(), _NUMERIC)


@query("histogram_bins", """
WITH long AS (SELECT data_type, 'p_main' AS "Tag", p_main AS v FROM obs
  UNION ALL SELECT data_type, 'p_aux', p_aux FROM obs),
r AS (SELECT data_type, "Tag", min(v) AS lo, max(v) AS hi FROM long GROUP BY ALL)
SELECT data_type, "Tag", CAST(least(floor((v - lo) / ((hi - lo) / 30.0::DOUBLE)), 29) AS BIGINT)
  AS bin, count(*) AS n
FROM long JOIN r USING (data_type, "Tag") WHERE v IS NOT NULL GROUP BY ALL""")
def _histogram(t: Tables):
    return profile.histogram_bins(t.obs(), ["p_main", "p_aux"], "data_type", 30)


@query("duplicate_count", """
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates FROM (
  SELECT count(*) AS c FROM lineitem
  GROUP BY l_returnflag, l_linestatus, l_quantity, l_discount) q""")
def _duplicates(t: Tables):
    return profile.duplicate_count(t.table("lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


@query("duplicate_count_excl", """
SELECT data_type, CAST(sum(c - 1) AS BIGINT) AS duplicates FROM (
  SELECT data_type, count(*) AS c FROM obs GROUP BY data_type, label, well, valve_a, state, class) q
GROUP BY data_type""")
def _duplicates_excl(t: Tables):
    df = t.obs().select("id", "data_type", "label", "well", "valve_a", "state", "class")
    return profile.duplicate_count(df, exclude=["id"], by=["data_type"])


@query("duplicate_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, l_linestatus
FROM lineitem QUALIFY count(*) OVER (
  PARTITION BY l_partkey, l_quantity, l_returnflag, l_linestatus) > 1""")
def _duplicate_rows(t: Tables):
    df = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                    "l_returnflag", "l_linestatus")
    return profile.duplicate_rows(df, exclude=["l_orderkey", "l_linenumber"])


@query("instance_intervals", """
SELECT instance, min(ts) AS start_ts, max(ts) AS end_ts,
  round(date_diff('microsecond', min(ts), max(ts)) / 3.6e9, 6) AS hours, year(min(ts)) AS year
FROM obs GROUP BY instance""")
def _intervals(t: Tables):
    return profile.instance_intervals(t.obs(), "instance", "ts").withColumn(
        "hours", F.round("hours", 6))


@query("instance_positions", """
SELECT instance, start_ts, row_number() OVER (ORDER BY start_ts, instance) - 1 AS position
FROM (SELECT instance, min(ts) AS start_ts FROM obs GROUP BY instance) q""")
def _positions(t: Tables):
    return profile.instance_positions(t.obs(), "instance", "ts")


@query("interval_by_id_label", """
SELECT well, label, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n,
  count(*) FILTER (WHERE class = 0) AS n_normal, count(*) FILTER (WHERE class > 100) AS n_transient
FROM obs GROUP BY well, label""")
def _intervals_label(t: Tables):
    klass = F.col("class")
    return t.obs().groupBy("well", "label").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n"),
        F.count(F.when(klass == 0, 1)).alias("n_normal"),
        F.count(F.when(klass > 100, 1)).alias("n_transient"))


@query("null_audit", " UNION ALL ".join(
    f"SELECT '{c}' AS \"Tag\", count(*) AS n_null, "
    "array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, "
    f"array_to_string(list_sort(list(DISTINCT well)), ',') AS wells FROM obs WHERE {c} IS NULL"
    for c in ("p_main", "p_aux", "valve_a", "class")))
def _audit(t: Tables):
    return profile.null_audit(t.obs(), ["p_main", "p_aux", "valve_a", "class"], "label", "well")


@query("null_counts", _long_sql("count(*) - count({c})", OBS_COLUMNS, name="n_null"))
def _null_counts(t: Tables):
    df = t.obs()
    return profile.null_counts(df, df.columns)


@query("retention_report", """
WITH whole AS (SELECT instance FROM obs GROUP BY instance
  HAVING count(p_main) > 0 AND count(p_aux) > 0),
kept AS (SELECT * FROM obs SEMI JOIN whole USING (instance))
SELECT 'before' AS stage, count(DISTINCT instance) AS n_ids,
  count(DISTINCT CASE WHEN class IS NULL THEN instance END) AS n_null_class FROM obs UNION ALL
SELECT 'after', count(DISTINCT instance),
  count(DISTINCT CASE WHEN class IS NULL THEN instance END) FROM kept""")
def _retention(t: Tables):
    df = t.obs()
    kept = tables.drop_incomplete_instances(df, "instance", ["p_main", "p_aux"])
    return profile.retention_report(df, kept, "instance", "class")


@query("importance_pivot", """
WITH per AS (
  SELECT label, 'p_main' AS feature, var_pop(p_main) AS v FROM obs GROUP BY label UNION ALL
  SELECT label, 'p_aux', var_pop(p_aux) FROM obs GROUP BY label UNION ALL
  SELECT label, 'valve_a', var_pop(valve_a) FROM obs WHERE label > 2 GROUP BY label)
SELECT feature, """ + ", ".join(
    f"coalesce(round(max(CASE WHEN label = {k} THEN v END), 4), 0) AS label_{k}" for k in _LABELS)
    + " FROM per GROUP BY feature")
def _importance_pivot(t: Tables):
    df = t.obs()
    # Spread of each sensor by label, shown the way importances by label are.
    wide = df.groupBy("label").agg(
        F.var_pop("p_main").alias("p_main"), F.var_pop("p_aux").alias("p_aux"),
        F.var_pop(F.when(F.col("label") > 2, F.col("valve_a"))).alias("valve_a"))
    long = wide.unpivot(["label"], [col(c) for c in ("p_main", "p_aux", "valve_a")], "feature",
                        "importance").withColumn("importance", F.round("importance", 4))
    return profile.spread(long, ["feature"], "label", _LABELS, "importance", "label_", fill=0.0)
