"""Scans, sinks, projections, filters, joins, set operations and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonde.catalog.base import OBS_COLUMNS, Tables, query
from sonde.cluster import checkpointed, scratch_path, staged
from sonde.functions import (binary_target, col, composite_id, lookup, normal_flag)
from sonde.operators import manifest, profile, tables
from sonde.reference import EVENTS, SOURCES
from sonde.sources import (
    literal_table, load_instances, read_partitions, scan_csv, scan_parquet, write_csv,
    write_parquet, write_partitioned)

# ---- scans and sinks


@query("scan_parquet", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _scan(t: Tables):
    return scan_parquet(t.spark, f"{t.folder}/events.parquet",
                        t.table("events").schema)


@query("csv_roundtrip", """
SELECT * FROM orders""")
def _csv(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    kept = t.table("orders")
    write_csv(kept, path)
    return scan_csv(t.spark, path, kept.schema)


@query("parquet_roundtrip", "SELECT event_id, p_main, valve_a, class FROM obs")
def _parquet(t: Tables):
    path = scratch_path(t.spark, "obs")
    kept = t.obs().select("event_id", "p_main", "valve_a", "class")
    write_parquet(kept, path)
    return scan_parquet(t.spark, path, kept.schema)


@query("partitioned_roundtrip", """
SELECT label, instance, count(*) AS n, round(sum(p_main), 6) AS total FROM obs
GROUP BY label, instance""")
def _partitioned(t: Tables):
    path = scratch_path(t.spark, "obs-by-label")
    kept = t.obs().select("event_id", "p_main", "instance", "label")
    write_partitioned(kept, path, ["label"])
    return scan_parquet(t.spark, path, kept.schema).groupBy("label", "instance").agg(
        F.count("*").alias("n"), F.round(F.sum("p_main"), 6).alias("total"))


@query("partial_reprocess", """
SELECT label, round(sum(CASE WHEN label IN (3, 7) THEN p_main * 10 ELSE p_main END), 4) AS total
FROM obs GROUP BY label""")
def _partial(t: Tables):
    path = scratch_path(t.spark, "obs-rework")
    kept = t.obs().select("event_id", "p_main", "label")
    write_partitioned(kept, path, ["label"])
    stored = scan_parquet(t.spark, path, kept.schema)
    # The rework is stored apart before it replaces the folders that it was read from.
    again = staged(read_partitions(stored, "label", [3, 7])
                   .withColumn("p_main", F.col("p_main") * 10), "rework")
    write_partitioned(again, path, ["label"], only_touched=True)
    t.spark.catalog.refreshByPath(path)
    stored = scan_parquet(t.spark, path, kept.schema)
    return stored.groupBy("label").agg(F.round(F.sum("p_main"), 4).alias("total"))


# A later state of the source: one label changed, one lost a row, one is gone and one is new.
_LATER = ["event_id", "instance", "CASE WHEN label = 3 AND event_id % 50 = 0 THEN instance + 1 "
          "ELSE instance END AS seen", "well",
          "CAST(CASE WHEN label = 8 THEN 18 ELSE label END AS INT) AS label"]
_FIRST_OF_5 = "event_id = (SELECT min(event_id) FROM obs WHERE label = 5)"


def _before(t: Tables):
    return t.obs().select("event_id", "instance", F.col("instance").alias("seen"), "well", "label")


def _later(t: Tables):
    first = t.obs().filter("label = 5").agg(F.min("event_id")).scalar()
    return t.obs().filter(~F.coalesce(F.col("event_id") == first, F.lit(False))).selectExpr(*_LATER)


def _files(t: Tables, path: str):
    named = t.spark.read.parquet(path).select("label", F.input_file_name().alias("file")).distinct()
    return named.groupBy("label").agg(F.sort_array(F.collect_list("file")).alias("files"))


@query("stale_partitions", """
SELECT DISTINCT CAST(label AS VARCHAR) AS label, CASE label WHEN 8 THEN 'gone' ELSE 'changed' END AS reason
FROM obs WHERE label = 8 OR (label = 3 AND event_id % 50 = 0) OR label = 5
UNION SELECT '18', 'new' FROM obs WHERE label = 8""")
def _stale(t: Tables):
    """Labels whose rows are not those that their folder was written from."""
    path = scratch_path(t.spark, "recorded")
    manifest.write_recorded(_before(t), path, ["label"])
    return manifest.stale_partitions(_later(t), path, ["label"])


@query("rework_stale", f"""
WITH later AS (SELECT {", ".join(_LATER)}, label AS old FROM obs WHERE NOT {_FIRST_OF_5})
SELECT label, count(*) AS n, sum(seen)::BIGINT AS seen, label IN (5, 18) OR label IN
  (SELECT label FROM obs WHERE label = 3 AND event_id % 50 = 0) AS written
FROM later GROUP BY label
UNION ALL SELECT 8, count(*), sum(instance)::BIGINT, false FROM obs WHERE label = 8 HAVING count(*) > 0""")
def _rework(t: Tables):
    """After the rework the folders hold the later rows, and the others still their old files."""
    path = scratch_path(t.spark, "recorded")
    manifest.write_recorded(_before(t), path, ["label"])
    old = checkpointed(_files(t, path))
    manifest.rework_stale(_later(t), path, ["label"])
    new = _files(t, path).withColumnRenamed("files", "now")
    written = lookup(new, old, ["label"]).select(
        "label", (~F.col("files").eqNullSafe(F.col("now"))).alias("written"))
    held = t.spark.read.parquet(path).groupBy("label").agg(
        F.count("*").alias("n"), F.sum("seen").alias("seen"))
    return held.join(written, "label").select("label", "n", "seen", "written")


@query("load_instances", """
WITH listed AS (
  SELECT data_type, label, well,
    CASE data_type WHEN 'Real' THEN 1 WHEN 'Simulated' THEN 2 ELSE 3 END AS place
  FROM obs GROUP BY data_type, label, well),
numbered AS (
  SELECT data_type, label, well, row_number() OVER (ORDER BY place, label, well) - 1 AS n
  FROM listed)
SELECT o.data_type AS "DataType", n AS "Instance", count(*) AS n_rows,
  round(sum(p_main), 4) AS total
FROM obs o JOIN numbered m USING (data_type, label, well) GROUP BY o.data_type, n""")
def _load(t: Tables):
    root = scratch_path(t.spark, "instances")
    kept = t.obs().select("event_id", "p_main", "data_type", "label", "well")
    # One folder per recording, of several part files.
    kept.repartition(3, "event_id").write.partitionBy("data_type", "label", "well").parquet(root)
    body = kept.select("event_id", "p_main").schema
    loaded = load_instances(t.spark, {s: f"{root}/data_type={s}" for s in SOURCES}, body)
    return loaded.groupBy("DataType", "Instance").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("p_main"), 4).alias("total"))


@query("literal_event_table", """
WITH names(label, description) AS (VALUES """ + ", ".join(f"({k}, '{v}')" for k, v in EVENTS) + """)
SELECT n.label, n.description, count(o.event_id) AS n
FROM names n LEFT JOIN obs o ON n.label = o.label GROUP BY n.label, n.description""")
def _events(t: Tables):
    names = literal_table(t.spark, EVENTS, "label int, description string")
    counts = t.obs().groupBy("label").agg(F.count("*").alias("n"))
    return lookup(names, counts, ["label"]).withColumn("n", F.coalesce("n", F.lit(0)))


# ---- projections


@query("project_reorder", "SELECT class, label AS event_label, p_main, ts, event_id FROM obs")
def _project(t: Tables):
    return t.obs().withColumnRenamed("label", "event_label").select(
        "class", "event_label", "p_main", "ts", "event_id")


@query("drop_columns", """
SELECT event_id, instance, label, well, id, data_type, p_main, p_aux, valve_a, class FROM obs""")
def _drop(t: Tables):
    return t.obs().drop("ts", "p_sparse", "empty_a", "state")


_NOT_FEATURES = ["event_id", "ts", "instance", "label", "well", "id", "data_type", "state", "class"]


@query("feature_columns", "SELECT p_main, p_aux, p_sparse, valve_a, empty_a FROM obs")
def _features(t: Tables):
    df = t.obs()
    return df.select(*tables.feature_columns(df, _NOT_FEATURES))


@query("columns_by_type", "SELECT p_aux, p_main, p_sparse, valve_a FROM obs")
def _by_type(t: Tables):
    df = t.obs()
    typed = profile.value_type_table(df)
    kinds = tables.columns_by_type(typed, ["Continuous", "Categorical"],
                                   skip=("data_type", "state", "event_id"))
    return df.select(*kinds)


@query("binary_target", """
SELECT event_id, class, CAST(CASE WHEN class IN (3, 4, 101, 102, 105, 106, 107, 108, 109) THEN 1
  ELSE 0 END AS INT) AS target FROM obs""")
def _binary(t: Tables):
    return t.obs().select("event_id", "class", binary_target(F.col("class")).alias("target"))


@query("normal_flag", """
SELECT event_id, CAST(CASE WHEN class = 0 THEN 1 ELSE 0 END AS INT) AS is_normal,
  class <> 0 AS target FROM obs""")
def _normal(t: Tables):
    return t.obs().select("event_id", normal_flag(F.col("class")).alias("is_normal"),
                          (F.col("class") != 0).alias("target"))


@query("missing_flags", "SELECT event_id, " + ", ".join(
    f"p.{c}, CAST(p.{c} IS NULL AS INT) AS {c}_missing"
    for c in ("p_main", "p_aux", "p_sparse", "valve_a")) + " FROM obs p")
def _flags(t: Tables):
    cols = ["p_main", "p_aux", "p_sparse", "valve_a"]
    return tables.missing_flags(t.obs().select("event_id", *cols), cols)


@query("cast_columns", """
SELECT event_id, CAST(instance AS VARCHAR) AS id_text, CAST(label AS VARCHAR) AS label_text,
  CAST(ts AS VARCHAR)[1:19] AS ts_text, CAST(class AS BIGINT) AS class_big,
  TRY_CAST(right(well, 2) AS INT) AS well_no, TRY_CAST(data_type AS INT) AS not_a_number
FROM obs""")
def _cast(t: Tables):
    back = F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.obs().select(
        "event_id", F.col("instance").cast("string").alias("id_text"),
        F.col("label").cast("string").alias("label_text"),
        F.date_format(back, "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.col("class").cast("bigint").alias("class_big"),
        F.right("well", F.lit(2)).try_cast("int").alias("well_no"),
        F.col("data_type").try_cast("int").alias("not_a_number"))


@query("fill_constant", """
SELECT event_id, coalesce(class, 0) AS class, coalesce(p_main, -1.0::DOUBLE) AS p_main,
  coalesce(CASE WHEN event_id % 9 = 0 THEN NULL ELSE well END, 'Unknown') AS well FROM obs""")
def _fill_constant(t: Tables):
    df = t.obs().select("event_id", "class", "p_main", F.when(
        F.col("event_id") % 9 != 0, F.col("well")).alias("well"))
    return df.na.fill({"class": 0, "p_main": -1.0, "well": "Unknown"})


_ID_SOURCE = ("CASE data_type WHEN 'Real' THEN well WHEN 'Simulated' THEN 'SIMULATED' "
              "ELSE 'DRAWN' END")


@query("composite_id", f"""
SELECT event_id, CASE WHEN data_type = 'Real' THEN id
  ELSE {_ID_SOURCE} || ' - ' || id || ' - ' || label END AS series_id FROM obs""")
def _composite(t: Tables):
    return t.obs().select("event_id", composite_id(
        F.expr(_ID_SOURCE), F.col("id"), F.col("label")).alias("series_id"))


# ---- filters


@query("filter_label", "SELECT event_id, label, class FROM obs WHERE label = 4 AND class <> 0")
def _filter_label(t: Tables):
    return t.obs().filter((F.col("label") == 4) & (F.col("class") != 0)).select(
        "event_id", "label", "class")


@query("filter_isin", """
SELECT event_id, label, class FROM obs WHERE label IN (0, 1, 5, 7) AND class IN (0, 101, 105, 107)
""")
def _filter_isin(t: Tables):
    return t.obs().filter(F.col("label").isin(0, 1, 5, 7)).filter(
        F.col("class").isin(0, 101, 105, 107)).select("event_id", "label", "class")


@query("filter_or", """
SELECT event_id, label, class FROM obs WHERE label IN (0, 1, 5, 7, 9)
  OR class IN (0, 1, 5, 7, 9, 101, 105, 107, 109)""")
def _filter_or(t: Tables):
    keep = F.col("label").isin(0, 1, 5, 7, 9) | F.col("class").isin(
        0, 1, 5, 7, 9, 101, 105, 107, 109)
    return t.obs().filter(keep).select("event_id", "label", "class")


@query("filter_not", """
SELECT event_id, class, well FROM obs
WHERE NOT coalesce(class = 106 OR well IN ('WELL-00002', 'WELL-00005'), FALSE)""")
def _filter_not(t: Tables):
    hit = (F.col("class") == 106) | F.col("well").isin("WELL-00002", "WELL-00005")
    return t.obs().filter(~F.coalesce(hit, F.lit(False))).select("event_id", "class", "well")


@query("filter_nulls", """
SELECT event_id, p_main, p_aux FROM obs WHERE p_main IS NULL AND p_aux IS NOT NULL""")
def _filter_nulls(t: Tables):
    from sonde.functions import is_missing

    df = t.obs()
    return df.filter(is_missing(df, "p_main") & F.col("p_aux").isNotNull()).select(
        "event_id", "p_main", "p_aux")


@query("dropna_rows", "SELECT event_id, class, state FROM obs WHERE class IS NOT NULL AND state IS NOT NULL")
def _dropna(t: Tables):
    return t.obs().na.drop(subset=["class", "state"]).select("event_id", "class", "state")


@query("drop_empty_columns", "SELECT " + ", ".join(c for c in OBS_COLUMNS if c != "empty_a")
       + " FROM obs")
def _drop_empty(t: Tables):
    return tables.drop_empty_columns(t.obs())


@query("drop_sparse_columns", "SELECT " + ", ".join(
    c for c in OBS_COLUMNS if c not in ("empty_a", "p_sparse")) + " FROM obs")
def _drop_sparse(t: Tables):
    return tables.drop_sparse_columns(t.obs(), min_present=0.5)


@query("drop_missing_above", "SELECT " + ", ".join(c for c in OBS_COLUMNS if c != "empty_a")
       + " FROM obs")
def _drop_above(t: Tables):
    return tables.drop_sparse_columns(t.obs(), max_missing=0.85)


@query("drop_incomplete_instances", """
WITH whole AS (SELECT instance FROM obs GROUP BY instance
  HAVING count(p_main) > 0 AND count(p_aux) > 0 AND count(valve_a) > 0 AND count(class) > 0)
SELECT event_id, instance, p_aux, class FROM obs SEMI JOIN whole USING (instance)""")
def _drop_incomplete(t: Tables):
    return tables.drop_incomplete_instances(
        t.obs(), "instance", ["p_main", "p_aux", "valve_a", "class"]).select(
        "event_id", "instance", "p_aux", "class")


@query("distinct_values", "SELECT DISTINCT class FROM obs")
def _distinct(t: Tables):
    return t.obs().select("class").distinct()


# ---- joins


@query("join_left", """
SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def _join_left(t: Tables):
    rich = t.table("customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return t.table("orders").join(rich, "o_custkey", "left").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("join_inner", """
SELECT l_orderkey, l_linenumber, l_quantity, p_brand FROM lineitem
JOIN part ON l_partkey = p_partkey WHERE p_size > 25""")
def _join_inner(t: Tables):
    big = t.table("part").filter("p_size > 25")
    return t.table("lineitem").join(big, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "p_brand")


@query("join_full_outer", """
WITH a AS (SELECT label, count(DISTINCT instance) AS n_instance FROM obs WHERE label < 7 GROUP BY label),
b AS (SELECT label, count(DISTINCT well) AS n_well FROM obs WHERE label > 3 GROUP BY label)
SELECT coalesce(a.label, b.label) AS label, n_instance, n_well
FROM a FULL JOIN b ON a.label = b.label""")
def _join_outer(t: Tables):
    a = t.obs().filter("label < 7").groupBy("label").agg(
        F.countDistinct("instance").alias("n_instance"))
    b = t.obs().filter("label > 3").groupBy("label").agg(F.countDistinct("well").alias("n_well"))
    return a.join(b, "label", "outer")


@query("join_left_chain", """
SELECT n_name, r_name, n_customers, total FROM nation
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY c_nationkey) c
  ON n_nationkey = c.c_nationkey
LEFT JOIN (SELECT c_nationkey, round(sum(o_totalprice), 2) AS total FROM orders
  JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey) o
  ON n_nationkey = o.c_nationkey""")
def _join_chain(t: Tables):
    customer = t.table("customer")
    counts = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("n_customers"))
    totals = (t.table("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .groupBy(F.col("c_nationkey").alias("n_nationkey"))
              .agg(F.round(F.sum("o_totalprice"), 2).alias("total")))
    regions = t.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (t.table("nation").join(regions, "n_regionkey", "left")
            .join(counts, "n_nationkey", "left").join(totals, "n_nationkey", "left")
            .select("n_name", "r_name", "n_customers", "total"))


@query("join_semi", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN
  (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _join_semi(t: Tables):
    back = t.table("lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"))
    return t.table("orders").join(back, "o_orderkey", "left_semi").select(
        "o_orderkey", "o_totalprice")


@query("join_anti", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def _join_anti(t: Tables):
    return t.table("customer").join(
        t.table("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(
        "c_custkey", "c_name")


# ---- set operations


@query("union_all", """
SELECT event_id, label, p_main FROM obs WHERE data_type = 'Real'
UNION ALL SELECT event_id, label, p_main FROM obs WHERE data_type <> 'Real'
UNION ALL SELECT event_id, label, p_main FROM obs WHERE label = 3""")
def _union_all(t: Tables):
    df = t.obs().select("event_id", "label", "p_main", "data_type")
    parts = [df.filter("data_type = 'Real'"), df.filter("data_type <> 'Real'"),
             df.filter("label = 3")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("data_type")


@query("union_aligned", """
SELECT event_id, p_main, p_aux, CAST(NULL AS DOUBLE) AS valve_a FROM obs WHERE data_type = 'Real'
UNION ALL SELECT event_id, NULL, p_aux, valve_a FROM obs WHERE data_type = 'Drawn'""")
def _union_aligned(t: Tables):
    df = t.obs()
    return tables.union_aligned(
        df.filter("data_type = 'Real'").select("event_id", "p_main", "p_aux"),
        df.filter("data_type = 'Drawn'").select("valve_a", "event_id", "p_aux"))


@query("union_distinct", """
SELECT instance FROM obs WHERE class = 0 UNION SELECT instance FROM obs WHERE class > 100""")
def _union_distinct(t: Tables):
    df = t.obs()
    return df.filter("class = 0").select("instance").union(
        df.filter("class > 100").select("instance")).distinct()


@query("intersect_ids", """
SELECT instance FROM obs WHERE class = 0 INTERSECT SELECT instance FROM obs WHERE class > 100""")
def _intersect(t: Tables):
    df = t.obs()
    return df.filter("class = 0").select("instance").intersect(
        df.filter("class > 100").select("instance"))


@query("columns_not_in_ref", """
SELECT tag, count(*) AS n_rows FROM obs, (VALUES ('event_id'), ('ts'), ('instance'), ('data_type'),
  ('p_main'), ('p_aux'), ('p_sparse'), ('valve_a'), ('empty_a')) v(tag) GROUP BY tag""")
def _not_in_ref(t: Tables):
    from sonde.reference import TAGS

    df = t.obs()
    extra = tables.columns_not_in(df, [tag for tag, _, _ in TAGS])
    counted = df.agg(*[F.count("*").alias(c) for c in extra])
    return counted.unpivot([], [col(c) for c in extra], "tag", "n_rows")


# ---- sorts and limits


@query("sort_multi", "SELECT instance, ts, event_id, p_main FROM obs ORDER BY instance, ts, event_id")
def _sort(t: Tables):
    return t.obs().select("instance", "ts", "event_id", "p_main").orderBy(
        "instance", "ts", "event_id")


@query("limit_topk", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def _topk(t: Tables):
    return t.table("orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey").limit(25)


@query("top1_by_freq", """
SELECT valve_a, count(*) AS n FROM obs WHERE valve_a IS NOT NULL GROUP BY valve_a
ORDER BY n DESC, valve_a LIMIT 1""")
def _top1(t: Tables):
    return profile.most_frequent(t.obs(), "valve_a")
