"""Splits, samples, class weights, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonde.catalog.base import Tables, query
from sonde.operators import evaluate, features, split

# The random order in SQL: md5 over the key and the seed.
_H = "md5(instance || '|42')"
_ROW_H = "md5(event_id || '|42')"


def _ranked(source: str, strata: str = "", h: str = _H) -> str:
    part = f"PARTITION BY {strata}" if strata else ""
    return (f"SELECT *, row_number() OVER ({part} ORDER BY {h}) AS rk, "
            f"count(*) OVER ({part}) AS sz FROM ({source}) z")


_BY_LABEL = _ranked("SELECT DISTINCT label, instance FROM obs", "label")
_CUT = ("CASE WHEN sz > 4 AND rk <= sz * 0.8::DOUBLE THEN 'train' WHEN sz > 4 THEN 'test' "
        "WHEN rk < sz THEN 'train' ELSE 'test' END")
_SPLIT = f"SELECT label, instance, {_CUT} AS split FROM ({_BY_LABEL}) r"


@query("stratified_split", f"""
SELECT event_id, instance, label, split FROM obs JOIN ({_SPLIT}) s USING (label, instance)""")
def _stratified(t: Tables):
    df = t.obs().select("event_id", "instance", "label")
    train, test = split.stratified_group_split(df, "instance", "label")
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")))


@query("group_split", f"""
SELECT instance, CASE WHEN sz > 4 AND rk <= sz * 0.8::DOUBLE THEN 'train' WHEN sz > 4 THEN 'test'
  WHEN rk < sz THEN 'train' ELSE 'test' END AS split
FROM ({_ranked('SELECT DISTINCT instance FROM obs')}) r""")
def _group(t: Tables):
    return split.group_split(t.obs(), "instance")


_DISJOINT = f"""SELECT instance, first_class, CASE WHEN sz <= 1 OR rk <= sz - ceil(sz * 0.2::DOUBLE)
  THEN 'train' ELSE 'test' END AS split FROM ({_ranked(
      "SELECT instance, min(class) AS first_class FROM obs WHERE class IS NOT NULL GROUP BY instance",
      "first_class")}) r"""


@query("group_split_disjoint", _DISJOINT)
def _disjoint(t: Tables):
    return split.disjoint_group_split(t.obs().filter("class IS NOT NULL"), "instance", "class")


@query("three_way_split", f"""
WITH r AS ({_ranked("SELECT DISTINCT class, instance FROM obs WHERE class IS NOT NULL", "class")}),
c AS (SELECT *, ceil(sz * 0.2::DOUBLE) AS nt FROM r),
d AS (SELECT *, ceil((sz - nt) * 0.2::DOUBLE) AS nv FROM c)
SELECT class, instance, CASE WHEN rk <= sz - nt - nv THEN 'train' WHEN rk <= sz - nt THEN 'val'
  ELSE 'test' END AS split FROM d""")
def _three(t: Tables):
    return split.three_way_split(t.obs().filter("class IS NOT NULL"), "instance", "class")


_BITS = f"CAST('0x' || substr({_ROW_H}, 1, 15) AS BIGINT)"


@query("hash_split", f"""
SELECT event_id, CASE WHEN {_BITS} < {int(0.8 * 2 ** 60)} THEN 'train' ELSE 'test' END AS split FROM obs""")
def _hash_split(t: Tables):
    return split.hash_split(t.obs().select("event_id"), ["event_id"])


@query("hash_split_near_one", f"""
SELECT event_id, CASE WHEN {_BITS} < {int(0.996 * 2 ** 60)} THEN 'train' ELSE 'test' END AS split
FROM obs""")
def _hash_split_near_one(t: Tables):
    return split.hash_split(t.obs().select("event_id"), ["event_id"], 0.996)


@query("hash_sample_small", f"SELECT event_id, label FROM obs WHERE {_BITS} < {int(0.0003 * 2 ** 60)}")
def _hash_sample_small(t: Tables):
    return split.hash_sample(t.obs().select("event_id", "label"), ["event_id"], 0.0003)


@query("hash_sample", f"SELECT event_id, label FROM obs WHERE {_BITS} < {int(0.1 * 2 ** 60)}")
def _hash_sample(t: Tables):
    return split.hash_sample(t.obs().select("event_id", "label"), ["event_id"], 0.1)


@query("stratified_sample", f"""
SELECT event_id, class FROM ({_ranked(
    "SELECT event_id, class FROM obs WHERE class IS NOT NULL", "class", _ROW_H)}) r
WHERE rk <= floor(sz * 0.1::DOUBLE)""")
def _sample(t: Tables):
    df = t.obs().na.drop(subset=["class"]).select("event_id", "class")
    return split.stratified_sample(df, ["class"], ["event_id"], 0.1)


def _splits(t: Tables):
    return split.group_split(t.obs(), "instance", ["label"])


@query("split_overlap", f"""
SELECT count(*) AS overlap FROM (SELECT instance FROM ({_SPLIT}) a WHERE split = 'train'
  INTERSECT SELECT instance FROM ({_SPLIT}) b WHERE split = 'test') q""")
def _overlap(t: Tables):
    return split.split_overlap(_splits(t), "instance")


@query("split_counts", f"""
SELECT split, label, count(DISTINCT instance) AS n_instances FROM ({_SPLIT}) s
GROUP BY split, label""")
def _split_counts(t: Tables):
    return split.split_counts(_splits(t), "label", "instance")


@query("split_report", f"""
WITH j AS (SELECT o.instance, class, split FROM obs o JOIN ({_SPLIT}) s USING (label, instance))
SELECT split, class, count(*) AS n_rows, count(DISTINCT instance) AS n_ids FROM j
GROUP BY split, class UNION ALL
SELECT split, NULL, count(*), count(DISTINCT instance) FROM j GROUP BY split""")
def _report(t: Tables):
    df = split.attach_split(t.obs(), _splits(t), ["label", "instance"])
    return split.split_report(df, "class", "instance")


@query("missing_classes", f"""
WITH j AS (SELECT well || '/' || class AS well_class, split FROM obs
  JOIN ({_DISJOINT}) s USING (instance) WHERE class IS NOT NULL)
SELECT well_class, CASE max(split) WHEN 'train' THEN 'test' ELSE 'train' END AS missing_in FROM j
GROUP BY well_class HAVING count(DISTINCT split) = 1""")
def _missing(t: Tables):
    """Classes of a well that only one side of the split has seen."""
    df = t.obs().filter("class IS NOT NULL").withColumn(
        "well_class", F.concat_ws("/", "well", "class"))
    splits = split.disjoint_group_split(df, "instance", "class")
    return evaluate.missing_classes(split.attach_split(df, splits, ["instance"]), "well_class")


@query("class_weights", """
SELECT class, n, round(total * 1.0::DOUBLE / (k * n), 9) AS weight FROM
  (SELECT class, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k
   FROM obs WHERE class IS NOT NULL GROUP BY class) q""")
def _weights(t: Tables):
    return features.class_weights(t.obs(), "class").withColumn("weight", F.round("weight", 9))


_COLS = ["p_main", "p_aux", "valve_a"]
_WHOLE = "p_main IS NOT NULL AND p_aux IS NOT NULL AND valve_a IS NOT NULL"


def _scale_sql(dev: str) -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, {dev}({c}) AS s_{c}" for c in _COLS)
    cells = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _COLS)
    return (f"WITH j AS (SELECT o.*, split FROM obs o JOIN ({_SPLIT}) s USING (label, instance) "
            f"WHERE {_WHOLE}), f AS (SELECT {stats} FROM j WHERE split = 'train') "
            f"SELECT event_id, split, {cells} FROM j, f")


def _scaled(t: Tables, population: bool):
    df = split.attach_split(t.obs(), _splits(t), ["label", "instance"]).select(
        "event_id", "split", *_COLS)
    scaler = features.fit_scaler(df.filter("split = 'train'"), _COLS, population)
    return scaler.transform(df).withColumns({c: F.round(c, 6) for c in _COLS})


@query("scale_standard", _scale_sql("stddev_samp"))
def _scale(t: Tables):
    return _scaled(t, False)


@query("scale_population", _scale_sql("stddev_pop"))
def _scale_pop(t: Tables):
    return _scaled(t, True)


@query("string_index", """
WITH c AS (SELECT class, row_number() OVER (ORDER BY count(*) DESC, CAST(class AS VARCHAR)) - 1 AS i
  FROM obs WHERE class IS NOT NULL AND label < 8 GROUP BY class)
SELECT event_id, o.class, CAST(coalesce(i, (SELECT count(*) FROM c)) AS DOUBLE) AS class_index
FROM obs o LEFT JOIN c ON o.class = c.class""")
def _index(t: Tables):
    df = t.obs().select("event_id", "label", "class")
    model = features.frequency_index(df.filter("label < 8 AND class IS NOT NULL"), "class",
                                     "class_index")
    return model.transform(df).drop("label")


@query("label_encode", """
WITH c AS (SELECT class, dense_rank() OVER (ORDER BY class) - 1 AS code FROM obs
  WHERE class IS NOT NULL GROUP BY class)
SELECT event_id, o.class, code FROM obs o LEFT JOIN c ON o.class = c.class""")
def _encode(t: Tables):
    return features.label_encode(t.obs().select("event_id", "class"), "class")


@query("one_hot", "SELECT event_id, label, " + " || ',' || ".join(
    f"CAST(label = {k} AS INT)" for k in range(10)) + " AS one_hot FROM obs")
def _one_hot(t: Tables):
    df = features.one_hot(t.obs().select("event_id", "label"), "label", 10)
    return df.withColumn("one_hot", F.array_join(F.col("one_hot").cast("array<string>"), ","))
