"""Merkle manifest of a table of documents: hash trees stored in van Emde Boas order.

Every document is a leaf.  The leaves of a source, in id order, form one tree of runs of three;
the trees' roots, in source order, form the tree of the whole dataset.  A tree is cut into aligned
subtrees (blocks) of a fixed height.  A block is one row whose digests lie in van Emde Boas order:
the upper half of its levels first, then each lower subtree, and so on within each part.  Blocks
are built and read by address arithmetic alone; block roots are the leaves of the next round of
blocks.  No task ever holds more than one block, however large a source is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.cluster import small_side
from sonde.llm.frames import keyed, real_id, staged
from sonde.operators.series import position

# Children of a node, levels above the leaves of a block, bytes of a digest.
RUN, HEIGHT, WIDTH = 3, 6, 32

# Leaves are numbered in chunks of about this many rows, so that a hot source is many tasks.
ROWS_PER_CHUNK = 1 << 14

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- addresses ----------------------------------------------------------------------------------

def slots(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (RUN ** levels - 1) // (RUN - 1)


@cache
def addresses(levels: int, depth: int) -> np.ndarray:
    """Places of the nodes at ``depth`` (the root's is 0), left to right, in a tree of ``levels``.

    The tree is split at half height: the upper tree lies first, the lower ones follow in order,
    and each of them is laid out in the same way.
    """
    if levels == 1:
        return np.zeros(1, np.int64)
    upper = levels // 2
    if depth < upper:
        return addresses(upper, depth)
    lower = addresses(levels - upper, depth - upper)
    starts = slots(upper) + np.arange(RUN ** upper) * slots(levels - upper)
    return (starts[:, None] + lower[None, :]).ravel()


def nodes(n: int, level: int) -> int:
    """Nodes of a tree of ``n`` leaves at a level above them."""
    return -(-n // RUN ** level)


def layout(digests: list[bytes], rise: int) -> bytearray:
    """The block over up to ``RUN ** rise`` digests; places without a node stay zero."""
    out = bytearray(WIDTH * slots(rise + 1))
    row = digests
    for level in range(rise + 1):
        if level:
            names = [d.hex() for d in row]
            row = [sha256("".join(names[i:i + RUN]).encode()).digest()
                   for i in range(0, len(names), RUN)]
        for place, digest in zip(addresses(rise + 1, rise - level), row):
            out[WIDTH * place:WIDTH * (place + 1)] = digest
    return out


def paths(block: bytes, n: int, rise: int) -> list[str]:
    """Per leaf of a block its siblings, level by level, read from the stored places.

    A level is the digests left of the node, ``*`` for the node itself, and those right of it;
    levels end with ``;``.
    """
    above = [""]
    for level in range(rise - 1, -1, -1):
        count = nodes(n, level)
        places = addresses(rise + 1, rise - level)[:count]
        names = [block[WIDTH * p:WIDTH * (p + 1)].hex() for p in places]
        here = []
        for i in range(count):
            start = i - i % RUN
            run = names[start:start + RUN]
            run[i - start] = "*"
            here.append("".join(run) + ";" + above[i // RUN])
        above = here
    return above


# --- leaves and proofs as columns ---------------------------------------------------------------

def leaf_hash(fields: list[Column]) -> Column:
    """Hex SHA-256 over the fields: each its byte count, a colon and its text, or ``-``."""
    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                          F.lit("-"))
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def proof_hash(proof: Column) -> Column:
    """Hex SHA-256 over all siblings of a proof, from the leaf to the root, left to right."""
    return F.sha2(F.translate(proof, "*;", ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    steps = F.filter(F.split(proof, ";"), lambda s: s != "")
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.replace(s, F.lit("*"), h), 256))


# --- construction -------------------------------------------------------------------------------

def _build(table: pa.Table) -> pa.Table:
    order = np.argsort(table["slot"].to_numpy(), kind="stable")
    digests = table["digest"].to_pylist()
    rise = table["rise"][0].as_py()
    block = layout([digests[i] for i in order], rise)
    root = bytes(block[:WIDTH])
    first = table.slice(0, 1)
    return pa.table({"tree": first["tree"], "block": first["block"], "rise": first["rise"],
                     "n": pa.array([len(digests)], pa.int32()),
                     "layout": pa.array([bytes(block)], pa.binary()),
                     "root": pa.array([root], pa.binary())})


_BLOCK = "tree string, block long, rise int, n int, layout binary, root binary"


def _placed(items: DataFrame, height: int) -> DataFrame:
    span = RUN ** height
    return items.withColumns({"block": F.expr(f"pos DIV {span}"),
                              "slot": F.pmod("pos", F.lit(span)).cast("int")})


def _levels(n: Column) -> Column:
    """Levels above ``n`` leaves: the number of powers of three below ``n``."""
    return sum((F.when(n > RUN ** k, 1).otherwise(0) for k in range(39)), F.lit(0))


def grow(items: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of all trees, one stored table a round, and the trees' roots (tree, root).

    ``items`` has tree, pos (0, 1, .. in each tree) and digest.  Every round groups by block, so
    a group has at most ``RUN ** height`` rows, and leaves one row a block for the next one.
    """
    sizes = items.groupBy("tree").agg(_levels(F.count("*")).alias("left"))
    sizes = staged(sizes, "levels")
    most = sizes.agg(F.max("left")).first()[0]
    if most is None:
        return [], items.selectExpr("tree", "digest AS root")
    now = items.join(small_side(sizes), "tree").select("tree", "pos", "digest", "left")
    rounds, roots = [], None
    for at in range(max(1, -(-most // height))):
        rise = F.least(F.col("left"), F.lit(height)).cast("int").alias("rise")
        placed = _placed(now, height).select("tree", "block", "slot", "digest", rise)
        blocks = staged(placed.groupBy("tree", "block").applyInArrow(_build, _BLOCK), "blocks")
        rounds.append(blocks)
        left = F.col("left") - F.lit((at + 1) * height)
        tops = blocks.select("tree", F.col("block").alias("pos"), F.col("root").alias("digest")
                             ).join(small_side(sizes), "tree").withColumn("left", left)
        done = tops.filter("left <= 0").selectExpr("tree", "digest AS root")
        roots = done if roots is None else roots.union(done)
        now = tops.filter("left > 0")
    return rounds, roots


def _siblings(rounds: list[DataFrame], ends: DataFrame, height: int) -> DataFrame:
    """The blocks of the first round, each with the proof of its own root and what ``ends`` holds.

    ``ends`` has one row a tree: tree, above (the proof of the tree's root) and further columns.
    Proofs go down from round to round; only block roots are joined, never leaves.
    """
    span = RUN ** height

    def lower(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                found = paths(row["layout"], row["n"], row["rise"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * len(found), pa.string()),
                     pa.array([row["block"] * span + i for i in range(len(found))], pa.int64()),
                     pa.array([p + row["above"] for p in found], pa.string())],
                    ["tree", "block", "known"])

    blocks = rounds[-1].join(ends, "tree")
    for below in rounds[-2::-1]:
        known = staged(blocks.select("tree", "block", "rise", "n", "layout", "above").mapInArrow(
            lower, "tree string, block long, known string"), "paths")
        blocks = (below.join(ends, "tree").join(known, ["tree", "block"], "left")
                  .withColumn("above", F.coalesce("known", "above")).drop("known"))
    return blocks


@dataclass(frozen=True)
class Manifest:
    """Stored leaves and blocks of one dataset.

    ``leaves`` has id, tree, pos, digest and the carried columns; ``rounds`` the blocks of the
    sources' trees, ``top`` those of the tree over the sources, ``root`` its root in hex (None
    without documents).
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None
    height: int


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None,
             height: int = HEIGHT) -> Manifest:
    """Hash all documents and build the trees; ``carried`` columns stay beside the leaves.

    A source's leaves are ordered by doc_id (null first), rows of one doc_id by their leaf; equal
    rows are leaves of their own.  A null source is a source, before all others.  Fields may be
    null or empty, texts of any length.
    """
    carried = carried or {}
    # A null source sorts before every "=..." and stays apart from the empty one.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    digest = F.unhex(leaf_hash([F.col(f) for f in FIELDS]))
    hashed = keyed(docs, *FIELDS).select(
        "id", tree.alias("tree"), digest.alias("digest"),
        *[c.alias(name) for name, c in carried.items()])
    leaves = staged(hashed, "leaves")
    ranked = position(leaves, ["tree"], ["id", "digest"], "pos", ROWS_PER_CHUNK)
    leaves = staged(ranked.withColumn("pos", F.col("pos").cast("long")), "leaves")
    rounds, roots = grow(leaves.select("tree", "pos", "digest"), height)
    subroots = staged(roots, "subroots")
    ranked = position(subroots.withColumn("source", F.col("tree")), [], ["source"], "pos",
                      ROWS_PER_CHUNK)
    above = ranked.select(F.lit("").alias("tree"), F.col("pos").cast("long").alias("pos"),
                          F.col("root").alias("digest"), "source")
    above = staged(above, "subroots")
    top, root = grow(above.select("tree", "pos", "digest"), height)
    found = root.select(F.lower(F.hex("root"))).collect()
    return Manifest(leaves, rounds, above, top, found[0][0] if found else None, height)


def proofs(made: Manifest, *carried: str) -> DataFrame:
    """Per document: id, leaf, subroot, root, proof (see ``paths``) and the carried columns.

    Leaves meet their block, and nothing else, in one group.
    """
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in made.leaves.schema.fields
             if f.name in carried]
    schema = ", ".join(["id long", "leaf string", "subroot string", "root string",
                        "proof string", *kinds])
    spark = made.leaves.sparkSession
    if made.root is None:
        return spark.createDataFrame([], schema)
    height, span, root = made.height, RUN ** made.height, made.root
    ends = spark.createDataFrame([("", "")], "tree string, above string")
    tops = _siblings(made.top, ends, height)

    def read(rows: pa.Table, block: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        found = paths(row["layout"], row["n"], row["rise"])
        mine = [found[p % span] + row["above"] for p in rows["pos"].to_pylist()]
        return pa.table({
            **{c: rows[c] for c in rows.column_names if c not in ("tree", "block", "pos", "digest")},
            "leaf": pa.array([d.hex() for d in rows["digest"].to_pylist()], pa.string()),
            "proof": pa.array(mine, pa.string()),
            **{c: pa.array([row[c]] * len(mine), pa.string()) for c in block.column_names
               if c not in ("tree", "block", "rise", "n", "layout", "above")}})

    def met(items: DataFrame, blocks: DataFrame, kinds: str) -> DataFrame:
        rows = _placed(items, height).drop("slot").groupBy("tree", "block")
        return rows.cogroup(blocks.drop("root").groupBy("tree", "block")).applyInArrow(read, kinds)

    trees = staged(met(made.subroots, tops, "source string, leaf string, proof string"), "trees")
    ends = small_side(trees.selectExpr("source AS tree", "proof AS above", "leaf AS subroot"))
    blocks = _siblings(made.rounds, ends, height)
    kinds = ", ".join(["id long", *kinds, "leaf string", "proof string", "subroot string"])
    done = met(made.leaves.select("tree", "pos", "digest", "id", *carried), blocks, kinds)
    return done.withColumn("root", F.lit(root)).select(
        "id", "leaf", "subroot", "root", "proof", *carried)


def verified(docs: DataFrame) -> DataFrame:
    """Prove every document, and detect texts that lose their line ends after the manifest.

    One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the leaf as
    found later, with the siblings as stored), verified (the folded root is the root).  Texts lose
    their line ends where 2 divides the crc32 of the decimal doc_id; a null doc_id or text stays
    as it is.  No documents, no rows.
    """
    key = F.col("id").cast("string")
    hit = F.col("doc_id").isNotNull() & (F.crc32(key) % 2 == 0)
    later = F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = F.unhex(leaf_hash([*[F.col(f) for f in FIELDS if f != "text"], later]))
    proved = proofs(manifest(docs, {"found": found}), "found")
    back = folded(F.lower(F.hex("found")), F.col("proof"))
    return proved.select(
        real_id().alias("doc_id"), "leaf", "subroot", "root",
        proof_hash(F.col("proof")).alias("proof_sha256"), back.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


# --- the same as SQL ----------------------------------------------------------------------------

def _framed(*fields: str) -> str:
    return " || ".join(
        f"coalesce(CAST(strlen(CAST({f} AS VARCHAR)) AS VARCHAR) || ':' || CAST({f} AS VARCHAR), "
        "'-')" for f in fields)


def _raise(name: str, levels: int) -> str:
    """Levels of the trees in ``<name>0`` (tree, pos, h, n): ``<name>t`` per level."""
    out = []
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT tree, pos // {RUN} AS pos, "
            f"sha256(string_agg(h, '' ORDER BY pos)) AS h, any_value((n + {RUN - 1}) // {RUN}) AS n "
            f"FROM {name}{k} WHERE n > 1 GROUP BY tree, pos // {RUN})")
    return ", ".join(out)


def _steps(name: str, levels: int) -> str:
    """Per node below a root: the digests of its run left and right of it."""
    run = f"PARTITION BY tree, pos // {RUN} ORDER BY pos ROWS BETWEEN"
    return ", ".join(
        f"{name}s{k} AS MATERIALIZED (SELECT tree, pos, "
        f"coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
        f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r "
        f"FROM {name}{k} WHERE n > 1)" for k in range(levels))


def _climb(source: str, name: str, key: str, at: str, levels: int, prefix: str) -> str:
    """Fold ``now`` and add up the siblings of every row of ``source`` through all levels."""
    out, last = [], source
    for k in range(levels):
        new = f"{prefix}{k}"
        out.append(
            f"{new} AS (SELECT x.* EXCLUDE (now, sib), "
            "CASE WHEN s.l IS NULL THEN now ELSE sha256(s.l || now || s.r) END AS now, "
            f"sib || coalesce(s.l || s.r, '') AS sib FROM {last} x LEFT JOIN {name}s{k} s "
            f"ON s.tree = x.{key} AND s.pos = x.{at} // {RUN ** k})")
        last = new
    return ", ".join(out)


def oracle(levels: int = 14, top: int = 8) -> str:
    """``verified`` over ``documents`` as SQL, for up to 3 ** levels rows of a source."""
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform("
           "range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: "
           "[ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
           "lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))), 4294967295)")
    found = (f"CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")
    return (
        "WITH f AS (SELECT doc_id, coalesce('=' || source, '') AS tree, "
        f"sha256({_framed(*FIELDS)}) AS h, "
        f"sha256({_framed(*FIELDS[:-1])} || {_framed(found)}) AS found FROM documents), "
        "a0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id "
        "NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM f), "
        f"{_raise('a', levels)}, "
        "sub AS MATERIALIZED (" + " UNION ALL ".join(
            f"SELECT tree, h FROM a{k} WHERE n = 1" for k in range(levels + 1)) + "), "
        "b0 AS MATERIALIZED (SELECT '' AS tree, tree AS source, h, row_number() OVER "
        "(ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM sub), "
        f"{_raise('b', top)}, "
        "root AS (" + " UNION ALL ".join(
            f"SELECT h FROM b{k} WHERE n = 1" for k in range(top + 1)) + "), "
        f"{_steps('a', levels)}, {_steps('b', top)}, "
        "x AS (SELECT a.doc_id, a.h AS leaf, a.tree, a.pos, b.h AS subroot, '' AS one, "
        "b.pos AS bpos, a.found AS now, '' AS sib FROM a0 a JOIN b0 b ON b.source = a.tree), "
        f"{_climb('x', 'a', 'tree', 'pos', levels, 'y')}, "
        f"{_climb(f'y{levels - 1}', 'b', 'one', 'bpos', top, 'z')} "
        "SELECT doc_id, leaf, subroot, root.h AS root, sha256(sib) AS proof_sha256, "
        f"now AS folded_root, now = root.h AS verified FROM z{top - 1}, root")
