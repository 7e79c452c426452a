"""Hard-negative mining with bounds along spanning trees of the anchors.

Vectors are integer points, a score is their inner product.  Anchors that lie close together form
a block, joined by a minimum spanning tree.  Against a chunk of candidates the root's scores are
computed; from there on, a child's score differs from its parent's by at most the length of the
edge times the candidate's norm.  Only candidates whose bounds overlap the child's window are
scored again.  A first pass finds the positives of every anchor (window: at least the worst of the
best so far), a second one the negatives (windows: shares of the positives' scores).
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.frames import keyed, lists, real_id, slices, staged
from sonde.operators.series import position

# Anchors of a block, candidates of a chunk, chunks of a part, and blocks of a team.
BLOCK, CHUNK, SHARED, TEAM = 256, 4096, 16, 32

# Up to this many parts hold fewer chunks than they may, so that small tables use all cores.
SPREAD = 64

# Negatives and positives asked for, and the window in percent of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100

_LONG = 2 ** 63 - 1


# --- arrays -------------------------------------------------------------------------------------

def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as held:
        return {name: held[name] for name in held.files}


def _matrix(vectors: list[list[float]]) -> np.ndarray:
    """Integer-valued rows, shorter ones ended with zeros; two bytes a part where they suffice."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    small = np.abs(out).max(initial=0) < 2 ** 15
    return out.astype(np.int16) if small else out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parents (-1 for the root), lengths of the edges to them, and depths, by Prim's rule.

    The root is the point with the least sum of distances to the others.
    """
    n = len(points)
    values = points.astype(np.float64)
    squares = (values ** 2).sum(1)
    far = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * values @ values.T, 0))
    root = int(far.sum(1).argmin())
    parent, depth = np.full(n, -1), np.zeros(n, np.int64)
    near, outside = far[root].copy(), np.ones(n, bool)
    parent[:], parent[root], outside[root] = root, -1, False
    for _ in range(n - 1):
        new = int(np.where(outside, near, np.inf).argmin())
        outside[new], depth[new] = False, depth[parent[new]] + 1
        closer = outside & (far[new] < near)
        near[closer], parent[closer] = far[new][closer], new
    own = values - values[np.maximum(parent, 0)]  # exact lengths of the chosen edges
    return parent, np.where(parent < 0, 0, np.sqrt((own ** 2).sum(1))), depth


def _align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m.astype(np.float64), ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def bounded_scores(anchors: np.ndarray, tree, points: np.ndarray, wanted):
    """Yield (anchor, places, scores) with the exact scores of all places that may matter.

    ``wanted(some, low, high)`` says for some anchors (rows) and all points (columns) whether a
    score between the bounds could fall in the anchor's window.  Levels of the tree are handled
    together.  A level most of whose points matter is one matrix product.
    """
    parent, length, depth = tree
    a, x = _align(anchors, points)
    if np.abs(a).max(initial=0) * np.abs(x).max(initial=0) * max(1, a.shape[1]) >= 2.0 ** 52:
        # Too large for exact doubles: plain integers, every pair scored.
        whole, ends = [[int(v) for v in row] for row in x], np.full((1, len(x)), np.inf)
        for i, row in enumerate(a):
            own, places = [int(v) for v in row], np.flatnonzero(wanted([i], -ends, ends)[0])
            exact = [max(-_LONG, min(_LONG, sum(p * q for p, q in zip(own, whole[place]))))
                     for place in places]
            yield i, places, np.array(exact, np.int64)
        return
    norms = np.sqrt((x ** 2).sum(1))
    low, high = np.empty((len(a), len(x))), np.empty((len(a), len(x)))
    for level in range(int(depth.max(initial=0)) + 1):
        some = np.flatnonzero(depth == level)
        if level == 0:
            low[some] = high[some] = a[some] @ x.T
            asked = wanted(some, low[some], high[some])
        else:
            # One unit and a share of the edge more than the bound make up for rounding.
            reach = length[some][:, None] * norms[None, :] * (1 + 1e-9) + 1
            low[some], high[some] = low[parent[some]] - reach, high[parent[some]] + reach
            asked = wanted(some, low[some], high[some])
            if asked.mean() > 0.2:
                exact = a[some] @ x.T
                low[some] = np.where(asked, exact, low[some])
                high[some] = np.where(asked, exact, high[some])
            else:
                for i, mask in zip(some, asked):
                    places = np.flatnonzero(mask)
                    low[i, places] = high[i, places] = x[places] @ a[i]
        for i, mask in zip(some, asked):
            places = np.flatnonzero(mask)
            if len(places):
                yield int(i), places, low[i, places].astype(np.int64)


class Best:
    """The first ``k`` (score, id) of a list: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(scores) > 4 * self.k:  # ties with the k-th stay until the sort
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= edge
            scores, ids = scores[keep], ids[keep]
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]

    @property
    def least(self) -> float:
        """A score below this one cannot enter any more."""
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf


def _positives(block, chunk, best: dict, k: int) -> None:
    same = block["labels"][:, None] == chunk["labels"][None, :]
    same &= block["ids"][:, None] != chunk["ids"][None, :]

    def wanted(some, low, high):
        least = np.array([best[i, 0].least if (i, 0) in best else -np.inf for i in some])
        return same[some] & (high >= least[:, None])

    tree = block["parent"], block["length"], block["depth"]
    for i, places, scores in bounded_scores(block["values"], tree, chunk["values"], wanted):
        best.setdefault((i, 0), Best(k)).add(scores, chunk["ids"][places])


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def _negatives(block, chunk, best: dict, k: int, low: int, high: int) -> None:
    other = block["labels"][:, None] != chunk["labels"][None, :]
    other &= block["ids"][:, None] != chunk["ids"][None, :]
    asked = block["asked"]              # per anchor the distinct windows (from, to)

    def wanted(some, least, most):
        out = np.zeros(least.shape, bool)
        for row, i in enumerate(some):
            for j, (start, end) in enumerate(asked[i]):
                held = best.get((i, j))
                start = start if held is None else max(start, held.least)
                out[row] |= (most[row] >= start) & (least[row] <= end)
        return out & other[some]

    tree = block["parent"], block["length"], block["depth"]
    for i, places, scores in bounded_scores(block["values"], tree, chunk["values"], wanted):
        for j, (start, end) in enumerate(asked[i]):
            fits = (scores >= start) & (scores <= end)
            if fits.any():
                best.setdefault((i, j), Best(k)).add(scores[fits], chunk["ids"][places[fits]])


# --- tables -------------------------------------------------------------------------------------

def _chunk(table: pa.Table) -> pa.Table:
    data = _pack(ids=table["id"].to_numpy(), labels=table["label"].to_numpy(),
                 values=_matrix(table["v"].to_pylist()))
    return pa.table({"part": table["part"].slice(0, 1), "data": pa.array([data], pa.binary())})


def _block(table: pa.Table) -> pa.Table:
    table = table.sort_by("place")
    values = _matrix(table["v"].to_pylist())
    parent, length, depth = spanning_tree(values)
    data = _pack(ids=table["id"].to_numpy(), labels=table["label"].to_numpy(), values=values,
                 parent=parent, length=length, depth=depth)
    return pa.table({"block": table["block"].slice(0, 1), "anchors": pa.array([data], pa.binary())})


def _codes(batches):
    """Signs of fixed projections as bits: anchors of one code lie in one region."""
    for batch in slices(batches, CHUNK):
        values = _matrix(lists(batch, "v")[0]).astype(np.float64)
        # Filled row by row, so that a part meets the same numbers in vectors of any length.
        bits = values @ np.random.default_rng(11).standard_normal((values.shape[1], 16)) > 0
        codes = bits @ (1 << np.arange(16)[::-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int64())],
                                         [*batch.schema.names, "code"])


def _met(blocks: DataFrame, chunks: DataFrame, parts: int, teams: int):
    """Every team of blocks beside every part of chunks: a task holds one of each, never the copies."""
    copies = blocks.withColumns({"team": (F.col("block") % teams).cast("int"), "part": F.explode(
        F.sequence(F.lit(0), F.lit(parts - 1)))})
    theirs = chunks.withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(teams - 1))))
    return copies.groupBy("part", "team").cogroup(theirs.groupBy("part", "team"))


_FOUND = ["block", "anchor", "positive", "id", "score"]


def _search(met, k: int, spans: tuple[int, int] | None = None) -> DataFrame:
    """(block, anchor, positive, id, score): the best of each anchor and, with ``spans``, positive."""
    def searched(key: int, block: dict, chunks: pa.Table) -> list[np.ndarray]:
        best: dict = {}
        for data in chunks["data"]:
            if spans:
                _negatives(block, _unpack(data.as_py()), best, k, *spans)
            else:
                _positives(block, _unpack(data.as_py()), best, k)
        which = [(i, p, b) for (i, j), b in best.items()
                 for p in (block["owners"][i][j] if spans else [0])]
        sizes = [len(b.ids) for *_, b in which]
        return [np.full(sum(sizes), key), *(np.repeat(np.array([w[c] for w in which], np.int64), sizes)
                                            for c in (0, 1)),
                *(np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (
                    [b.ids for *_, b in which], [b.scores for *_, b in which]))]

    def run(blocks: pa.Table, chunks: pa.Table) -> pa.Table:
        found = [[np.zeros(0, np.int64)] * len(_FOUND)]
        for at in range(blocks.num_rows if chunks.num_rows else 0):
            row = blocks.slice(at, 1).to_pylist()[0]
            block = _unpack(row["anchors"])
            if spans:
                block["asked"], block["owners"] = _windows(row["windows"], len(block["ids"]), *spans)
            found.append(searched(row["block"], block, chunks))
        return pa.table({c: pa.array(np.concatenate(parts), pa.int64())
                         for c, parts in zip(_FOUND, zip(*found))})

    found = met.applyInArrow(run, ", ".join(f"{c} long" for c in _FOUND))
    first = Window.partitionBy("block", "anchor", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def _windows(rows: list[dict], n: int, low: int, high: int):
    """Per anchor its distinct, not empty windows, and for each the positives that ask for it."""
    asked, owners = [[] for _ in range(n)], [[] for _ in range(n)]
    for row in sorted(rows, key=lambda r: (r["anchor"], r["rank"])):
        i, span = row["anchor"], window(row["score"], low, high)
        if span[0] > span[1]:
            continue
        if span not in asked[i]:
            asked[i].append(span)
            owners[i].append([])
        owners[i][asked[i].index(span)].append(row["rank"])
    return asked, owners


def quantised(values: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every part, as whole doubles."""
    return F.transform(values, lambda x: F.floor(F.least(F.greatest(
        x.cast("double") * scale, F.lit(-2.0 ** 62)), F.lit(2.0 ** 62))).cast("double"))


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = 256, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """One row per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, scores.

    ``vectors`` has vec_id and embedding; ``anchor`` and ``label`` are expressions over its
    columns.  Parts become floor(``scale`` * x).  An anchor's positives are its first rows of the
    same label, by falling score and then smaller id; a positive's negatives are the first rows
    of other labels whose score lies between ``low`` and ``high`` percent of the positive's.

    Rows with a null label, a null vector, or a null or non-finite part take no part; an empty
    vector scores 0 with all.  A shorter vector is ended with zeros.  Equal rows (id, label,
    vector) count once; rows that share an anchor's vec_id are never its partners.  A null vec_id
    is no anchor and comes first among ties.  Parts are held within 2 ** 62 and scores within the
    range of long.  Without rows or anchors the result is empty.

    Anchors meet all rows, in blocks: a pair of a block and a chunk of rows is one step of a task,
    which keeps only the best of each anchor.  A task holds a team of blocks and a part of the
    chunks, both of bounded size.  Groups are even by construction, whatever the labels are.
    """
    parts = F.col("embedding")
    sound = (F.col("label").isNotNull() & parts.isNotNull()
             & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    named = vectors.select(F.col("vec_id"), F.col("embedding"), label.cast("long").alias("label"),
                           F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = keyed(named, "embedding", "label", "asks", id_column="vec_id").filter(sound).select(
        "id", "label", "asks", quantised(parts, scale).alias("v")).distinct()
    rows = staged(rows, "points")
    chunks = max(1, -(-rows.count() // chunk))
    shared = max(-(-chunks // SHARED), min(chunks, SPREAD))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "label", "v"), F.lit(chunks)))
    dealt = dealt.withColumn("part", (F.col("chunk") % shared).cast("int"))
    data = staged(dealt.select("id", "label", "v", "chunk", "part").groupBy("chunk").applyInArrow(
        _chunk, "part int, data binary"), "chunks", wide=True)

    anchors = rows.filter("asks").select("id", "label", "v")
    coded = staged(anchors.mapInArrow(_codes, "id long, label long, v array<double>, code long"),
                   "anchors")
    placed = position(coded, [], ["code", "id", "label", "v"], "place", 1 << 16)
    blocks = staged(placed.withColumn("block", F.expr(f"place DIV {block}")).select(
        "id", "label", "v", "place", "block").groupBy("block").applyInArrow(
        _block, "block long, anchors binary"), "blocks", wide=True)
    teams = max(1, -(-blocks.count() // TEAM))
    best = staged(_search(_met(blocks, data, shared, teams), positives), "positives")
    asked = best.groupBy("block").agg(F.collect_list(
        F.struct("anchor", "rank", "score")).alias("windows"))
    found = _search(_met(blocks.join(asked, "block"), data, shared, teams), negatives, (low, high))

    place = F.col("place") % block
    names = placed.select(F.expr(f"place DIV {block}").alias("block"),
                          place.cast("long").alias("anchor"), F.col("id").alias("anchor_id"))
    good = best.select("block", "anchor", F.col("rank").cast("long").alias("positive"),
                       F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    done = (found.withColumnRenamed("score", "negative_score").join(
        good, ["block", "anchor", "positive"]).join(names, ["block", "anchor"]))
    return done.select("anchor_id", real_id("positive_id").alias("positive_id"), "rank",
                       real_id().alias("negative_id"), "positive_score", "negative_score")


def mined(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100.

    Where vec_id is divisible by 7 the label is the next one of ten.
    """
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


def oracle() -> str:
    """``mined`` over ``embeddings`` as SQL, with every score computed."""
    return (
        "WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE "
        "label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q "
        "FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter("
        "embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0), "
        "s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, "
        "list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b "
        "ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id), "
        "p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same "
        "QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= "
        f"{POSITIVES}) "
        "SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, "
        "vec_id AS negative_id, positive_score, score AS negative_score "
        f"FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score "
        f"AND 100 * score <= {HIGH} * positive_score "
        "WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) "
        f"QUALIFY rank <= {NEGATIVES}")
