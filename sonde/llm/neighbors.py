"""Embedding near-dedup with hierarchical navigable small-world graphs, one per shard."""

from __future__ import annotations

import io
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.components import components
from sonde.llm.frames import keyed, real_id, staged

COSINE = 0.98

# Vectors of one shard at most, about; a shard's graph is built and searched in one task.
SHARD = 16_384

# Links per vector and layer, beam while building, first beam of a search, audited queries and
# the share of their true links that has to be found.
DEGREE, BUILD_BEAM, BEAM, AUDIT, RECALL = 12, 48, 32, 48, 0.99

# Queries that a beam of this width does not settle are compared with the whole shard instead.
WIDEST = 128


def _search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray,
            beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries at once in one layer: (places, cosines), best first.

    ``links`` holds -1 where a vector has fewer links.  All queries step together: each expands
    its best vector that it has not expanded, until none is left in its beam.
    """
    count = len(queries)
    places = np.full((count, beam), -1, np.int64)
    scores = np.full((count, beam), -np.inf, np.float32)
    opened = np.ones((count, beam), bool)
    places[:, 0] = entry
    scores[:, 0] = np.einsum("qd,qd->q", queries, vectors[entry])
    opened[:, 0] = False
    seen = np.zeros((count, len(vectors)), bool)
    seen[np.arange(count), entry] = True
    live = np.arange(count)
    while len(live):
        best = np.where(opened[live], -np.inf, scores[live]).argmax(1)
        more = ~opened[live, best]
        live, best = live[more], best[more]
        if not len(live):
            break
        opened[live, best] = True
        near = links[places[live, best]]
        fresh = near >= 0
        near = np.where(fresh, near, 0)
        fresh &= ~seen[live[:, None], near]
        seen[live[:, None], near] |= fresh
        value = np.einsum("qkd,qd->qk", vectors[near], queries[live])
        value = np.where(fresh, value, -np.inf)
        every = np.concatenate([scores[live], value], 1)
        order = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
        rows = np.arange(len(live))[:, None]
        scores[live] = every[rows, order]
        places[live] = np.concatenate([places[live], near], 1)[rows, order]
        opened[live] = np.concatenate([opened[live], ~fresh], 1)[rows, order]
        opened[live] |= ~np.isfinite(scores[live])
    order = np.argsort(-scores, axis=1, kind="stable")
    rows = np.arange(count)[:, None]
    places, scores = places[rows, order], scores[rows, order]
    return np.where(np.isfinite(scores), places, -1), scores


@dataclass
class Graph:
    """Unit vectors, and per layer the members and their links (-1 pads)."""

    vectors: np.ndarray
    layers: list[np.ndarray]   # each (vectors, degree); rows of non-members are -1
    entry: int

    def descend(self, queries: np.ndarray) -> np.ndarray:
        """Entry into the bottom layer, by greedy steps through the upper ones."""
        entry = np.full(len(queries), self.entry, np.int64)
        for links in self.layers[:0:-1]:
            entry = _search(self.vectors, links, queries, entry, 1)[0][:, 0]
        return entry

    def search(self, queries: np.ndarray, beam: int):
        beam = min(beam, len(self.vectors))
        parts = [_search(self.vectors, self.layers[0], q, self.descend(q), beam)
                 for q in np.array_split(queries, max(1, -(-len(queries) // 512)))]
        return tuple(np.concatenate(p) for p in zip(*parts))


def _linked(vectors: np.ndarray, owner: int, places: np.ndarray, scores: np.ndarray,
            degree: int) -> list[int]:
    """Diverse links: best first, skipping what is closer to a chosen link than to the owner."""
    chosen, spare = [], []
    order = np.argsort(-scores, kind="stable")
    places, scores = places[order], scores[order]
    among = vectors[places] @ vectors[places].T
    for k in range(len(places)):
        if len(chosen) == degree:
            break
        if places[k] == owner:
            continue
        if all(among[k, c] < scores[k] for c in chosen):
            chosen.append(k)
        else:
            spare.append(k)
    chosen += spare[:max(0, degree - len(chosen))]
    return [int(places[k]) for k in chosen]


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM,
          seed: int = 3) -> Graph:
    """Insert vectors in growing batches; layer heights are geometric, as in one-by-one building.

    A batch is searched in the graph so far and in itself, linked to the diverse best, and its
    links are returned; a vector with too many keeps the diverse best of them.
    """
    n = len(vectors)
    heights = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / math.log(degree))
                         .astype(int), 8)
    heights[0] = heights.max(initial=0)
    top = int(heights.max(initial=0))
    graph = Graph(vectors, [np.full((n, 2 * degree if k == 0 else degree), -1, np.int64)
                            for k in range(top + 1)], 0)
    at = 1
    while at < n:
        batch = np.arange(at, min(n, at + max(1, min(at, 512))))
        queries = vectors[batch]
        among = queries @ queries.T
        np.fill_diagonal(among, -np.inf)
        entry = np.zeros(len(batch), np.int64)
        for level in range(top, -1, -1):
            links = graph.layers[level]
            width = links.shape[1]
            places, scores = _search(vectors, links, queries, entry, beam)
            entry = places[:, 0]
            members = np.flatnonzero(heights[batch] >= level)
            touched: dict[int, list[int]] = {}
            for k in members:
                owner, ok = int(batch[k]), places[k] >= 0
                peers = members[np.argsort(-among[k, members], kind="stable")[:degree]]
                peers = peers[peers != k]
                near = np.concatenate([places[k][ok], batch[peers]])
                close = np.concatenate([scores[k][ok], among[k, peers]])
                own = _linked(vectors, owner, near, close, degree)
                links[owner, :len(own)] = own
                for other in own:
                    touched.setdefault(other, []).append(owner)
            for other, new in touched.items():
                now = [int(x) for x in links[other] if x >= 0]
                every = np.array(list(dict.fromkeys(now + new)))
                if len(every) > width:
                    every = np.array(_linked(vectors, other, every,
                                             vectors[every] @ vectors[other], width))
                links[other] = -1
                links[other, :len(every)] = every
        at = int(batch[-1]) + 1
    return graph


def close_pairs(graph: Graph, queries: np.ndarray, exact: np.ndarray, exact_queries: np.ndarray,
                cosine: float = COSINE, recall: float = RECALL) -> list[np.ndarray]:
    """For each query the places whose cosine, in double precision, reaches the threshold.

    The beam starts at BEAM.  It is doubled for all queries until an audit (AUDIT queries spread
    over all, by brute force) finds the wanted share of true links, and then for those queries
    whose whole beam is close, as more may lie outside it.  What a beam of WIDEST does not settle
    (dense groups, or a graph whose audit fails) is compared with all vectors of the shard, a
    bounded number: one matrix product costs less than a beam as wide as the group.
    """
    n, margin = len(graph.vectors), np.float32(cosine - 1e-5)
    audit = np.unique(np.linspace(0, len(queries) - 1, min(AUDIT, len(queries))).astype(int))
    truth = exact_queries[audit] @ exact.T >= cosine
    beam = BEAM
    while True:
        places, scores = graph.search(queries[audit], beam)
        found = sum(int(truth[k, p[(p >= 0) & (s >= margin)]].sum())
                    for k, (p, s) in enumerate(zip(places, scores)))
        if found >= recall * truth.sum() or beam > WIDEST:
            break
        beam *= 2
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    left = np.arange(len(queries))
    while len(left) and beam <= WIDEST:
        full = []
        for part in np.array_split(left, max(1, -(-len(left) * min(beam, n) // (1 << 20)))):
            places, scores = graph.search(queries[part], beam)
            for q, p, s in zip(part, places, scores):
                if beam < n and p[-1] >= 0 and s[-1] >= margin:
                    full.append(q)
                    continue
                p = p[(p >= 0) & (s >= margin)]
                out[q] = p[exact[p] @ exact_queries[q] >= cosine]
        left, beam = np.array(full, np.int64), beam * 2
    for at in range(0, len(left), 256):
        part = left[at:at + 256]
        for q, row in zip(part, exact_queries[part] @ exact.T >= cosine):
            out[q] = np.flatnonzero(row)
    return out


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; the largest part first, against overflow."""
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _save(ids, copies, values, graph: Graph) -> bytes:
    return _pack({"ids": ids, "copies": copies, "values": values, "entry": np.array(graph.entry),
                  **{f"layer{k}": v.astype(np.int32) for k, v in enumerate(graph.layers)}})


def _load(data: bytes):
    held = np.load(io.BytesIO(data))
    exact = _unit(held["values"].astype(np.float64))
    layers = [held[f"layer{k}"].astype(np.int64) for k in
              range(sum(name.startswith("layer") for name in held.files))]
    graph = Graph(exact.astype(np.float32), layers, int(held["entry"]))
    return held["ids"], held["copies"], exact, graph


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest place of each place's component."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shard: int = SHARD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors are compared when their labels are equal and not null, and their lengths too.  A
    vector that is null, empty, zero, or holds a null or non-finite part links with nothing.
    Equal vectors of a label are one entry with a count, so copies meet only as a number.  Each
    label is dealt into shards by a hash of the id; every shard gets a graph, and every shard's
    vectors are searched in their own graph and in those of the label's later shards.  A task
    returns counts and a spanning forest, never pairs.  A null vec_id is the smallest id; repeated
    rows are vectors of their own.
    """
    rows = keyed(vectors, "embedding", "label", id_column="vec_id")
    parts = F.col("embedding")
    sound = (F.col("label").isNotNull() & parts.isNotNull() & (F.size("embedding") > 0)
             & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists(parts, lambda x: x != 0))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    whole = F.transform(parts, lambda x: x.cast("double"))
    points = (rows.filter("sound").select("id", "label", whole.alias("v"))
              .groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    points = staged(points.withColumn("size", F.size("v")), "vectors")
    # A repeated id with another vector must not share the name of the first: number the points.
    sizes = points.groupBy("label", "size").agg(
        F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("shards"))
    named = points.withColumn("name", F.xxhash64("label", "v"))
    dealt = named.join(sizes, ["label", "size"]).withColumn(
        "shard", F.pmod(F.xxhash64("name", F.lit("shard")), "shards"))

    def index(table: pa.Table) -> pa.Table:
        table = table.sort_by([("name", "ascending"), ("id", "ascending")])
        values = np.array(table["v"].to_pylist(), np.float64)
        graph = build(_unit(values).astype(np.float32))
        data = _save(table["name"].to_numpy(), table["copies"].to_numpy(), values, graph)
        first = table.slice(0, 1)
        return pa.table({"label": first["label"].cast(pa.int64()), "size": first["size"],
                         "shard": first["shard"].cast(pa.int32()),
                         "graph": pa.array([data], pa.binary())})
    dealt = dealt.select("name", "id", "copies", "v", F.col("label").cast("long").alias("label"),
                         "size", F.col("shard").cast("int").alias("shard"))
    shards = staged(dealt.groupBy("label", "size", "shard").applyInArrow(
        index, "label long, size int, shard int, graph binary"), "graphs")
    other = shards.select("label", "size", F.col("shard").alias("other"),
                          F.col("graph").alias("queries"))
    pairs = shards.join(other, ["label", "size"]).filter("other <= shard")

    def search(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                names, copies, exact, graph = _load(row["graph"])
                same = row["shard"] == row["other"]
                asked, weight, points, _ = (names, copies, exact, None) if same else _load(
                    row["queries"])
                hits = close_pairs(graph, points.astype(np.float32), exact, points, cosine)
                q = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
                p = np.concatenate(hits) if len(hits) else np.zeros(0, np.int64)
                if same:  # a link found from either end is a link
                    q, p = q[q != p], p[q != p]
                    both = np.unique(np.concatenate([q * len(names) + p, p * len(names) + q]))
                    q, p = both // len(names), both % len(names)
                    every, degree = names, np.bincount(q, copies[p], len(names))
                    root = names[_spanning(q, p, len(names))]
                else:
                    n = len(names)
                    every = np.concatenate([names, asked])
                    degree = (np.bincount(p, weight[q], n + len(asked))
                              + np.bincount(q + n, copies[p], n + len(asked)))
                    root = every[_spanning(p, q + n, n + len(asked))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every), pa.array(degree.astype(np.int64)), pa.array(root)],
                    ["name", "links", "root"])
    found = staged(pairs.repartition(F.col("label"), F.col("size"), F.col("shard"), F.col("other"))
                   .select("shard", "other", "graph", "queries")
                   .mapInArrow(search, "name long, links long, root long"), "links")
    degree = found.groupBy("name").agg(F.sum("links").alias("links"))
    roots = components(found.selectExpr("name AS a", "root AS b"))
    points = (named.select("name", "id", "copies", "label", "v").join(degree, "name", "left")
              .join(roots, F.col("name") == F.col("node"), "left")
              .withColumn("root", F.coalesce("root", "name")))
    least = points.groupBy("root").agg(F.min("id").alias("component"))
    points = points.join(least, "root").select(
        "label", "v", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .alias("links"))
    keyed_rows = rows.withColumn("v", F.when(F.col("sound"), whole)).select("id", "label", "v")
    done = keyed_rows.join(points, ["label", "v"], "left")
    component = F.coalesce("component", "id")
    return done.select(real_id().alias("vec_id"),
                       F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                       F.when(component != F.lit(-(2 ** 63)), component).alias("component_id"),
                       (component == F.col("id")).alias("kept"))
