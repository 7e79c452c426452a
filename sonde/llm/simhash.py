"""SimHash near-dedup: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.components import components
from sonde.llm.frames import keyed, lists, real_id, slices, staged

SHINGLE, DISTANCE, SEED = 3, 3, 42

# A group of fingerprints that agree on a block key is compared in one task up to this size;
# larger groups get longer keys, so no group above it (or above 2**14 values, all that can agree
# on the longest keys) meets in one task.
GROUP = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a whole text, unsigned; 0 without words.

    Words are runs without ASCII white space, A-Z lower-cased; every shingle counts, repeats
    too; a text with fewer words than a shingle is one shingle.  A bit is set when over half of
    the shingle hashes have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.zeros(len(words), np.int64)
    np.cumsum(length[:-1] + 1, out=start[1:])
    last = max(len(words) - shingle, 0)
    begins = start[:last + 1].tolist()
    ends = (start + length)[len(words) - 1 - last:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(begins), 65536):
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(begins[at:at + 65536], ends[at:at + 65536])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begins), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp) per row; fp is the fingerprint as a signed long."""
    def run(batches):
        for batch in slices(batches):
            ids, texts = lists(batch, "id", "text")
            fps = np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(fps.view(np.int64))], ["id", "fp"])
    return keyed(docs, "text").mapInArrow(run, "id long, fp long")


def _blocks(bits: list[int], parts: int) -> list[int]:
    """Bit positions dealt into masks of nearly equal size."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def block_masks(distance: int) -> list[int]:
    """Masks of which any two fingerprints within ``distance`` bits agree on at least one.

    The bits are cut into distance + 3 blocks.  Differing bits touch at most ``distance`` of
    them, so three blocks are equal, and every choice of three blocks is one mask.
    """
    parts = _blocks(list(range(64)), distance + 3)
    return [a | b | c for a, b, c in combinations(parts, 3)]


def longer_masks(mask: int, distance: int) -> list[int]:
    """Masks that add one of distance + 1 blocks of the free bits: one of those is equal too."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | part for part in _blocks(free, distance + 1) if part]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _forest(fps: np.ndarray, ids: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that span the components of one group: at most one per fingerprint."""
    links, left = [], np.arange(len(fps))
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(front), 256):
                gap = np.bitwise_count(fps[front[at:at + 256], None] ^ fps[left][None, :])
                near |= (gap <= distance).any(0)
            front, left = left[near], left[~near]
            links += [(int(ids[root]), int(i)) for i in ids[front]]
    return links


def _group_links(groups: DataFrame, distance: int) -> DataFrame:
    """Spanning links of every group in an array column ``members`` of (fp, id)."""
    def run(batches):
        for batch in slices(batches, 2048):
            col = batch.column(0)
            sizes = np.diff(col.offsets.to_numpy())
            flat = col.flatten()
            fps = flat.field(0).to_numpy().view(np.uint64)
            ids = flat.field(1).to_numpy()
            ends = np.cumsum(sizes)
            starts = ends - sizes
            pairs = starts[sizes == 2]
            close = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= distance
            a, b = ids[pairs[close]].tolist(), ids[pairs[close] + 1].tolist()
            for lo, hi in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
                for x, y in _forest(fps[lo:hi], ids[lo:hi], distance):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             ["a", "b"])
    return groups.select("members").mapInArrow(run, "a long, b long")


def near_links(points: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Links (a, b) that span the components of ``points`` (id, fp), whose fp are distinct.

    Two points share a component exactly if a chain of points leads from one to the other, each
    at most ``distance`` bits from the next.  Block keys are counted first (combined before the
    shuffle); keys of one point are dropped, keys of up to ``group`` points are compared in
    place, and larger ones are dealt again by longer keys until they are small.
    """
    masks = block_masks(distance)
    rows = points.select("id", "fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
                         .alias("mask"))
    found = None
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
        rows = staged(rows.join(sizes, ["mask", "key"]), "blocks")
        free = 64 - max(bin(m).count("1") for m in masks)
        last = free <= 14
        light = rows if last else rows.filter(F.col("n") <= group)
        groups = light.groupBy("mask", "key").agg(
            F.collect_list(F.struct("fp", "id")).alias("members"))
        links = _group_links(groups, distance)
        found = links if found is None else found.union(links)
        heavy = rows.filter(F.col("n") > group)
        if last or heavy.isEmpty():
            return found.distinct()
        finer = {m: longer_masks(m, distance) for m in masks}
        table = F.create_map(*[F.lit(x) for m, more in finer.items() for x in
                               (_signed(m), [_signed(v) for v in more])])
        rows = heavy.select("id", "fp", F.explode(table[F.col("mask")]).alias("mask"))
        masks = sorted({v for more in finer.values() for v in more})


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE,
                    seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id.

    component_id is the smallest doc_id that links of at most ``distance`` bits reach, the
    document itself included.  Equal fingerprints are one point of the graph, so copies are
    counted once, whatever their number.  A null or empty text has fingerprint zero and links
    like any other; a null doc_id counts as the smallest id; repeated rows stay rows.
    """
    marks = staged(fingerprints(docs, shingle, seed), "fingerprints")
    points = staged(marks.groupBy("fp").agg(F.min("id").alias("id")), "points")
    found = components(near_links(points, distance))
    classes = points.join(found, points["id"] == found["node"], "left").select(
        "fp", F.coalesce("root", "id").alias("root"))
    return marks.join(classes, "fp").select(
        real_id().alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        real_id("root").alias("component_id"))
