"""Substring dedup by paragraph MinHash banding, exact Jaccard and components.

Paragraphs are cut where the words themselves say so: behind a word pair whose hash is the least
among its neighbours.  A passage is therefore cut in the same way wherever it stands, whatever
lines and sentences surround it, and every word of a text belongs to one paragraph.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonde.cluster import small_side
from sonde.llm.components import components
from sonde.llm.frames import keyed, lists, real_id, slices, staged

SHINGLE, SIMILARITY = 5, 0.8

# A paragraph ends where a word pair's hash is the least of those this many words to either side:
# paragraphs have more words than this (shorter texts excepted), and twice as many on average.
REACH = 7

# Words a repeated passage has at least; two paragraphs side by side always have as many.
PASSAGE = 15

# Wanted chance that a pair at the threshold collides, and hashes of a band.
RECALL, ROWS = 0.995, 2

# Paragraphs a task remembers, so that it passes on the keys of each only once.
MET = 500_000

# Candidates that are compared in one group.  A larger component is dealt by rare shingles first; what
# is still larger is compared block by block.
BLOCK = 4096

# White space by code point; no character above these is white space.
_WHITE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Fewest bands of ``rows`` hashes that reach the recall for pairs at the threshold."""
    bands = 1
    while 1 - (1 - similarity ** rows) ** bands < recall:
        bands += 1
    return bands


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from the words' hashes."""
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = _mixed(total + words[k:len(words) - size + 1 + k])
    return total


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of lower-cased words."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w.encode("utf-8", "replace")) for w in words], np.uint64)


def word_spans(text: str) -> np.ndarray:
    """Start and end of every word, one row each (code points, end exclusive)."""
    points = (np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.minimum(
        np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), len(_WHITE) - 1))
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = ~_WHITE[points]
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)


def words_of(text: str) -> np.ndarray:
    """Hashes of the lower-cased words."""
    # Lower-casing may change a word's length, so words are cut out first.
    return word_hashes(text.lower().split() if text.isascii() else [w.lower() for w in text.split()])


def cuts(words: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Numbers of words before each cut, 0 and the number of all words included.

    A cut lies behind word k if the hash of words k and k + 1 is less than those of the ``reach``
    pairs before, and not greater than those of the ``reach`` pairs after it, all of which exist.
    """
    n = len(words) - 1 - 2 * reach
    if n < 1:
        return np.unique([0, len(words)])
    pairs, least = _grams(words, 2), np.ones(n, bool)
    middle = pairs[reach:reach + n]
    for k in range(1, reach + 1):
        least &= (middle < pairs[reach - k:][:n]) & (middle <= pairs[reach + k:][:n])
    return np.concatenate([[0], np.flatnonzero(least) + reach + 1, [len(words)]])


def split(text: str | None, reach: int = REACH):
    """Word places (code points, end exclusive), the words' hashes, and the cuts between them."""
    text = text or ""
    words = words_of(text)
    return word_spans(text), words, cuts(words, reach)


def shingles_of(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the word shingles; fewer words are one shingle."""
    return _grams(words, min(size, len(words)))


def nodes_of(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of the paragraphs between the cuts: 64-bit sums over their words and word places."""
    if len(ends) < 2:
        return np.zeros(0, np.int64)
    place = np.arange(len(words)) - np.repeat(ends[:-1], np.diff(ends)) + 1
    mixed = _mixed(words + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _mixed(np.add.reduceat(mixed, ends[:-1])).view(np.int64)


def shingled(words: np.ndarray, ends: np.ndarray, size: int = SHINGLE):
    """Shingle hashes of all paragraphs in a row, and how many each has."""
    lengths = np.diff(ends)
    if len(lengths) == 0 or lengths.min() < size:
        parts = [shingles_of(words[a:b], size) for a, b in zip(ends[:-1], ends[1:])]
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint64),
                np.array([len(p) for p in parts], np.int64))
    # No shingle crosses a cut: those that begin in a paragraph's last words are left out.
    inside = np.ones(len(words) - size + 1, bool)
    for k in range(1, size):
        inside[ends[1:-1] - k] = False
    return _grams(words, size)[inside], lengths - size + 1


def _multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(11).integers(1, 2 ** 63, count).astype(np.uint64) * 2 + 1


def band_keys(flat: np.ndarray, counts: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per set and band, from the minima of ``rows`` hash functions.

    The sets lie in ``flat`` one behind the other, ``counts`` numbers each (none is empty).
    """
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    factors = _multipliers(bands * rows)
    keys = np.empty((len(counts), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(counts), b + 1, np.uint64)
        for k in range(rows):
            mixed = flat * factors[b * rows + k]
            low = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
            key = (key ^ low) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        keys[:, b] = key
    return keys


def occurrences(docs: DataFrame, bands: int, shingle: int = SHINGLE, reach: int = REACH
                ) -> DataFrame:
    """(id, number, begin, stop, words, node, bands): every paragraph of every text.

    ``bands`` is null where the same task has just met the paragraph: copies are combined before
    any shuffle.
    """
    names = ["id", "number", "begin", "stop", "words", "node", "bands"]

    def run(batches):
        met: set[int] = set()
        for batch in slices(batches, 128):
            columns = {n: [np.zeros(0, np.int64)] for n in names[:-1]}
            sets, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, text in zip(*lists(batch, "id", "text")):
                found, words, ends = split(text, reach)
                n = len(ends) - 1
                if n == 0:
                    continue
                for name, values in zip(columns, (
                        np.full(n, i), np.arange(n), found[ends[:-1], 0], found[ends[1:] - 1, 1],
                        np.diff(ends), nodes_of(words, ends))):
                    columns[name].append(np.asarray(values, np.int64))
                for out, part in zip((sets, counts), shingled(words, ends, shingle)):
                    out.append(part)
            columns = {n: np.concatenate(v) for n, v in columns.items()}
            flat, count, node = np.concatenate(sets), np.concatenate(counts), columns["node"]
            new = np.zeros(len(node), bool)
            for k, name in enumerate(node.tolist()):
                if name not in met:
                    new[k] = True
                    met.add(name)
            if len(met) > MET:
                met = set()
            keys = np.zeros((0, bands), np.int64)
            if new.any():
                keys = band_keys(flat[np.repeat(new, count)], count[new], bands).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(new) * bands]).astype(np.int32)
            given = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))
            given = pa.ListArray.from_buffers(
                given.type, len(given),
                [pa.py_buffer(np.packbits(new, bitorder="little").tobytes()), given.buffers()[1]],
                children=[given.values])
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(columns[n], k) for n, k in zip(names, kinds)], given], names)
    return keyed(docs, "text").mapInArrow(
        run, "id long, number int, begin long, stop long, words int, node long, bands array<long>")


def _similar(nodes: np.ndarray, sets: list[np.ndarray], similarity: float, asked=None
             ) -> list[tuple[int, int]]:
    """Links that span the exact components of the sets at the Jaccard similarity.

    A set (or one of those ``asked``) is compared, through an inverted index of the shingles, with
    those that share some.  Without ``asked``, the sets of the largest component so far are not
    asked: each set outside is, and those inside hang together already.
    """
    n, least = len(sets), similarity - 1e-12
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    edge = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]]))
    # Shingles of one set only decide nothing; the others are numbered.
    number = np.empty(len(flat), np.int64)
    number[order] = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    starts = np.concatenate([[0], np.cumsum(size)])
    root, weight, links = np.arange(n), np.ones(n, np.int64), []
    left = np.full(n, asked is None)
    if asked is not None:
        left[asked] = True
    while True:
        largest = int(weight.argmax())
        wanted = left & (root != largest) if asked is None else left
        i = int(wanted.argmax())
        if not wanted[i] or weight[largest] == n:
            return links
        left[i] = False
        own = number[starts[i]:starts[i + 1]]
        own = own[edge[own + 1] - edge[own] > 1]
        if len(own) == 0:
            continue
        hits = np.concatenate([owner[edge[k]:edge[k + 1]] for k in own.tolist()])
        shared = np.bincount(hits, minlength=n)
        near = np.flatnonzero(shared >= least * (size + size[i] - shared))
        near = near[root[near] != root[i]]
        for other, at in zip(*np.unique(root[near], return_index=True)):
            links.append((int(nodes[i]), int(nodes[near[at]])))
            weight[root[i]] += weight[other]
            weight[other] = 0
            root[root == other] = root[i]


def _similar_pairs(flat: np.ndarray, size: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs of sets, one behind the other in ``flat``, reach the similarity."""
    pair = np.repeat(np.arange(len(size)) // 2, size)
    order = np.lexsort((flat, pair))
    flat, pair = flat[order], pair[order]
    both = pair[1:][(flat[1:] == flat[:-1]) & (pair[1:] == pair[:-1])]
    shared = np.bincount(both, minlength=len(size) // 2)
    return shared >= (similarity - 1e-12) * (size[::2] + size[1::2] - shared)


def _verified(groups: DataFrame, similarity: float) -> DataFrame:
    """Links of every group in an array column ``members`` of (node, shingles, first)."""
    def run(batches):
        for batch in slices(batches, 256):
            counts = pc.list_value_length(batch.column(0)).to_numpy().astype(np.int64)
            members = batch.column(0).flatten()
            nodes = members.field("node").to_numpy()
            first = members.field("first").to_numpy(zero_copy_only=False)
            size = pc.list_value_length(members.field("shingles")).to_numpy().astype(np.int64)
            flat = members.field("shingles").flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(size)
            two = np.repeat(counts == 2, counts)
            good = _similar_pairs(flat[np.repeat(two, size)], size[two], similarity)
            a, b = [nodes[two][::2][good]], [nodes[two][1::2][good]]
            for hi, n in zip(np.cumsum(counts).tolist(), counts.tolist()):
                if n == 2:
                    continue
                lo = hi - n
                sets = np.split(flat[ends[lo] - size[lo]:ends[hi - 1]],
                                np.cumsum(size[lo:hi - 1]))
                # Of two blocks one is asked about the other; each by itself is a group too.
                asked = None if first[lo:hi].all() else np.flatnonzero(first[lo:hi])
                found = np.array(_similar(nodes[lo:hi], sets, similarity, asked), np.int64)
                a.append(found.reshape(-1, 2)[:, 0])
                b.append(found.reshape(-1, 2)[:, 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())],
                ["a", "b"])
    return groups.select("members").mapInArrow(run, "a long, b long")


def rare_shingles(sets: DataFrame, similarity: float) -> DataFrame:
    """(root, token, node, shingles): each set beside the rarest of its shingles.

    Of n shingles a similar set has ceil(similarity x n) at least, so two similar sets share one of
    those that are left of each when all but one of so many, the commonest, are taken away.
    """
    each = sets.select("root", "node", F.explode("shingles").alias("token"))
    common = each.groupBy("token").agg(F.count("*").alias("sets"))
    few = F.size("ranked") - F.ceil(F.size("ranked") * F.lit(similarity) - F.lit(1e-6)).cast("int") + 1
    ranked = each.join(common, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("ranked"))
    rare = ranked.select("node", F.explode(F.slice("ranked", 1, few)["token"]).alias("token"))
    return sets.join(rare, "node").select("root", "token", "node", "shingles")


def candidate_groups(sets: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """An array column ``members`` of (node, shingles, first): all pairs of one root that may be
    similar meet in one of the groups.

    A root of up to ``block`` sets is one group.  Those of a larger root meet by their rare
    shingles; more than ``block`` sets of one such shingle are dealt by pairs of blocks.
    """
    none, key = F.lit(0).cast("long"), ["root", "token"]

    def larger(rows, *by):
        return small_side(rows.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") > block))

    def grouped(rows, own, other):
        return rows.select(
            *key, F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi"),
            F.struct("node", "shingles", (own <= other).alias("first")).alias("member"))

    roots = larger(sets, "root")
    small = sets.join(roots, "root", "left_anti").withColumn("token", none)
    rare = staged(rare_shingles(sets.join(roots, "root", "left_semi"), similarity), "rare")
    hot = larger(rare, *key)
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    dealt = (rare.join(hot, key).withColumn("own", F.pmod(F.xxhash64("node"), blocks))
             .withColumn("other", F.explode(F.sequence(none, blocks - 1))))
    rows = (grouped(small, none, none).union(grouped(rare.join(hot, key, "left_anti"), none, none))
            .union(grouped(dealt, F.col("own"), F.col("other"))))
    return rows.groupBy(*key, "lo", "hi").agg(F.collect_list("member").alias("members")).filter(
        F.size("members") > 1)


def near_links(docs: DataFrame, found: DataFrame, shingle: int = SHINGLE,
               similarity: float = SIMILARITY, reach: int = REACH, block: int = BLOCK
               ) -> DataFrame:
    """Links (a, b) between nodes at the similarity or more, enough to span their components.

    Nodes that share a band key are candidates.  Candidates that hang together are compared exactly
    (``candidate_groups``); no task holds more than two blocks of a group.
    """
    keys = found.select("node", F.explode("bands").alias("band"))
    # One shuffle and no join: the least node of a band is the first of its sorted rows.
    low = F.first("node").over(Window.partitionBy("band").orderBy("node"))
    stars = keys.withColumn("low", low).filter("node <> low").selectExpr("node AS a", "low AS b")
    groups = staged(components(stars), "candidates")
    # Of each candidate one paragraph is read again, and no other part of its text.
    wanted = (found.select("node", "id", "number", "begin", "stop").join(groups, "node")
              .groupBy("node", "root")
              .agg(F.min(F.struct("id", "number", "begin", "stop")).alias("first")))
    wanted = staged(wanted.groupBy(F.col("first.id").alias("id")).agg(F.collect_list(F.struct(
        "first.begin", "first.stop", "node", "root")).alias("wanted")), "wanted")

    def run(batches):
        for batch in slices(batches, 128):
            roots, nodes, sets = [], [], []
            for text, own in zip(*lists(batch, "text", "wanted")):
                for w in own:
                    words = words_of((text or "")[w["begin"]:w["stop"]])
                    # Repeated rows of an id may hold another text.
                    if w["node"] in nodes_of(words, np.unique([0, len(words)])):
                        roots.append(w["root"])
                        nodes.append(w["node"])
                        sets.append(np.unique(shingles_of(words, shingle)).view(np.int64))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(roots, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["root", "node", "shingles"])
    sets = staged(keyed(docs, "text").join(wanted, "id").select("text", "wanted").mapInArrow(
        run, "root long, node long, shingles array<long>").dropDuplicates(["node"]), "sets")
    # Groups are small in bytes and long in work: they are dealt over many tasks, not gathered.
    tasks = docs.sparkSession.sparkContext.defaultParallelism * 8
    return _verified(candidate_groups(sets, similarity, block).repartition(tasks), similarity)


def repeated(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY,
             reach: int = REACH, recall: float = RECALL) -> DataFrame:
    """One row per paragraph to remove: doc_id, paragraph, start, end, n_words, kept_doc_id,
    kept_paragraph.

    Paragraphs are linked when their lower-cased words are equal or the Jaccard similarity of their
    word shingles reaches the threshold; of each component the first paragraph by (doc_id, number)
    stays.  All words are judged, whatever line or sentence they stand in; a long run of one word is
    one paragraph.  A repeat of fewer than PASSAGE words, with no repeat beside it, is a common phrase
    or line and no passage: it stays.  Null or empty texts have no paragraphs; a null doc_id comes first; in repeated rows of
    one doc_id each paragraph counts once.
    """
    if 2 * (reach + 1) < PASSAGE:
        raise ValueError("two paragraphs side by side must have the words of a passage")
    found = staged(occurrences(docs, bands_for(similarity, recall), shingle, reach), "paragraphs")
    links = near_links(docs, found, shingle, similarity, reach)
    roots = components(links)
    rows = found.select("id", "number", "begin", "stop", "words", "node")
    # Nodes first: one row per text, combined before the shuffle, decides what stays.
    nodes = rows.groupBy("node").agg(F.min(F.struct("id", "number")).alias("first"),
                                     F.count("*").alias("n"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = nodes.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("total"))
    judged = (nodes.join(kept.filter("total > 1"), "root").select("node", "kept"))
    gone = staged(rows.join(judged, "node").filter(
        (F.col("id") != F.col("kept.id")) | (F.col("number") != F.col("kept.number"))), "gone")
    # A paragraph beside another one to remove is part of a longer passage.
    beside = gone.select("id", F.explode(F.array(F.col("number") - 1, F.col("number") + 1)).alias(
        "number")).distinct().withColumn("more", F.lit(True))
    gone = gone.join(beside, ["id", "number"], "left").filter(
        (F.col("words") >= PASSAGE) | F.col("more"))
    return gone.select(
        real_id().alias("doc_id"), F.col("number").alias("paragraph"),
        F.col("begin").alias("start"), F.col("stop").alias("end"), F.col("words").alias("n_words"),
        real_id("kept.id").alias("kept_doc_id"), F.col("kept.number").alias("kept_paragraph"))
