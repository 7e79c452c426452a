"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.frames import NULL_ID, keyed, lists, real_id, slices

# A tile has at least TILE words; a document is contaminated by an item when tiles cover at
# least COVERAGE of the item's words.
TILE, COVERAGE = 5, 0.5

# Benchmark text that is held at once, in bytes; a larger benchmark is taken in blocks.
BLOCK_BYTES = 16 << 20

_WORD = re.compile(r"\w+")
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _windows(tokens: list[int], marked: list[bool], size: int):
    """(start, running Karp-Rabin value) of each window without marked or unknown tokens."""
    top, value, clean = pow(_BASE, size, _MOD), 0, 0
    for i, token in enumerate(tokens):
        if marked[i] or token <= 0:
            value = clean = 0
            continue
        value = (value * _BASE + token) % _MOD
        clean += 1
        if clean > size:
            value = (value - tokens[i - size] * top) % _MOD
        if clean >= size:
            yield i - size + 1, value


def tiling(text: list[int], item: list[int], least: int = TILE) -> list[tuple[int, int, int]]:
    """Tiles (start in text, start in item, length): greedy string tiling by running Karp-Rabin.

    Token 0 matches nothing.  Passes with a falling search length mark maximal matches from the
    longest down; a match that an earlier tile has cut is shortened or left to a later pass.
    Ties: the leftmost in the text, then in the item.
    """
    used_text, used_item = [False] * len(text), [False] * len(item)
    tiles, size = [], max(least, min(20, len(item)))
    while True:
        table = defaultdict(list)
        for start, value in _windows(item, used_item, size):
            table[value].append(start)
        matches, longest = [], 0
        reached: dict[int, int] = {}  # diagonal -> end of its last match in the text
        for t, value in _windows(text, used_text, size) if table else ():
            for p in table.get(value, ()):
                if reached.get(t - p, -1) > t:
                    continue
                n = 0
                while (t + n < len(text) and p + n < len(item) and text[t + n] == item[p + n]
                       and text[t + n] > 0 and not used_text[t + n] and not used_item[p + n]):
                    n += 1
                if n >= size:
                    reached[t - p] = t + n
                    matches.append((n, t, p))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for n, t, p in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if any(used_text[t:t + n]) or any(used_item[p:p + n]):
                again = True
                continue
            used_text[t:t + n] = [True] * n
            used_item[p:p + n] = [True] * n
            tiles.append((t, p, n))
        if again and any(True for _ in _windows(item, used_item, size)):
            continue
        if size > 2 * least:
            size //= 2
        elif size > least:
            size = least
        else:
            return sorted(tiles)


@dataclass
class Items:
    """Part of a benchmark: its vocabulary, tokens and seed table."""

    ids: list[int]
    vocabulary: dict[str, int]
    tokens: list[list[int]]
    seeds: np.ndarray          # sorted seed values
    owners: np.ndarray         # item of each seed

    @classmethod
    def build(cls, rows: list[tuple[int, str]], tile: int) -> Items:
        vocabulary: dict[str, int] = {}
        ids, tokens, seeds, owners = [], [], [], []
        for item, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
            own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
            if len(own) < tile:
                continue
            values = np.unique(_seeds(np.array(own, np.uint64), tile))
            seeds.append(values)
            owners.append(np.full(len(values), len(ids)))
            ids.append(item)
            tokens.append(own)
        if not ids:
            return cls([], {}, [], np.zeros(0, np.uint64), np.zeros(0, np.int64))
        values, whose = np.concatenate(seeds), np.concatenate(owners)
        order = np.lexsort((whose, values))
        return cls(ids, vocabulary, tokens, values[order], whose[order])


def _seeds(tokens: np.ndarray, tile: int) -> np.ndarray:
    """Hash of every run of ``tile`` tokens."""
    n = len(tokens) - tile + 1
    value = np.zeros(max(n, 0), np.uint64)
    for i in range(tile if n > 0 else 0):
        value = (value ^ (tokens[i:i + n] + np.uint64(i + 1))) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value


def matched(items: Items, text: str | None, tile: int = TILE,
            coverage: float = COVERAGE) -> list[tuple[int, float, int, int]]:
    """(item id, covered share, covered words, tiles) of the items that a text contains."""
    lookup = items.vocabulary.get
    tokens = np.array([lookup(w, 0) for w in words(text)], np.int64)
    known = tokens > 0
    if len(tokens) < tile or known.sum() < tile:
        return []
    total = np.concatenate([[0], np.cumsum(known)])
    starts = np.flatnonzero(total[tile:] - total[:-tile] == tile)
    if not len(starts):
        return []
    values = _seeds(tokens.astype(np.uint64), tile)[starts]
    first = np.searchsorted(items.seeds, values, "left")
    count = np.searchsorted(items.seeds, values, "right") - first
    found: dict[int, list[int]] = defaultdict(list)
    for at, lo, n in zip(starts[count > 0], first[count > 0], count[count > 0]):
        for k in range(lo, lo + n):
            found[int(items.owners[k])].append(int(at))
    out = []
    for owner, places in sorted(found.items()):
        item = items.tokens[owner]
        if len(places) + tile - 1 < 1:
            continue
        # Only the parts of the text that share a seed can hold a tile: keep those, apart.
        keep = np.zeros(len(tokens) + 1, np.int64)
        for p in places:
            keep[p] += 1
            keep[min(p + tile, len(tokens))] -= 1
        keep = np.cumsum(keep)[:-1] > 0
        part, gap = [], False
        for on, token in zip(keep.tolist(), tokens.tolist()):
            if on:
                part.append(token)
                gap = True
            elif gap:
                part.append(0)
                gap = False
        tiles = tiling(part, item, tile)
        covered = sum(n for _, _, n in tiles)
        if covered >= coverage * len(item):
            out.append((items.ids[owner], covered / len(item), covered, len(tiles)))
    return out


def _blocks(benchmark: DataFrame, tile: int, most: int):
    """The benchmark in blocks of about ``most`` bytes of text at a time."""
    items = keyed(benchmark, "text", id_column="item_id").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // most))
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        yield Items.build([(r["id"], r["text"]) for r in part.toLocalIterator()], tile)


def contaminated(docs: DataFrame, benchmark: DataFrame, tile: int = TILE,
                 coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, coverage, covered_words, n_tiles): one row per document and item found.

    Words are lower-cased runs of letters, digits and underscores.  Documents are read whole and
    never shuffled: seeds of ``tile`` words are looked up in the seed table of the benchmark, and
    each document is tiled against the items it shares a seed with.  The benchmark is the stated
    side; at most about ``block_bytes`` of it are held at a time, a larger one is taken block by
    block over all documents.  Reordered passages count, as tiles may come in any order.
    Null or empty texts match nothing, items of fewer than ``tile`` words cannot be matched,
    repeated items are each reported, repeated documents too.
    """
    source, found = keyed(docs, "text"), None
    for items in _blocks(benchmark, tile, block_bytes):
        def run(batches, items=items):
            for batch in slices(batches):
                out = [(i, *hit) for i, t in zip(*lists(batch, "id", "text"))
                       for hit in matched(items, t, tile, coverage)]
                cols = list(zip(*out)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    ["id", "item", "coverage", "covered_words", "n_tiles"])
        part = source.mapInArrow(
            run, "id long, item long, coverage double, covered_words long, n_tiles long")
        found = part if found is None else found.union(part)
    item = F.when(F.col("item") != F.lit(NULL_ID), F.col("item")).alias("item_id")
    return found.select(real_id().alias("doc_id"), item, "coverage", "covered_words", "n_tiles")
