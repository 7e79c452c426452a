"""Packing documents into sequences of a fixed number of tokens, by linear grouping.

Only the histogram of piece lengths is planned on the driver: at most ``capacity`` counters,
whatever the number of documents.  The plan says, for ranges of ranks within a length, which
sequence and which place a piece gets; ranks are computed on the cluster.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.frames import keyed, lists, real_id, slices, staged
from sonde.llm.tokens import REMEMBERED, shared_encoder

CAPACITY, END_ID = 1024, 2

# (share, groups): lengths from capacity / share on are grouped, into so many groups of equal
# numbers of pieces.  Each scheme is planned on the histogram; the one with the fewest sequences
# is used, the first of them in a tie.
SCHEMES = ((2, 64), (3, 48), (4, 32), (8, 24))

# Pieces of one length are ranked in parts of about this many.
RANKED = 200_000


@dataclass
class Run:
    """``count`` sequences that hold the same lengths: (length, first rank) per place."""

    count: int
    free: int
    places: list[tuple[int, int, int]] = field(default_factory=list)  # length, first rank, each

    def split(self, count: int) -> Run:
        """Cut off the last ``count`` sequences."""
        keep = self.count - count
        other = Run(count, self.free, [(n, rank + keep * each, each)
                                       for n, rank, each in self.places])
        self.count = keep
        return other


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best multiset of sizes within the capacity (unbounded knapsack)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(sizes.min()), capacity + 1):
        fits = sizes <= room
        gain = np.where(fits, values + best[np.maximum(room - sizes, 0)], -1)
        top = int(gain.argmax())
        best[room] = best[room - 1]
        if gain[top] > best[room] + 1e-12:
            best[room], choice[room] = gain[top], top
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        counts[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return best[capacity], counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   rounds: int = 1000) -> list[tuple[int, np.ndarray]]:
    """(times, counts per size): whole multiples of an optimal fractional mix of configurations.

    Column generation: a revised simplex whose entering column is the knapsack of its prices.
    Rounding the multiples down leaves at most one configuration's worth per size to the caller.
    """
    k = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    level = inverse @ demand
    for _ in range(rounds):
        prices = inverse.sum(0)
        value, counts = _knapsack(sizes, prices, capacity)
        if value <= 1 + 1e-6:
            break
        step = inverse @ counts
        ratio = np.where(step > 1e-9, level / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = counts
        try:
            inverse = np.linalg.inv(columns)
        except np.linalg.LinAlgError:
            break
        level = np.maximum(inverse @ demand, 0)
    left, out = demand.astype(np.int64).copy(), []
    for j in np.argsort(-level):
        counts = columns[:, j].round().astype(np.int64)
        used = counts > 0
        times = min(int(level[j] + 1e-9), int((left[used] // counts[used]).min()))
        if times > 0:
            left -= times * counts
            out.append((times, counts))
    return out


class _Supply:
    """Pieces of each length that are not placed yet, handed out by rising rank."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {n: c for n, c in histogram.items() if c > 0}
        self.next = dict.fromkeys(self.left, 0)

    def take(self, length: int, count: int) -> int:
        rank = self.next[length]
        self.next[length] += count
        self.left[length] -= count
        return rank


def _grouped(supply: _Supply, capacity: int, share: int, groups: int) -> list[Run]:
    """Runs of the grouped large lengths, with actual pieces in place of rounded ones."""
    large = sorted((n for n in supply.left if n * share >= capacity and n < capacity), reverse=True)
    total = sum(supply.left[n] for n in large)
    if not total:
        return []
    # Equal-cardinality groups of the pieces in falling order; a length may span groups.
    width, members, room = -(-total // groups), [[]], -(-total // groups)
    for n in large:
        count = supply.left[n]
        while count:
            if room == 0:
                members.append([])
                room = width
            part = min(count, room)
            members[-1].append([n, part])
            count, room = count - part, room - part
    sizes = np.array([m[0][0] for m in members])
    merged: dict[int, list[int]] = {}
    for g, size in enumerate(sizes.tolist()):
        merged.setdefault(size, []).append(g)
    kinds = sorted(merged, reverse=True)
    queues = [[list(x) for g in merged[s] for x in members[g]] for s in kinds]
    demand = np.array([sum(c for _, c in q) for q in queues], float)
    runs = []
    for times, counts in configurations(np.array(kinds), demand, capacity):
        slots = [q for q, c in enumerate(counts) for _ in range(int(c))]
        ahead = []
        for q in slots:  # each slot draws ``times`` pieces of its group, the longest first
            want, segments = times, []
            while want:
                n, have = queues[q][0]
                part = min(want, have)
                segments.append([n, part])
                queues[q][0][1] -= part
                if not queues[q][0][1]:
                    queues[q].pop(0)
                want -= part
            ahead.append(segments)
        done = 0
        while done < times:  # cut where a slot changes its length
            count = min(s[0][1] for s in ahead)
            run = Run(count, capacity)
            for s in ahead:
                n = s[0][0]
                run.places.append((n, supply.take(n, count), 1))
                run.free -= n
                s[0][1] -= count
                if not s[0][1]:
                    s.pop(0)
            runs.append(run)
            done += count
    return runs


def _best_fit(supply: _Supply, runs: list[Run], capacity: int) -> list[Run]:
    """Best-fit decreasing of what is left, run by run: the tightest run that has room first."""
    rooms: dict[int, list[Run]] = {}
    for run in runs:
        rooms.setdefault(run.free, []).append(run)
    order = sorted(rooms)

    def put(run: Run) -> None:
        if run.free not in rooms:
            rooms[run.free] = []
            bisect.insort(order, run.free)
        rooms[run.free].append(run)

    for n in sorted((n for n, c in supply.left.items() if c), reverse=True):
        while supply.left[n]:
            at = bisect.bisect_left(order, n)
            if at == len(order):
                count = -(-supply.left[n] // (capacity // n))
                put(Run(count, capacity))
                continue
            free = order[at]
            run = rooms[free].pop()
            if not rooms[free]:
                del rooms[free]
                order.pop(at)
            each = min(free // n, supply.left[n])
            count = min(run.count, supply.left[n] // each)
            if count < run.count:
                put(run.split(run.count - count))
            run.places.append((n, supply.take(n, count * each), each))
            run.free -= n * each
            put(run)
    return [r for same in rooms.values() for r in same]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, schemes=SCHEMES) -> list[Run]:
    """Runs of equal sequences for the pieces of a length histogram (lengths 1 to capacity)."""
    best = None
    for share, groups in schemes:
        supply = _Supply(histogram)
        full = supply.left.get(capacity, 0)
        runs = [Run(full, 0, [(capacity, supply.take(capacity, full), 1)])] if full else []
        runs = _best_fit(supply, runs + _grouped(supply, capacity, share, groups), capacity)
        if best is None or sum(r.count for r in runs) < sum(r.count for r in best):
            best = runs
    return best


def placements(runs: list[Run]) -> dict[str, np.ndarray]:
    """Rows of the plan by (length, first rank): how ranks turn into sequences and offsets."""
    rows, base = [], 0
    for run in sorted(runs, key=lambda r: (r.free, r.places)):
        at = 0
        for n, rank, each in run.places:
            rows.append((n, rank, rank + run.count * each, each, base, at))
            at += n * each
        base += run.count
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 6).T
    return dict(zip(["length", "first", "end", "each", "base", "offset"], cols))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           remembered: int = REMEMBERED) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and the end id, cut from the end.

    Only documents of more than ``capacity`` ids are cut; all pieces but the first are full.
    """
    stop = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = shared_encoder(path, "space", remembered)
        for batch in slices(batches):
            ids, texts = lists(batch, "id", "text")
            out = []
            for i, data in zip(ids, encoder.encode(texts)):
                data += stop
                total = len(data) // 4
                first = (total - 1) % capacity + 1
                cuts = [0, *range(first, total + 1, capacity)]
                out += [(i, p, lo, hi - lo, zlib.crc32(data[4 * lo:4 * hi]))
                        for p, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, kinds)],
                ["id", "piece", "start", "length", "ids_crc32"])
    return keyed(docs, "text").mapInArrow(
        run, "id long, piece int, start long, length long, ids_crc32 long")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           schemes=SCHEMES, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences have no gaps from offset 0 and at most ``capacity`` ids.  A null or empty text is
    the end id alone; repeated rows are packed as often as they come; pieces of one length are
    interchangeable, ties go by (doc_id, piece).  A worker keeps the ids of at most ``remembered``
    words between batches, which changes its memory and time, not the result.
    """
    cut = staged(pieces(docs, path, capacity, end_id, remembered), "pieces")
    counts = {r["length"]: r["n"] for r in
              cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = placements(plan(counts, capacity, schemes))
    # Ranks within a length: parts by a hash, numbered inside, after the sizes of earlier parts.
    parts = {n: -(-c // RANKED) for n, c in counts.items()}
    split = [F.lit(x) for n, p in parts.items() if p > 1 for x in (n, p)]
    many = F.coalesce(F.create_map(*split)[F.col("length")], F.lit(1)) if split else F.lit(1)
    salted = cut.withColumn("part", F.pmod(F.xxhash64("id", "piece"), many))
    sizes = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0))
                         .alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "part")
                                .orderBy("id", "piece", "ids_crc32", "start"))
    ranked = (salted.withColumn("place", place).join(sizes, ["length", "part"])
              .withColumn("rank", F.col("place") - 1 + F.col("before")))

    def assign(batches):
        shift = np.int64(1 << 48)
        keys = table["length"] * shift + table["first"]
        for batch in batches:
            col = {n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names)}
            row = np.searchsorted(keys, col["length"] * shift + col["rank"], "right") - 1
            at = col["rank"] - table["first"][row]
            each = table["each"][row]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(table["base"][row] + at // each),
                 pa.array(table["offset"][row] + at % each * col["length"])],
                [*batch.schema.names[:-1], "sequence_id", "offset"])
    kind = "id long, piece int, start long, length long, ids_crc32 long"
    return (ranked.select("id", "piece", "start", "length", "ids_crc32", "rank")
            .mapInArrow(assign, f"{kind}, sequence_id long, offset long")
            .select(real_id().alias("doc_id"), "piece", "start", "length", "ids_crc32",
                    "sequence_id", "offset"))
