"""Substring dedup: byte strings of a fixed length that also start earlier, by suffix sorting.

Sorting every suffix of a corpus would move many times its size.  Two exact steps come before:

1. Anchors.  Of the 32-byte grams in a window of ``length`` bytes, the one with the smallest hash
   (the leftmost in a tie) is the window's anchor.  Equal windows have equal anchors, and
   neighbouring windows mostly share one, so a text becomes a few runs of windows per hundred
   bytes.  A run whose anchor gram occurs once in the corpus holds no repeat and is dropped.
2. Equal runs.  Runs with the same bytes are kept once, first in the map task, then in the bucket.

What is left is dealt into buckets by anchor gram, so that equal windows meet, and each bucket's
suffixes are sorted on their own: suffixes are grouped by their first and last eight bytes, and
ties are resolved by ranks of a difference-cover sample of the bucket's text, which were computed
beforehand by doubling.  A task holds one bucket at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.frames import keyed, lists, real_id, slices

LENGTH, GRAM = 100, 32

# A difference cover: every difference modulo 7 is one of two members.
PERIOD, COVER = 7, (1, 2, 4)

# Text bytes per bucket, about; bytes hashed at once; equal runs that a map task remembers.
BUCKET_BYTES, CHUNK, REMEMBERED = 8 << 20, 1 << 20, 200_000

# Rows of text that are looked at together before anything is sent.
BATCH = 2048

_U = np.uint64


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of every gram (a power of two bytes), by doubling."""
    value = (data.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    value ^= value >> _U(31)
    factor, size = 0xBF58476D1CE4E5B9, 1
    while size < gram:
        value = value[:-size] * _U(factor) + value[size:]
        factor, size = factor * factor % 2 ** 64, 2 * size
    value ^= value >> _U(33)
    value *= _U(0xFF51AFD7ED558CCD)
    value ^= value >> _U(32)
    return value


def window_runs(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """(anchor hash, first window, last window) of the runs of windows with one anchor place."""
    out = []
    width = length - gram + 1
    for at in range(0, max(len(data) - length + 1, 0), CHUNK):
        part = np.frombuffer(data, np.uint8, min(len(data) - at, CHUNK + length - 1), at)
        hashes = gram_hashes(part, gram)
        # Hash and place in one number: the smallest is the leftmost of the smallest hashes.
        key = (hashes & ~_U((1 << 22) - 1)) | np.arange(len(hashes), dtype=_U)
        low, size = key, 1
        while 2 * size <= width:
            low, size = np.minimum(low[:-size], low[size:]), 2 * size
        if size < width:
            low = np.minimum(low[:len(key) - width + 1], low[width - size:])
        place = (low & _U((1 << 22) - 1)).astype(np.int64)
        change = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change, [len(place)]]) - 1
        out.append((hashes[place[first]], first + at, last + at))
    return [np.concatenate(c) for c in zip(*out)] if out else None


def _column(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _joined(table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in table[name].to_pylist()] or
                          [np.zeros(0, kind)])


ANCHORS = "bucket int, sure boolean, grams binary, ids binary, marks binary, first binary, " \
          "more binary"


def _anchors(docs: DataFrame, buckets: int, length: int) -> DataFrame:
    """Runs of windows, packed by bucket.  Of the runs of a batch with one gram, only the first
    goes to the gram's bucket, flagged as repeated; the others are known to be repeated."""
    def run(batches):
        for batch in slices(batches, BATCH):
            parts = []
            for i, mark, text in zip(*lists(batch, "id", "mark", "text")):
                runs = window_runs((text or "").encode(), length)
                if runs is not None:
                    n = len(runs[0])
                    parts.append((*runs, np.full(n, i), np.full(n, mark)))
            if not parts:
                continue
            grams, first, last, ids, marks = (np.concatenate(c) for c in zip(*parts))
            _, at, inverse, count = np.unique(grams, return_index=True, return_inverse=True,
                                              return_counts=True)
            head = np.zeros(len(grams), bool)
            head[at] = True
            sure = count[inverse] > 1
            bucket = (grams >> _U(20)) % _U(buckets)
            rows = []
            order = np.flatnonzero(head)
            order = order[np.argsort(bucket[order], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for own in np.split(order, cuts):
                for flag in (False, True):
                    some = own[sure[own] == flag]
                    if len(some):
                        rows.append((int(bucket[some[0]]), flag, some))
            rest = np.flatnonzero(~head)
            for k, some in enumerate(np.array_split(rest, max(1, len(rest) // 4096))):
                if len(some):  # a negative bucket passes through
                    rows.append((-1 - int(bucket[some[0]] + _U(k)) % buckets, True, some))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]),
                 *[_column([c[r[2]].astype(kind) for r in rows]) for c, kind in
                   ((grams, "<u8"), (ids, "<i8"), (marks, "<i8"), (first, "<u4"),
                    (last - first, "<u2"))]],
                ["bucket", "sure", "grams", "ids", "marks", "first", "more"])
    return docs.mapInArrow(run, ANCHORS)


def _repeated_runs(anchors: DataFrame) -> DataFrame:
    """(id, mark, gram, first, last): the runs whose gram occurs more than once."""
    def bucket(table: pa.Table) -> pa.Table:
        grams = _joined(table, "grams", "<u8")
        sizes = [len(b) // 8 for b in table["grams"].to_pylist()]
        sure = np.repeat(np.array(table["sure"].to_pylist(), bool), sizes)
        live = sure
        if table["bucket"][0].as_py() >= 0:
            _, inverse, count = np.unique(grams, return_inverse=True, return_counts=True)
            live = (count > 1) | (np.bincount(inverse, sure) > 0)
            live = live[inverse]
        first = _joined(table, "first", "<u4").astype(np.int64)
        cols = [grams.view(np.int64), _joined(table, "ids", "<i8"), _joined(table, "marks", "<i8"),
                first, first + _joined(table, "more", "<u2")]
        return pa.table([pa.array(c[live]) for c in cols], ["gram", "id", "mark", "first", "last"])
    return anchors.groupBy("bucket").applyInArrow(
        bucket, "gram long, id long, mark long, first long, last long")


def ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(_U)


def _words(data: np.ndarray) -> np.ndarray:
    """Big-endian number of the eight bytes from every place on; zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(_U)
    out = np.zeros(len(data), _U)
    for k in range(8):
        out |= padded[k:k + len(data)] << _U(56 - 8 * k)
    return out


def cover_ranks(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, int]:
    """Ranks of the sample (places whose remainder modulo PERIOD is in COVER) by a prefix.

    The prefix has as many bytes as fit into ``length`` less one period, in whole periods, less
    two; ranks double in depth, as places a period apart are both in the sample.  Places outside
    the sample are 0.  Returns the ranks and the depth.
    """
    depth = (length - 9) // PERIOD * PERIOD
    place = np.flatnonzero(np.isin(np.arange(len(data)) % PERIOD, COVER))
    out = np.zeros(len(data) + length + PERIOD, _U)
    out[place] = ranks(_words(data)[place] >> _U(8)) + _U(1)
    reach = PERIOD
    while reach < depth:
        step = min(reach, depth - reach)
        step -= step % PERIOD
        key = out[place] << _U(32) | out[place + step]
        reach += step
        out[place] = ranks(key) + _U(1)
    return out, depth


def first_equal(data: np.ndarray, starts: np.ndarray, order: np.ndarray,
                length: int = LENGTH) -> np.ndarray:
    """For each window start the smallest order of an equal window, its own included.

    Suffixes are put into buckets by their first eight and last eight bytes.  Ties inside a bucket
    are resolved by sample ranks: two places have a shift of 1 to 7 that brings both into the
    sample, and the ranked bytes from there close the gap between the first and the last eight.
    """
    best = order.copy()
    words = _words(data)
    both = ranks(words[starts]) << _U(32) | ranks(words[starts + length - 8])
    bucket = ranks(both)
    shared = np.flatnonzero(np.bincount(bucket.astype(np.int64))[bucket.astype(np.int64)] > 1)
    if not len(shared):
        return best
    sample, depth = cover_ranks(data, length)
    if 1 + depth < length - 8 or PERIOD + depth > length:
        raise ValueError("the cover does not close the gap for this length")
    classes = [shared[starts[shared] % PERIOD == r] for r in range(PERIOD)]
    for a in range(PERIOD):
        for b in range(a, PERIOD):
            shift = next(s for s in range(1, PERIOD + 1) if (a + s) % PERIOD in COVER
                         and (b + s) % PERIOD in COVER)
            some = classes[a] if a == b else np.concatenate([classes[a], classes[b]])
            if len(some) < 2:
                continue
            key = bucket[some] << _U(32) | sample[starts[some] + shift]
            sort = np.argsort(key, kind="stable")
            key, some = key[sort], some[sort]
            heads = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            low = np.minimum.reduceat(order[some], heads)
            sizes = np.diff(np.append(heads, len(some)))
            best[some] = np.minimum(best[some], np.repeat(low, sizes))
    return best


_KINDS = ("<i8", "<i8", "<u4", "<u4", "<i8")
RUNS = "bucket int, ids binary, marks binary, first binary, sizes binary, grams binary, text binary"
SPANS = "id long, mark long, begin long, stop long"


def _run_texts(docs: DataFrame, runs: DataFrame, buckets: int, length: int) -> DataFrame:
    """The bytes of the repeated runs, packed by bucket; a bucket of -1 holds spans to remove."""
    lists_of = runs.groupBy("id", "mark").agg(
        F.collect_list(F.struct("first", "last", "gram")).alias("runs"))

    def run(batches):
        seen: dict[bytes, tuple] = {}
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, 1024):
            send: dict[int, list] = {}
            gone = []
            ids, marks = lists(batch, "id", "mark")
            texts, column = batch.column(2), batch.column(3)
            for k, (i, mark) in enumerate(zip(ids, marks)):
                data, own = texts[k].as_py().encode(), column[k].values
                for first, last, gram in zip(*(own.field(c).to_pylist() for c in range(3))):
                    part = data[first:last + length]
                    name = hashlib.blake2b(part, digest_size=16).digest()
                    here, before = (i, mark, first), seen.get(name)
                    if before is not None and before <= here:
                        if before != here:
                            gone.append((i, mark, first, last + length))
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[name] = here
                    send.setdefault((gram >> 20) % buckets, []).append((here, gram, part))
            rows = [(b, np.array([h[0] for h, _, _ in r], "<i8"),
                     np.array([h[1] for h, _, _ in r], "<i8"),
                     np.array([h[2] for h, _, _ in r], "<u4"),
                     np.array([len(p) for _, _, p in r], "<u4"),
                     np.array([g for _, g, _ in r], "<i8"),
                     squeeze.compress(b"".join(p for _, _, p in r)))
                    for b, r in send.items()]
            if gone:
                rows.append((-1 - ids[0] % 1024,
                             *[np.array(c, k) for c, k in zip(zip(*gone), _KINDS)],
                             np.zeros(0, "<i8"), b""))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), *[_column(c) for c in cols[1:6]],
                     pa.array(cols[6], pa.binary())],
                    ["bucket", "ids", "marks", "first", "sizes", "grams", "text"])
    joined = docs.join(lists_of, ["id", "mark"]).select("id", "mark", "text", "runs")
    return joined.mapInArrow(run, RUNS)


def _merged(ids, marks, begin, stop) -> pa.Table:
    """Spans of a document that touch, as one."""
    order = np.lexsort((begin, marks, ids))
    ids, marks, begin, stop = (c[order] for c in (ids, marks, begin, stop))
    if len(ids):
        new = np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(marks) != 0)])
        # Ends only grow within a document after a running maximum: all spans are as long or nested.
        group = np.cumsum(new) - 1
        wide = np.maximum.accumulate(stop + group * (1 << 40)) - group * (1 << 40)
        heads = new | np.concatenate([[True], begin[1:] > wide[:-1]])
        at = np.flatnonzero(heads)
        ids, marks, begin = ids[at], marks[at], begin[at]
        stop = np.maximum.reduceat(stop, at)
    return pa.table([pa.array(c) for c in (ids, marks, begin, stop)],
                    ["id", "mark", "begin", "stop"])


def bucket_spans(ids, marks, first, sizes, grams, text: bytes, length: int = LENGTH):
    """Spans of one bucket of runs that equal something earlier: (ids, marks, begin, stop)."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    order = np.lexsort((first, marks, ids))
    seen: dict[bytes, int] = {}
    gone, keep = [], []
    for k in order.tolist():  # equal runs: the earliest stays
        part = text[begins[k]:ends[k]]
        other = seen.setdefault(part, k)
        if other == k:
            keep.append(k)
        elif (ids[other], marks[other], first[other]) != (ids[k], marks[k], first[k]):
            gone.append(k)
    gone, keep = np.array(gone, np.int64), np.array(keep, np.int64)
    out = [(ids[gone], marks[gone], first[gone], first[gone] + sizes[gone])]
    _, inverse, count = np.unique(grams[keep], return_inverse=True, return_counts=True)
    keep = keep[count[inverse] > 1]  # in order of (id, mark, place)
    if len(keep):
        data = np.frombuffer(b"".join(text[begins[k]:ends[k]] for k in keep.tolist()), np.uint8)
        size = sizes[keep]
        base = np.cumsum(size) - size
        windows = size - length + 1
        owner = np.repeat(np.arange(len(keep)), windows)
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        # Runs are in order and no two windows of one place are in different runs.
        place = np.arange(len(owner), dtype=np.int64)
        best = first_equal(data, base[owner] + inside, place, length)
        dup = np.flatnonzero(best < place)
        if len(dup):
            k, at = keep[owner[dup]], first[keep[owner[dup]]] + inside[dup]
            out.append((ids[k], marks[k], at, at + length))
    return tuple(np.concatenate(c) for c in zip(*out))


def _spans(texts: DataFrame, length: int) -> DataFrame:
    def bucket(table: pa.Table) -> pa.Table:
        cols = [_joined(table, c, k).astype(np.int64) for c, k in
                zip(("ids", "marks", "first", "sizes", "grams"), _KINDS)]
        if table["bucket"][0].as_py() < 0:
            return _merged(*cols[:4])
        expand = zstandard.ZstdDecompressor()
        text = b"".join(expand.decompress(t) for t in table["text"].to_pylist())
        return _merged(*bucket_spans(*cols, text, length))
    return texts.groupBy("bucket").applyInArrow(bucket, SPANS)


def removed(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a smaller
    doc_id, or earlier in the same document.  A null text is empty and a null doc_id the smallest.
    Rows with the same doc_id and text are one document, reported once per row; rows with the same
    doc_id and other texts are documents of their own, in the order of a hash of the text.
    """
    rows = keyed(docs, "text").select("id", F.xxhash64("text").alias("mark"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, -(-size // bucket_bytes))
    runs = _repeated_runs(_anchors(rows, buckets, length))
    spans = _spans(_run_texts(rows, runs, buckets, length), length)
    gone = spans.groupBy("id", "mark").agg(
        F.collect_list(F.struct("begin", "stop")).alias("spans"))

    def cut(batches):
        for batch in slices(batches, 256):
            out = []
            for i, text, own in zip(*lists(batch, "id", "text", "spans")):
                data, done, kept, n, total = (text or "").encode(), 0, hashlib.sha256(), 0, 0
                for a, b in sorted((s["begin"], s["stop"]) for s in own or ()):
                    if a > done or n == 0:
                        kept.update(data[done:a])
                        n += 1
                        done = a
                    if b > done:
                        total += b - done
                        done = b
                kept.update(data[done:])
                out.append((i, len(data), total, n, kept.hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, kinds)],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return (rows.join(gone, ["id", "mark"], "left").select("id", "text", "spans").mapInArrow(
        cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        .select(real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"))
