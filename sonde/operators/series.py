"""Ordered operators on keyed series: fills, lags, positions, sliding windows, running totals.

A series may hold any share of the table (with no key the table is one series), so no window
here relies on a whole series fitting one task.  ``cut_series`` splits every long series at
points of its own order into chunks of bounded size.  Windows then run per (key, chunk), and a
small per-chunk summary carries values over the chunk borders.  Short series, the usual case,
stay whole and cost one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.cluster import BROADCAST_ROWS, checkpointed
from sonde.functions import col, lookup, present

ROWS_PER_CHUNK = 1_000_000
MAX_CHUNKS = 100_000
SAMPLES_PER_CHUNK = 32
FEW_CUTS = 32

_CHUNK = "_chunk"
_CUTS = "_cuts"


@dataclass
class Chunked:
    """A table with a chunk number per row.

    ``chunks`` bounds the number of chunks of cut series; 0 means that no series was cut.
    Rows of uncut series carry chunk -1.
    """

    df: DataFrame
    keys: list[str]
    order: list[str]
    chunks: int

    @property
    def part(self) -> list[Column]:
        return [col(k) for k in self.keys] + ([col(_CHUNK)] if self.chunks else [])

    @property
    def window(self):
        return Window.partitionBy(*self.part).orderBy(*[col(o) for o in self.order])

    @property
    def cut_rows(self) -> DataFrame:
        return self.df.filter(col(_CHUNK) >= 0)

    def over_chunks(self):
        return Window.partitionBy(*[col(k) for k in self.keys]).orderBy(col(_CHUNK))

    def attach(self, df: DataFrame, summary: DataFrame) -> DataFrame:
        """Join a table of one row per chunk of cut series to the rows."""
        if self.chunks <= BROADCAST_ROWS:
            summary = F.broadcast(summary)
        return lookup(df, summary, self.keys + [_CHUNK])


def cuts_at_or_before(cuts: Column, point: Column, longest: int) -> Column:
    """Number of cut points that are not after ``point``.

    A few cuts are compared one by one in generated code, many by bisection of the sorted array.
    """
    if longest <= FEW_CUTS:
        return sum((F.coalesce(F.get(cuts, F.lit(i)) <= point, F.lit(False)).cast("int")
                    for i in range(longest)), F.lit(0))
    steps = math.ceil(math.log2(longest + 1)) + 1
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))

    def halve(state, _):
        mid = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        return F.when(state["lo"] >= state["hi"], state).when(
            F.get(cuts, mid) <= point, F.struct((mid + 1).alias("lo"), state["hi"].alias("hi"))
        ).otherwise(F.struct(state["lo"].alias("lo"), mid.alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"])


def cut_series(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               rows_per_chunk: int | None = None) -> Chunked:
    """Split long series into chunks of about ``rows_per_chunk`` rows.

    A table with no more rows than one chunk needs no cut, which one count proves.  Otherwise
    every row whose hash falls in a fixed residue class is a sample, and every 32nd sample of a
    series, in order, is a cut point.  Samples only choose where to cut: every row is kept.  The
    hash depends on the row alone, so a lost task recomputes the same chunks.  The chunk size
    grows with the table so that there are at most about 100,000 cut points.  Rows that tie on
    the whole order stay together, so the order should end in a unique column.
    """
    keys, order = list(keys), list(order)
    total = df.count()
    size = max(rows_per_chunk or ROWS_PER_CHUNK, math.ceil(total / MAX_CHUNKS))
    if total <= size:
        return Chunked(df, keys, order, 0)

    samples = min(SAMPLES_PER_CHUNK, size)
    spacing = max(1, size // samples)
    names = keys + order
    by_key = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(o) for o in order])
    point = F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)])
    cuts = (
        df.select(*[col(n) for n in names])
        .filter(F.pmod(F.xxhash64(*[col(n) for n in names]), F.lit(spacing)) == 0)
        .withColumn("_n", F.row_number().over(by_key))
        .filter(F.col("_n") % samples == 0)
        .groupBy(*[col(k) for k in keys])
        .agg(F.sort_array(F.collect_list(point)).alias(_CUTS))
    )
    cuts = checkpointed(cuts.filter(F.size(_CUTS) > 0))
    found = cuts.agg(F.sum(F.size(_CUTS)), F.count("*"), F.max(F.size(_CUTS))).first()
    points, series, longest = (found[0] or 0), found[1], (found[2] or 0)
    if points == 0:
        return Chunked(df, keys, order, 0)
    if keys:
        side = F.broadcast(cuts) if points <= BROADCAST_ROWS else cuts
        joined = lookup(df, side, keys)
    else:
        joined = df.withColumn(_CUTS, cuts.select(_CUTS).scalar())
    chunk = F.when(F.col(_CUTS).isNull(), F.lit(-1)).otherwise(
        cuts_at_or_before(F.col(_CUTS), point, longest))
    return Chunked(joined.withColumn(_CHUNK, chunk).drop(_CUTS), keys, order, points + series)


def fill_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                rows_per_chunk: int | None = None, start: bool = True) -> DataFrame:
    """Add ``_f_<c>``, the last value so far, and ``_s_<c>``, the first value of the series.

    Where there is no value so far, the next value is the first one of the series.  So a backward
    fill after a forward fill needs no second sort: both frames share one window.  NaN is no value.
    """
    df = df.select(*[present(df, c) if c in cols else col(c) for c in df.columns])
    ch = cut_series(df, keys, order, rows_per_chunk)
    so_far = ch.window.rowsBetween(Window.unboundedPreceding, 0)
    whole = ch.window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    added = {f"_f_{c}": F.last(col(c), ignorenulls=True).over(so_far) for c in cols}
    if start:
        added |= {f"_s_{c}": F.first(col(c), ignorenulls=True).over(whole) for c in cols}
    out = ch.df.withColumns(added)
    if not ch.chunks:
        return out

    at = F.struct(*[col(o) for o in order])
    ends = (("_last_", F.max_by), ("_first_", F.min_by)) if start else (("_last_", F.max_by),)
    edges = ch.cut_rows.groupBy(*ch.part).agg(*[
        pick(col(c), F.when(col(c).isNotNull(), at)).alias(f"{tag}{c}")
        for c in cols for tag, pick in ends])
    before = ch.over_chunks().rowsBetween(Window.unboundedPreceding, -1)
    ever = ch.over_chunks().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = {f"_prev_{c}": F.last(col(f"_last_{c}"), ignorenulls=True).over(before)
               for c in cols}
    if start:
        carried |= {f"_start_{c}": F.first(col(f"_first_{c}"), ignorenulls=True).over(ever)
                    for c in cols}
    out = ch.attach(out, edges.select(*ch.part, *[e.alias(n) for n, e in carried.items()]))
    done = {f"_f_{c}": F.coalesce(col(f"_f_{c}"), col(f"_prev_{c}")) for c in cols}
    if start:
        # Chunk -1 is an uncut series, whose own first value is the one of the series.
        done |= {f"_s_{c}": F.coalesce(col(f"_start_{c}"), col(f"_s_{c}")) for c in cols}
    return out.withColumns(done).drop(*carried, _CHUNK)


def ffill_bfill(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
                rows_per_chunk: int | None = None, backward: bool = True) -> DataFrame:
    """Fill nulls with the last earlier value of the series, then with the next later one."""
    cols = list(cols)
    wide = fill_values(df, cols, keys, order, rows_per_chunk, start=backward)
    tags = ["_f_", "_s_"] if backward else ["_f_"]
    return wide.select(*[
        F.coalesce(*[col(f"{t}{c}") for t in tags]).alias(c) if c in cols else col(c)
        for c in df.columns
    ])


def _tails(ch: Chunked, payload: Column, depth: int) -> DataFrame:
    """Per chunk of a cut series: the last ``depth`` payloads of the rows before the chunk."""
    at = F.struct(*[col(o) for o in ch.order])
    last_rows = (
        ch.cut_rows.select(*ch.part, at.alias("_at"), payload.alias("_v"))
        .withColumn("_n", F.row_number().over(
            Window.partitionBy(*ch.part).orderBy(F.col("_at").desc())))
        .filter(F.col("_n") <= depth)
        .groupBy(*ch.part)
        .agg(F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("_rows"))
    )
    # Every chunk has at least one row, so the previous ``depth`` chunks reach far enough.
    earlier = ch.over_chunks().rowsBetween(-depth, -1)
    joined = F.flatten(F.collect_list(F.transform("_rows", lambda r: r["_v"])).over(earlier))
    return last_rows.select(*ch.part, F.when(
        F.size(joined) > depth, F.slice(joined, -depth, depth)).otherwise(joined).alias("_tail"))


def lag_features(df: DataFrame, column: str, depth: int, keys: Sequence[str],
                 order: Sequence[str], rows_per_chunk: int | None = None,
                 drop_incomplete: bool = True) -> DataFrame:
    """Add ``<column>_lag1`` .. ``_lag<depth>`` and drop the rows in which one of them is null."""
    ch = cut_series(df, keys, order, rows_per_chunk)
    lags = {f"{column}_lag{k}": F.lag(col(column), k).over(ch.window)
            for k in range(1, depth + 1)}
    out = ch.df.withColumns(lags)
    if ch.chunks:
        # The payload is wrapped because collected arrays drop nulls.
        tails = _tails(ch, F.struct(col(column).alias("v")), depth)
        out = ch.attach(ch.df.withColumns(
            {**lags, "_rn": F.row_number().over(ch.window)}), tails)
        for k in range(1, depth + 1):
            name = f"{column}_lag{k}"
            reach = F.size("_tail") - F.lit(k) + F.col("_rn") - 1
            out = out.withColumn(name, F.when(F.col("_rn") > k, col(name)).when(
                (F.col("_chunk") >= 0) & (reach >= 0), F.get(F.col("_tail"), reach)["v"]))
        out = out.drop("_rn", "_tail", _CHUNK)
    return out.na.drop(subset=[f"`{n}`" for n in lags]) if drop_incomplete else out


def sequence_windows(df: DataFrame, features: Sequence[str], target: str, length: int,
                     keys: Sequence[str], order: Sequence[str],
                     rows_per_chunk: int | None = None) -> DataFrame:
    """Every run of ``length`` rows of a series, with the target of its last row.

    Output: keys, order columns of the last row, ``sequence`` (array of feature arrays) and the
    target.  Series shorter than ``length`` give nothing.
    """
    ch = cut_series(df, keys, order, rows_per_chunk)
    step = F.array(*[col(f).cast("double") for f in features])
    frame = ch.window.rowsBetween(-(length - 1), 0)
    seq = F.collect_list(step).over(frame)
    out = ch.df.withColumn("sequence", seq)
    if ch.chunks:
        out = ch.attach(out, _tails(ch, step, length - 1)) if length > 1 else (
            out.withColumn("_tail", F.lit(None)))
        whole = F.concat(F.coalesce("_tail", F.array()), "sequence")
        out = out.withColumn("sequence", F.when(
            F.size(whole) > length, F.slice(whole, -length, length)).otherwise(whole))
    return out.filter(F.size("sequence") == length).select(
        *[col(k) for k in keys], *[col(o) for o in order], "sequence", col(target))


def running_total(df: DataFrame, values: Sequence[str], keys: Sequence[str],
                  order: Sequence[str], rows_per_chunk: int | None = None) -> DataFrame:
    """Add ``cum_<v>``: the sum of ``v`` up to and including the row, in order, per key."""
    ch = cut_series(df, keys, order, rows_per_chunk)
    so_far = ch.window.rowsBetween(Window.unboundedPreceding, 0)
    out = ch.df.withColumns({f"cum_{v}": F.sum(col(v)).over(so_far) for v in values})
    if not ch.chunks:
        return out
    before = ch.over_chunks().rowsBetween(Window.unboundedPreceding, -1)
    base = (
        ch.cut_rows.groupBy(*ch.part).agg(*[F.sum(col(v)).alias(f"_s_{v}") for v in values])
        .select(*ch.part, *[F.sum(col(f"_s_{v}")).over(before).alias(f"_base_{v}")
                            for v in values])
    )
    out = ch.attach(out, base)
    zero = F.lit(0)
    return out.withColumns({
        f"cum_{v}": col(f"cum_{v}") + F.coalesce(col(f"_base_{v}"), zero) for v in values
    }).drop(*[f"_base_{v}" for v in values], _CHUNK)


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position",
             rows_per_chunk: int | None = None) -> DataFrame:
    """Add the 0-based place of every row in its series."""
    ones = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), ["_one"], keys, order,
                         rows_per_chunk)
    return ones.withColumn(name, F.col("cum__one") - 1).drop("_one", "cum__one")


def time_diff(df: DataFrame, ts: str, keys: Sequence[str], order: Sequence[str],
              name: str = "time_diff", rows_per_chunk: int | None = None) -> DataFrame:
    """Add the seconds since the previous row of the series; null in its first row."""
    lagged = lag_features(df.withColumn("_ts", col(ts)), "_ts", 1, keys, order, rows_per_chunk,
                          drop_incomplete=False)
    micros = F.timestamp_diff("MICROSECOND", F.col("_ts_lag1"), col(ts))
    return lagged.withColumn(name, micros / F.lit(1e6)).drop("_ts", "_ts_lag1")


def mean_time_step(df: DataFrame, ts: str, keys: Sequence[str],
                   name: str = "avg_step_seconds") -> DataFrame:
    """Mean seconds between consecutive rows of a series.

    Steps telescope, so the mean is the span over the number of steps: one aggregate, no window.
    """
    span = F.timestamp_diff("MICROSECOND", F.min(col(ts)), F.max(col(ts)))
    steps = F.count(col(ts)) - 1
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.when(steps > 0, span / F.lit(1e6) / steps).alias(name))
