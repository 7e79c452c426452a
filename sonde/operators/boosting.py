"""Boosted trees grown level by level from shared histograms, kept as rows of a node table.

All trees of a round grow together: one pass over the rows adds up, for every open node, feature
and bin, the gradients of the loss, whichever model and class the tree belongs to.  So a level costs
one job, not one a model.  Gradients are whole numbers (2 ** -20 of a unit), so the sums do not
depend on the order of the rows, and any engine that adds them up finds the same trees.

Three losses share this: ``binary`` (a 0/1 target, one model per key, each row in the model of its
key), ``softmax`` (one joint loss over all classes) and ``ovr`` (one 0/1 loss per class).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.cluster import spread, staged
from sonde.functions import col
from sonde.operators.series import running_total

UNIT = float(1 << 20)

# Cells of a histogram the driver takes at once; a level with more is passed in parts.
CELLS = 4_000_000

# Rows up to which a class of an ``ovr`` fit, which needs no other, is fitted by one task alone.
ALONE = 1 << 19

# Rounds after which the rows are written anew with their scores so far.
STORE = 10

NODES = ("model string, tree int, class string, node int, feature string, cut double, "
         "left int, right int, value double, gain double")


@dataclass(frozen=True)
class Settings:
    rounds: int = 20
    depth: int = 5
    step: float = 0.1
    bins: int = 32
    shrink: float = 1.0      # added to the curvature of a leaf
    least: int = 1           # rows on either side of a cut
    loss: str = "binary"


@dataclass(frozen=True)
class BoostedTrees:
    """Fitted trees as arrays [tree, node]; node i has the children 2 i + 1 and 2 i + 2.

    ``feature`` is -1 at leaves; a row goes left where its value is at most ``cut``.  Tree t belongs
    to round t // (models * classes), within it to model and class in this order.
    """

    settings: Settings
    features: tuple[str, ...]
    models: tuple[str, ...]
    classes: tuple[str, ...]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    losses: tuple[dict, ...] = field(default=())

    # --- as rows ---------------------------------------------------------------------------------

    def rows(self) -> Iterator[tuple]:
        k = len(self.classes)
        for t in range(len(self.feature)):
            at, model = divmod(t // k, len(self.models))
            stack = [0]
            while stack:
                i = stack.pop()
                f = int(self.feature[t, i])
                here = self.models[model], at, self.classes[t % k], i
                if f < 0:
                    yield (*here, None, None, None, None, float(self.value[t, i]), None)
                else:
                    yield (*here, self.features[f], float(self.cut[t, i]), 2 * i + 1, 2 * i + 2,
                           None, float(self.gain[t, i]))
                    stack += [2 * i + 2, 2 * i + 1]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The node table: one row per node; its size is set by the settings, not by the data."""
        return spark.createDataFrame(list(self.rows()), NODES)

    @staticmethod
    def from_nodes(table: DataFrame, features: Sequence[str], models: Sequence[str],
                   classes: Sequence[str], settings: Settings) -> BoostedTrees:
        """The model that a (stored) node table holds."""
        size, k, m = 2 ** (settings.depth + 1) - 1, len(classes), len(models)
        shape = (settings.rounds * m * k, size)
        feature, cut, value, gain = (np.full(shape, -1), *(np.zeros(shape) for _ in range(3)))
        place = {name: i for i, name in enumerate(features)}
        for r in table.collect():  # as many rows as the trees have nodes
            t = (r["tree"] * m + list(models).index(r["model"])) * k + list(classes).index(r["class"])
            if r["feature"] is None:
                value[t, r["node"]] = r["value"]
            else:
                feature[t, r["node"]] = place[r["feature"]]
                cut[t, r["node"]], gain[t, r["node"]] = r["cut"], r["gain"]
        return BoostedTrees(settings, tuple(features), tuple(models), tuple(classes), feature, cut,
                            value, gain)

    def importances(self) -> list[tuple[str, str, float]]:
        """(model, feature, share of the model's gain), 0 for all features of a model of leaves."""
        per = len(self.classes)
        out = []
        for i, model in enumerate(self.models):
            mine = (np.arange(len(self.feature)) // per) % len(self.models) == i
            gains = [float(self.gain[mine][self.feature[mine] == f].sum())
                     for f in range(len(self.features))]
            total = sum(gains)
            out += [(model, n, g / total if total else 0.0) for n, g in zip(self.features, gains)]
        return out

    # --- as columns ------------------------------------------------------------------------------

    def _paths(self, t: int, node: int = 0) -> str:
        f = int(self.feature[t, node])
        if f < 0:
            return f"{float(self.value[t, node])!r}D"
        name = "`" + self.features[f].replace("`", "``") + "`"
        return (f"CASE WHEN {name} <= {float(self.cut[t, node])!r}D "
                f"THEN {self._paths(t, 2 * node + 1)} ELSE {self._paths(t, 2 * node + 2)} END")

    def margin(self, model: str, klass: str | None = None) -> Column:
        """The summed leaves of one model and class as one expression over the feature columns.

        Every node is a comparison in the plan, so this suits a few hundred nodes;
        ``models.boosted_models`` scores large fits.
        """
        m, k = len(self.models), len(self.classes)
        at = self.models.index(model) * k + (self.classes.index(klass) if klass else 0)
        terms = [self._paths(r * m * k + at) for r in range(self.settings.rounds)]
        return F.expr("0.0D + " + " + ".join(terms))

    def probability(self, model: str) -> Column:
        """Probability of the target for ``binary``."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(model)))

    def probabilities(self, model: str) -> Column:
        """Array of the classes' probabilities (for ``ovr`` each one on its own)."""
        margins = F.array(*[self.margin(model, c) for c in self.classes])
        if self.settings.loss == "softmax":
            # Columns cannot be named inside an expression; one transform holds the margins.
            shared = F.transform(F.array(margins), lambda x: F.transform(
                x, lambda v: F.exp(v - F.array_max(x))))[0]
            return F.transform(F.array(shared), lambda e: F.transform(
                e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))[0]
        return F.transform(margins, lambda v: F.lit(1.0) / (F.lit(1.0) + F.exp(-v)))


# --- bins ---------------------------------------------------------------------------------------

def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Per feature the distinct values at which the share of rows passes a step of 1 / ``bins``.

    Equal values are counted first; a value is a cut if the running count passes a multiple of
    total / bins at it (the last one excepted), which whole numbers decide.
    """
    long = df.select(*[col(c).cast("double").alias(c) for c in features]).unpivot(
        [], [col(c) for c in features], "Tag", "v")
    counts = staged(long.groupBy("Tag", (F.col("v") + F.lit(0.0)).alias("v")).agg(
        F.count("*").alias("n")))
    totals = counts.groupBy("Tag").agg(F.sum("n").alias("total"))
    ranked = running_total(counts, ["n"], ["Tag"], ["v"]).join(F.broadcast(totals), "Tag")
    reached = F.least(F.expr(f"cum_n * {bins} DIV total"), F.lit(bins - 1).cast("long"))
    found = ranked.filter(reached > F.expr(f"(cum_n - n) * {bins} DIV total")).select("Tag", "v")
    out: dict[str, list[float]] = {c: [] for c in features}
    for r in found.collect():  # at most ``bins`` values a feature
        out[r["Tag"]].append(r["v"])
    return [sorted(out[c]) for c in features]


def _binned(df: DataFrame, features: Sequence[str], cuts: list[list[float]]) -> list[Column]:
    """Number of cuts below the value: a row goes left at cut b if its bin is at most b."""
    return [sum(((col(f).cast("double") > F.lit(c)).cast("int") for c in own), F.lit(0))
            .cast("tinyint").alias(f"b{i}") for i, (f, own) in enumerate(zip(features, cuts))]


# --- losses -------------------------------------------------------------------------------------

def gradients(margins: np.ndarray, y: np.ndarray, loss: str) -> tuple[np.ndarray, ...]:
    """Whole-number gradients and curvatures [row, class], and the loss of every row."""
    hit = np.arange(margins.shape[1])[None, :] == y[:, None] if loss != "binary" else y[:, None] > 0
    if loss == "softmax":
        e = np.exp(margins - margins.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        lost = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)) if len(y) else np.zeros(0)
    else:
        p = 1 / (1 + np.exp(-margins))
        lost = -np.log(np.maximum(np.where(hit, p, 1 - p), 1e-300)).sum(1)
    g = np.floor((p - hit) * UNIT + 0.5).astype(np.int64)
    return g, np.floor(p * (1 - p) * UNIT + 0.5).astype(np.int64), lost


@dataclass
class _Round:
    """The trees of one round as flat arrays; a node's children are at twice its place, left first.

    Trees follow each other by model, then by class.  ``place`` holds the bins of the cuts.  A leaf
    is its own child, so that a walk may go on.
    """

    classes: int
    size: int           # nodes of a tree
    feature: np.ndarray
    place: np.ndarray
    child: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(feature: np.ndarray, place: np.ndarray, value: np.ndarray, classes: int) -> _Round:
        trees, size = feature.shape
        own = np.arange(trees * size).reshape(trees, size)
        node = np.arange(size)
        left = np.where(feature >= 0, own - node + 2 * node + 1, own)
        child = np.stack([left, left + (feature >= 0)], -1)
        return _Round(classes, size, np.maximum(feature, 0).ravel(), place.ravel(), child.ravel(),
                      value.ravel())

    def walk(self, bins: np.ndarray, m: np.ndarray, c: int, depth: int) -> np.ndarray:
        """Place of every row's node in the tree of its model and of class ``c`` after ``depth`` steps."""
        at, n = (m * self.classes + c) * self.size, bins.shape[1]
        flat, rows = bins.ravel(), np.arange(n)
        for _ in range(depth):
            right = flat.take(self.feature.take(at) * n + rows) > self.place.take(at)
            at = self.child.take(2 * at + right)
        return at


# Rows of a block.  Sums over it of (curvature, count) fit one double: 2 ** 16 rows of 2 ** 18 each.
BLOCK = 1 << 16
COUNT = float(1 << 17)

_KEPT = {"m": np.int32, "y": np.int32, "bins": np.int8, "margins": np.float64}
_MADE = {"g": np.int32, "h": np.int32, "lost": np.float64}


def _schema(*names: str) -> str:
    return ", ".join(f"{n} binary" for n in names)


def _blocks(batches, names: Sequence[str]) -> Iterator[dict]:
    """Blocks of rows as flat arrays."""
    kinds = {**_KEPT, **_MADE}
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: np.frombuffer(batch.column(batch.schema.get_field_index(n))[i].as_buffer(),
                                    kinds[n]) for n in names}


def _batch(block: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in block.values()],
                                      list(block))


def _packed(rows: DataFrame, n_features: int, classes: int) -> DataFrame:
    """Blocks of up to ``BLOCK`` rows: models, targets, bins by feature, and margins of 0."""
    names = ["m", "y", *[f"b{i}" for i in range(n_features)]]

    def run(batches):
        def made(parts):
            m, y, *bins = (np.concatenate([p[i] for p in parts]) for i in range(len(names)))
            return _batch({"m": m.astype(np.int32), "y": y.astype(np.int32),
                           "bins": np.stack(bins).astype(np.int8) if bins else np.zeros(0, np.int8),
                           "margins": np.zeros(len(m) * classes)})
        parts, size = [], 0
        for batch in batches:
            part = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                    for n in names]
            if parts and size + batch.num_rows > BLOCK:
                yield made(parts)
                parts, size = [], 0
            for lo in range(0, batch.num_rows, BLOCK):
                parts.append([c[lo:lo + BLOCK] for c in part])
                size += len(parts[-1][0])
                if size >= BLOCK:
                    yield made(parts)
                    parts, size = [], 0
        if parts:
            yield made(parts)
    return rows.select(*names).mapInArrow(run, _schema(*_KEPT))


def _advanced(blocks: DataFrame, done: _Round | None, models: int, classes: int, n_features: int,
              settings: Settings) -> DataFrame:
    """The blocks with the leaves of the round ``done`` in their margins, gradients, and losses."""
    def run(batches):
        for b in _blocks(batches, list(_KEPT)):
            yield _batch(_moved(b, done, models, classes, n_features, settings))
    return blocks.select(*_KEPT).mapInArrow(run, _schema(*_KEPT, *_MADE))


def _moved(b: dict, done: _Round | None, models: int, classes: int, n_features: int,
           settings: Settings) -> dict:
    m, n = b["m"].astype(np.int64), len(b["m"])
    bins, margins = b["bins"].reshape(n_features, n), b["margins"].reshape(n, classes)
    if done is not None:
        margins = margins + np.stack([done.value.take(done.walk(
            bins, m, c, settings.depth)) for c in range(classes)], 1)
    g, h, loss = gradients(margins, b["y"], settings.loss)
    return {**b, "margins": margins, "g": g.T.astype(np.int32), "h": h.T.astype(np.int32),
            "lost": np.bincount(m, loss, models)}


def _histogram(blocks: DataFrame, now: _Round, models: int, n_features: int, settings: Settings,
               level: int, part: range, lossy: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums [slot, feature, bin, (g, h, n)] of the open nodes in ``part``, and (if ``lossy``) the
    loss per model.

    A slot is a tree of the round and a node of the level.  Each task adds up what it reads; the
    tasks' sums are added by Spark.
    """
    slots, bins = len(part), settings.bins
    cells = slots * n_features * bins

    def run(batches):
        total, lost = _sums(_blocks(batches, ["m", "bins", "g", "h"] + ["lost"] * lossy), now, models,
                            n_features, settings, level, part, lossy)
        by_slot = total.reshape(3, n_features, slots, bins).transpose(0, 2, 1, 3).reshape(3, cells)
        used = np.flatnonzero(by_slot[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([used, -1 - np.arange(models)]), pa.int64()),
             *[pa.array(np.concatenate([by_slot[i, used], np.zeros(models, np.int64)]), pa.int64())
               for i in range(3)],
             pa.array(np.concatenate([np.zeros(len(used)), lost]), pa.float64())],
            ["cell", "g", "h", "n", "loss"])
    summed = (blocks.mapInArrow(run, "cell long, g long, h long, n long, loss double")
              .groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n", "loss")]).toArrow())
    cell = summed["cell"].to_numpy()
    out, lost = np.zeros((cells, 3), np.int64), np.zeros(models)
    inside = cell >= 0
    out[cell[inside]] = np.stack([summed[c].to_numpy()[inside] for c in ("g", "h", "n")], 1)
    lost[-1 - cell[~inside]] = summed["loss"].to_numpy()[~inside]
    return out.reshape(slots, n_features, bins, 3), lost


def _sums(blocks, now: _Round, models: int, n_features: int, settings: Settings, level: int,
          part: range, lossy: bool) -> tuple[np.ndarray, np.ndarray]:
    """``_histogram`` of some blocks, as [(g, h, n), feature, slot and bin]."""
    width, k, bins = 2 ** level, now.classes, settings.bins
    first, slots = width - 1, len(part)
    total, lost = np.zeros((3, n_features, slots * bins), np.int64), np.zeros(models)
    for b in blocks:
        m, n = b["m"].astype(np.int64), len(b["m"])
        own, g, h = b["bins"].reshape(n_features, n), b["g"].reshape(k, n), b["h"].reshape(k, n)
        if lossy:
            lost += b["lost"]
        for c in range(k if slots else 0):
            tree, node = np.divmod(now.walk(own, m, c, level), now.size)
            slot = tree * width + node - first - part.start
            open_ = (node >= first) & (slot >= 0) & (slot < slots)
            # Doubles add whole numbers exactly up to 2 ** 53, above a block's sums.
            values = g[c].astype(float), h[c] * COUNT + 1.0
            if open_.all():
                mine = own
            else:
                slot, mine = slot[open_], own[:, open_]
                values = [v[open_] for v in values]
            base = slot * bins
            for f in range(n_features):
                cell = base + mine[f]
                total[0, f] += np.bincount(cell, values[0], slots * bins).astype(np.int64)
                both = np.bincount(cell, values[1], slots * bins).astype(np.int64)
                total[1, f] += both >> 17
                total[2, f] += both & (int(COUNT) - 1)
    return total, lost


def best_cuts(sums: np.ndarray, settings: Settings):
    """Per slot: feature (-1: none), bin, gain, and (g, h) of all rows and of the left ones.

    Of equal gains the first feature and then the first bin wins.
    """
    left = sums.cumsum(2)
    whole = left[:, :1, -1:, :]
    gl, hl, nl = (left[..., i].astype(np.float64) for i in range(3))
    g, h, n = (whole[..., i].astype(np.float64) for i in range(3))
    gr, hr, shrink = g - gl, h - hl, settings.shrink * UNIT
    gain = gl * gl / (hl + shrink) + gr * gr / (hr + shrink) - g * g / (h + shrink)
    fair = (nl >= settings.least) & (n - nl >= settings.least) & (gain > 1.0)
    flat = np.where(fair, gain, -np.inf).reshape(len(sums), -1)
    at = flat.argmax(1) if flat.size else np.zeros(len(sums), np.int64)
    slots = np.arange(len(sums))
    good = np.isfinite(flat[slots, at]) if flat.size else np.zeros(0, bool)
    f, b = np.divmod(at, sums.shape[2])
    return (np.where(good, f, -1), b, np.where(good, flat[slots, at], 0.0),
            whole[:, 0, 0, :2], left[slots, f, b, :2])


def leaf(g: np.ndarray, h: np.ndarray, settings: Settings) -> np.ndarray:
    return -settings.step * g.astype(np.float64) / (h.astype(np.float64) + settings.shrink * UNIT)


# --- the fit ------------------------------------------------------------------------------------

def fit(train: DataFrame, features: Sequence[str], target: str, settings: Settings,
        key: str | None = None, models: Sequence[str] | None = None,
        classes: Sequence[str] | None = None) -> BoostedTrees:
    """Fit on the rows without nulls in features and target.

    ``binary``: ``target`` is 0 or 1, ``key`` (if any) names the model of a row; ``models`` lists
    the keys to fit, by default all that occur.  Otherwise ``classes`` lists the target's values,
    by default all that occur, in order.  Keys and classes are few; rows may be any number.
    """
    features = list(features)
    name = F.lit("all") if key is None else col(key).cast("string")
    klass = col(target).cast("string")
    used = train.select(*[col(f).cast("double").alias(f) for f in features], name.alias("_m"),
                        klass.alias("_y")).na.drop()
    used = used.filter(~sum((F.isnan(col(f)).cast("int") for f in features), F.lit(0)).cast("boolean"))
    found = used.select("_m", "_y").distinct().collect()
    have = {r["_m"] for r in found}
    models = sorted(have, key=_natural) if models is None else [
        str(m) for m in models if str(m) in have]
    if settings.loss == "binary":
        classes = ["1"]
    elif classes is None:
        classes = sorted({r["_y"] for r in found}, key=_natural)
    classes = [str(c) for c in classes]
    if not models or not classes:
        raise ValueError("nothing to fit on")
    used = used.filter(F.col("_m").isin(models))
    cuts = quantile_cuts(used, features, settings.bins)
    y = (F.col("_y").cast("double") > 0).cast("int") if settings.loss == "binary" else _number(
        F.col("_y"), classes)
    rows = used.select(_number(F.col("_m"), models).alias("m"), y.alias("y"),
                       *_binned(used, features, cuts)).filter("y >= 0")
    rows = staged(rows, "binned")
    sizes = {r["m"]: r["n"] for r in rows.groupBy("m").agg(F.count("*").alias("n")).collect()}
    grow = _grow_alone if settings.loss == "ovr" and sum(sizes.values()) <= ALONE else _grow
    return grow(spread(rows), features, models, classes, cuts, sizes, settings)


def _natural(text: str):
    try:
        return (0, float(text), text)
    except ValueError:
        return (1, 0.0, text)


def _number(value: Column, names: Sequence[str]) -> Column:
    """Place of a value in a short list, -1 outside."""
    out = F.lit(-1)
    for i, n in enumerate(names):
        out = F.when(value == n, i).otherwise(out)
    return out


def _grow(rows: DataFrame, features: list[str], models: list[str], classes: list[str],
          cuts: list[list[float]], sizes: dict[int, int], settings: Settings) -> BoostedTrees:
    """Rounds of levels.  The gradients of a round are kept in memory until the next one's are."""
    m, k, width = len(models), len(classes), len(features)
    current, held, losses = _packed(rows, width, k), [], []

    def advance(at, done):
        nonlocal current
        if at and at % STORE == 0:
            current = staged(current.select(*_KEPT), "margins")
        current = _advanced(current, done, m, k, width, settings).persist()
        held.append(current)

    def sums_of(at, now, level, part):
        """The histogram; the first one of a round notes the loss, and the last round's rows go."""
        first = len(losses) == at
        out, lost = _histogram(current, now, m, width, settings, level, part, first)
        if first:
            losses.append({name: lost[i] / max(sizes.get(i, 0), 1) for i, name in enumerate(models)})
            while len(held) > 1:
                held.pop(0).unpersist()
        return out

    try:
        trees = _rounds(m, k, width, settings, advance, sums_of)
    finally:
        for df in held:
            df.unpersist()
    return _trees(trees, features, models, classes, cuts, losses, settings)


def _grow_alone(rows: DataFrame, features: list[str], models: list[str], classes: list[str],
                cuts: list[list[float]], sizes: dict[int, int], settings: Settings) -> BoostedTrees:
    """The trees of ``_grow`` for few rows of one model, a class a task: no job per level."""
    k, width, own = len(classes), len(features), replace(settings, loss="binary")

    def fitted(part):
        blocks, losses, c = [], [], None
        for c, block in part:
            m, y, bins = (np.frombuffer(v, _KEPT[n]) for n, v in zip(_KEPT, block))
            blocks.append({"m": m, "y": (y == c).astype(np.int32), "bins": bins,
                           "margins": np.zeros(len(m))})
        if c is None:
            return

        def advance(at, done):
            blocks[:] = [_moved(b, done, 1, 1, width, own) for b in blocks]

        def sums_of(at, now, level, part):
            if len(losses) == at:
                losses.append(sum(float(b["lost"][0]) for b in blocks))
            total, _ = _sums(blocks, now, 1, width, own, level, part, False)
            return total.reshape(3, width, len(part), own.bins).transpose(2, 1, 3, 0)
        yield c, _rounds(1, 1, width, own, advance, sums_of), losses
    names = list(_KEPT)[:3]
    found = dict((c, rest) for c, *rest in _packed(rows, width, 0).select(*names).rdd.flatMap(
        lambda r: [(c, tuple(r)) for c in range(k)]).partitionBy(k, int).mapPartitions(fitted).collect())
    trees = tuple(np.stack([found[c][0][i] for c in range(k)], 1).reshape(settings.rounds * k, -1)
                  for i in range(4))
    lost = np.sum([found[c][1] for c in range(k)], 0) / sizes[0]
    return _trees(trees, features, models, classes, cuts, [{models[0]: v} for v in lost], settings)


def _rounds(m: int, k: int, width: int, settings: Settings, advance, sums_of) -> tuple[np.ndarray, ...]:
    """Feature, bin, value and gain by (tree, node): ``advance`` adds a round's leaves to the margins,
    ``sums_of`` adds up a part of a level."""
    depth = settings.depth
    shape = (settings.rounds * m * k, 2 ** (depth + 1) - 1)
    feature, place, value = np.full(shape, -1), np.zeros(shape, np.int64), np.zeros(shape)
    gain, done = np.zeros(shape), None

    def trees(at):
        own = slice(at * m * k, (at + 1) * m * k)
        return _Round.of(feature[own], place[own], value[own], k)

    for at in range(settings.rounds + 1):
        advance(at, done)
        if at == settings.rounds:
            sums_of(at, trees(at - 1), 0, range(0))
            break
        first_tree = at * m * k
        for level in range(depth):
            wide, slots = 2 ** level, m * k * 2 ** level
            step = max(1, CELLS // (width * settings.bins))
            for lo in range(0, slots, step):
                part = range(lo, min(slots, lo + step))
                sums = sums_of(at, trees(at), level, part)
                f, b, g, whole, left = best_cuts(sums, settings)
                tree = first_tree + np.arange(part.start, part.stop) // wide
                node = wide - 1 + np.arange(part.start, part.stop) % wide
                live = sums[:, 0, :, 2].sum(1) > 0
                tree, node, f, b, g, whole, left = (
                    a[live] for a in (tree, node, f, b, g, whole, left))
                feature[tree, node], place[tree, node], gain[tree, node] = f, b, g
                value[tree, node] = leaf(whole[:, 0], whole[:, 1], settings)
                cut = f >= 0
                tree, node, whole, left = tree[cut], node[cut], whole[cut], left[cut]
                right = whole - left
                value[tree, 2 * node + 1] = leaf(left[:, 0], left[:, 1], settings)
                value[tree, 2 * node + 2] = leaf(right[:, 0], right[:, 1], settings)
            if not (feature[first_tree:first_tree + m * k, wide - 1:2 * wide - 1] >= 0).any():
                break
        done = trees(at)
    return feature, place, value, gain


def _trees(trees: tuple[np.ndarray, ...], features: list[str], models: list[str], classes: list[str],
           cuts: list[list[float]], losses: list[dict], settings: Settings) -> BoostedTrees:
    feature, place, value, gain = trees
    cut = np.zeros(feature.shape)
    for f, own in enumerate(cuts):
        here = feature == f
        cut[here] = np.array(own)[place[here]]
    return BoostedTrees(settings, tuple(features), tuple(models), tuple(classes), feature, cut,
                        value, gain, tuple(losses))


# --- the same as SQL ----------------------------------------------------------------------------

def fit_sql(rows: str, features: Sequence[str], settings: Settings, steps: bool = False) -> str:
    """CTEs that fit the same trees again, as a recursive query over lists.

    ``rows`` is a query with rid, train (boolean), m (model), c (class), hit (0/1) and the features:
    a row per class and, for rows to score, per model.  Rows of models without training rows are
    left out.  The last CTE, ``fitted``, has one row per
    row with its score s.  With ``steps`` it has one for every step of the fit: t (steps done),
    s (score so far), was (the node before the step), f, b and gain of its cut (f is -1 without),
    ended (the node after it), and the value v of that node as a leaf.
    """
    n, p = len(features), settings
    lists = ", ".join(f'CAST("{f}" AS DOUBLE)' for f in features)
    unit, shrink = f"{UNIT!r}::DOUBLE", f"{p.shrink * UNIT!r}::DOUBLE"
    grads = (
        "SELECT *, CAST(floor((p - hit) * {u} + 0.5) AS BIGINT) AS g, "
        "CAST(floor(p * (1 - p) * {u} + 0.5) AS BIGINT) AS h FROM ").format(u=unit)
    if p.loss == "softmax":
        prob = ("(SELECT *, e / sum(e) OVER (PARTITION BY rid, m) AS p FROM (SELECT *, "
                "exp(s - max(s) OVER (PARTITION BY rid, m)) AS e FROM {src}))")
    else:
        prob = "(SELECT *, 1 / (1 + exp(-s)) AS p, 0.0 AS e FROM {src})"
    start = prob.format(src="(SELECT rid, train, m, c, hit, x, 0::DOUBLE AS s FROM binned)")
    columns = "rid, train, m, c, hit, x, s, node, t, g, h, f, b, gain, v, was, ended"
    keep = "" if steps else " USING KEY (rid, m, c)"
    return f"""
base AS MATERIALIZED ({rows}),
long AS (SELECT f, v, count(*) AS n FROM (SELECT DISTINCT rid, unnest([{lists}]) AS v,
    unnest(range({n})) AS f FROM base WHERE train) u GROUP BY f, v),
ran AS (SELECT f, v, n, sum(n) OVER (PARTITION BY f ORDER BY v) AS cum,
    sum(n) OVER (PARTITION BY f) AS total FROM long),
cuts AS MATERIALIZED (SELECT f, list(v ORDER BY v) AS cuts FROM ran
    WHERE least(cum * {p.bins} // total, {p.bins - 1}) > (cum - n) * {p.bins} // total GROUP BY f),
every AS MATERIALIZED (SELECT list(coalesce(cuts, []) ORDER BY u.f) AS cuts
    FROM (SELECT unnest(range({n})) AS f) u LEFT JOIN cuts USING (f)),
binned AS MATERIALIZED (SELECT rid, train, m, c, hit, list_transform([{lists}],
    lambda v, i: CAST(len(list_filter(every.cuts[i], lambda q: q < v)) AS INT)) AS x FROM base, every),
fitted AS (
  WITH RECURSIVE fitting({columns}){keep} AS (
    SELECT rid, train, m, c, hit, x, s, 0, 0, g, h, -1, 0, 0::DOUBLE, 0::DOUBLE, 0, 0
      FROM ({grads} {start})
    UNION{" ALL" if steps else ""}
    (WITH now AS (SELECT * FROM fitting WHERE t < {p.rounds * p.depth}),
    hist AS (SELECT m, c, node, u.f, x[u.f + 1] AS bin, sum(g) AS g, sum(h) AS h, count(*) AS n
        FROM now, (SELECT unnest(range({n})) AS f) u
        WHERE train AND node >= (1 << (t % {p.depth})) - 1 GROUP BY ALL),
    cum AS (SELECT m, c, node, f, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl,
        sum(g) OVER a AS ga, sum(h) OVER a AS ha, sum(n) OVER a AS na FROM hist
        WINDOW w AS (PARTITION BY m, c, node, f ORDER BY bin), a AS (PARTITION BY m, c, node, f)),
    gains AS (SELECT m, c, node, f, bin, nl, na,
        gl::DOUBLE * gl::DOUBLE / (hl::DOUBLE + {shrink})
        + (ga::DOUBLE - gl::DOUBLE) * (ga::DOUBLE - gl::DOUBLE) / (ha::DOUBLE - hl::DOUBLE + {shrink})
        - ga::DOUBLE * ga::DOUBLE / (ha::DOUBLE + {shrink}) AS gain FROM cum),
    best AS (SELECT m, c, node, f, bin, gain FROM gains
        WHERE nl >= {p.least} AND na - nl >= {p.least} AND gain > 1
        QUALIFY row_number() OVER (PARTITION BY m, c, node ORDER BY gain DESC, f, bin) = 1),
    moved AS (SELECT now.* EXCLUDE (node, f, b, gain, was), now.node AS was, coalesce(best.f, -1) AS f,
        coalesce(best.bin, 0) AS b, coalesce(best.gain, 0) AS gain,
        CASE WHEN best.f IS NULL THEN now.node
             ELSE 2 * now.node + 1 + CAST(x[best.f + 1] > best.bin AS INT) END AS node
        FROM now LEFT JOIN best ON best.m = now.m AND best.c = now.c AND best.node = now.node),
    leaves AS (SELECT m, c, node, -{p.step}::DOUBLE * sum(g)::DOUBLE / (sum(h)::DOUBLE + {shrink})
        AS leaf FROM moved WHERE train GROUP BY m, c, node),
    scored AS (SELECT moved.* EXCLUDE (s, v), t % {p.depth} = {p.depth - 1} AS done, leaf AS v,
        CASE WHEN t % {p.depth} = {p.depth - 1} THEN s + leaf ELSE s END AS s
        FROM moved JOIN leaves USING (m, c, node))
    SELECT rid, train, m, c, hit, x, s, CASE WHEN done THEN 0 ELSE node END, t + 1,
        CASE WHEN done THEN CAST(floor((p - hit) * {unit} + 0.5) AS BIGINT) ELSE g END,
        CASE WHEN done THEN CAST(floor(p * (1 - p) * {unit} + 0.5) AS BIGINT) ELSE h END,
        f, b, gain, v, was, node FROM {prob.format(src="scored")}))
  SELECT * FROM fitting{"" if steps else " WHERE t > 0"})"""
