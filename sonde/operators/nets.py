"""The fit of ``pyspark.ml``'s layered net, with blocks of rows as arrays in Python workers.

Start, number of rounds and tolerance are those of the given estimator; the objective is the mean log
loss over rows (the library's: over blocks of rows).  Every evaluation reads all rows, and Spark adds
up the tasks' sums.  The weights become a model of the library, which scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.functions import col

# Rows of one pass through the layers: their values stay in a core's cache.
BLOCK = 1024

# Inputs up to this size are kept in single precision.
SINGLE = 1e30

# Steps whose change of the gradient is kept, values of the objective that are looked back at, and
# trials of one step length.
MEMORY, LOOK_BACK, TRIALS = 10, 20, 30


def layers(sizes: Sequence[int], flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights (from, to) and constants of every layer, in the library's order."""
    out, at = [], 0
    for wide, to in zip(sizes, sizes[1:]):
        out.append((flat[at:at + wide * to].reshape(wide, to),
                    flat[at + wide * to:at + (wide + 1) * to]))
        at += (wide + 1) * to
    return out


def forward(parts: Sequence[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """Inputs and values of every layer: sigmoids, and at last the softmax."""
    values = [x]
    with np.errstate(over="ignore"):
        for i, (weights, constants) in enumerate(parts):
            z = values[-1] @ weights
            z += constants
            if i < len(parts) - 1:
                np.exp(np.negative(z, out=z), out=z)
                z += 1.0
                np.reciprocal(z, out=z)
            else:
                z -= z.max(1, keepdims=True)
                np.exp(z, out=z)
                z /= z.sum(1, keepdims=True)
            values.append(z)
    return values


def sums(sizes: Sequence[int], flat: np.ndarray, blocks: Iterable[np.ndarray]) -> np.ndarray:
    """Log loss, number of rows, and the gradient by every weight, summed over rows of (inputs, class).

    Layers of a block are taken in the blocks' own precision, the sums over blocks in doubles.
    """
    out, parts = np.zeros(2 + len(flat)), None
    slopes = layers(sizes, out[2:])
    for block in blocks:
        if parts is None or parts[0][0].dtype != block.dtype:
            parts = layers(sizes, flat.astype(block.dtype))
        for lo in range(0, len(block), BLOCK):
            rows = block[lo:lo + BLOCK]
            values = forward(parts, np.ascontiguousarray(rows[:, :-1]))
            delta, own = values[-1], (np.arange(len(rows)), rows[:, -1].astype(np.int64))
            out[0] -= np.log(np.maximum(delta[own], np.finfo(delta.dtype).tiny)).sum(dtype=float)
            out[1] += len(rows)
            delta[own] -= 1.0
            for i in range(len(parts) - 1, -1, -1):
                weights, constants = slopes[i]
                weights += values[i].T @ delta
                constants += delta.sum(0)
                if i:
                    delta = delta @ parts[i][0].T
                    delta *= values[i]
                    delta *= 1.0 - values[i]
    return out


def minimized(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int,
              tol: float) -> tuple[np.ndarray, list[float]]:
    """L-BFGS: the last point and the objective at the start and after every round.

    It ends after ``max_iter`` rounds, or when the objective or its gradient hardly change any more.
    """
    x = start
    f, g = value(x)
    history, kept = [f], []
    while len(history) <= max_iter:
        if np.linalg.norm(g) <= max(tol * abs(f), 1e-8):
            break
        if len(history) > 1 and abs(f - max(history[-LOOK_BACK:])) <= tol * abs(history[0]):
            break
        found = _step(value, x, f, g, _direction(g, kept),
                      1.0 if kept else 1.0 / np.linalg.norm(g))
        if found is None and kept:  # once more, straight down
            kept = []
            found = _step(value, x, f, g, -g, 1.0 / np.linalg.norm(g))
        if found is None:
            break
        moved, f, slope = found
        kept = [*kept, (moved - x, slope - g)][-MEMORY:]
        x, g = moved, slope
        history.append(f)
    return x, history


def _direction(g: np.ndarray, kept: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    d, shares = -g, []
    for s, y in reversed(kept):
        shares.append((s @ d) / (s @ y))
        d = d - shares[-1] * y
    if kept:
        s, y = kept[-1]
        d = d * ((s @ y) / (y @ y))
    for (s, y), share in zip(kept, reversed(shares)):
        d = d + (share - (y @ d) / (s @ y)) * s
    return d


def _step(value, x, f, g, d, t):
    """A point along ``d`` that is low enough and past the steepest fall, its objective and gradient."""
    slope, low, high = g @ d, 0.0, np.inf
    if not slope < 0:
        return None
    for _ in range(TRIALS):
        moved = x + t * d
        now, g_now = value(moved)
        if not now <= f + 1e-4 * t * slope:
            high = t
        elif g_now @ d < 0.9 * slope:
            low = t
        else:
            return moved, now, g_now
        t = (low + high) / 2 if np.isfinite(high) else 2 * t
    return None


def _packed(rows: DataFrame) -> RDD:
    """The rows as arrays, kept in memory (or on the executors' disks) as they are dealt.

    Single precision halves their room and the time of the layers.
    """
    width = len(rows.columns)

    def run(batches):
        for batch in batches:
            values = np.stack([c.to_numpy(zero_copy_only=False).astype(float)
                               for c in batch.columns], 1)
            if np.abs(values).max(initial=0) <= SINGLE:
                values = values.astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary()),
                                              pa.array([values.dtype.str])], ["rows", "kind"])

    packed = rows.mapInArrow(run, "rows binary, kind string").rdd
    return packed.map(lambda r: np.frombuffer(r["rows"], r["kind"]).reshape(-1, width)).persist(
        StorageLevel.MEMORY_AND_DISK)


def fit(train: DataFrame, features: Sequence[str], net: MultilayerPerceptronClassifier,
        target: str = "target") -> tuple[PipelineModel, list[float]]:
    """The fitted pipeline and the mean log loss at the start and after every round.

    Training skips rows with a null input; the fitted model refuses them.  Classes are whole
    numbers below the width of the last layer.
    """
    sizes = [int(n) for n in net.getLayers()]
    used = train.select(*[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                        col(target).cast("double").alias("y"))
    inputs = used.columns[:-1]
    used = used.na.drop(subset=inputs).withColumn("y", F.when(
        F.col("y").isin(list(range(sizes[-1]))), F.col("y")).otherwise(
        F.raise_error(F.lit(f"classes must be whole numbers from 0 to {sizes[-1] - 1}"))))
    blocks = _packed(used)

    def value(flat: np.ndarray) -> tuple[float, np.ndarray]:
        total = blocks.mapPartitions(lambda part: [sums(sizes, flat, part)]).treeAggregate(
            np.zeros(2 + len(flat)), np.add, np.add)
        if not total[1]:
            raise ValueError("nothing to fit on")
        return float(total[0] / total[1]), total[2:] / total[1]

    try:
        weights, losses = minimized(value, _model(net, None).weights.toArray(), net.getMaxIter(),
                                    net.getTol())
    finally:
        blocks.unpersist()
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return PipelineModel([assembler, _model(net, weights)]), losses


def _model(net: MultilayerPerceptronClassifier, weights: np.ndarray | None):
    """The library's model with these weights, or with the estimator's own start: a fit of no rounds."""
    own = net.copy().setMaxIter(0)
    if weights is not None:
        own = own.setInitialWeights(Vectors.dense(weights))
    n = net.getLayers()[0]
    two = SparkSession.active().range(2, numPartitions=1).select(
        array_to_vector(F.array(*[F.col("id").cast("double")] * n)).alias(net.getFeaturesCol()),
        F.col("id").cast("double").alias(net.getLabelCol()))
    return own.fit(two)
