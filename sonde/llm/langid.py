"""Language identification with blended n-gram presence kernels.

A text is the set of its byte n-grams (n = 1, 2, 3), hashed into fixed ranges.  The kernel of two
texts is the mean over n of |A and B| / sqrt(|A| |B|).  Nystroem landmarks turn it into features,
one-versus-rest ridge regression on them gives one score per language, and scoring a batch is two
matrix products.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.frames import NULL_ID, keyed, lists, real_id, slices

# Hash ranges of 1-, 2- and 3-grams.
RANGES = (256, 4096, 8192)
WIDTH = sum(RANGES)

# Bounds of what is fitted: labelled documents read, and landmarks among them.
SAMPLE, LANDMARKS, RIDGE = 2400, 160, 1e-3
UNKNOWN, FOLDS = "und", 5

# Below this score the pipeline rejects a document.
MIN_SCORE = 0.2

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m.group().isalpha() for m in _LETTER.finditer(text))


def presence(text: str) -> np.ndarray:
    """0/1 vector of the n-grams of a whole text, A-Z and other capitals lower-cased."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    out = np.zeros(WIDTH, np.uint8)
    for at in range(0, len(data), 1 << 20):
        part = data[at:at + (1 << 20) + 2].astype(np.uint32)
        out[part] = 1
        two = part[:-1] << 8 | part[1:]
        out[RANGES[0] + ((two * np.uint32(2654435761)) >> 20)] = 1
        three = two[:-1] << 8 | part[2:]
        out[RANGES[0] + RANGES[1] + ((three * np.uint32(2246822519)) >> 19)] = 1
    return out


def normed(rows: np.ndarray) -> np.ndarray:
    """Presence rows scaled so that a plain dot product is the kernel."""
    out, at = rows.astype(np.float32), 0
    for width in RANGES:
        block = out[:, at:at + width]
        count = block.sum(1, keepdims=True)
        block /= np.sqrt(np.maximum(count, 1) * len(RANGES))
        at += width
    return out


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray      # packed presence bits, one row per landmark
    weights: np.ndarray        # landmarks x languages

    def kernel_rows(self) -> np.ndarray:
        return normed(np.unpackbits(self.landmarks, axis=1, count=WIDTH))


def fit_kernel(langs: list[str], packed: np.ndarray, landmarks: int = LANDMARKS,
               ridge: float = RIDGE) -> Model:
    """Ridge regression on Nystroem features; the first rows serve as landmarks."""
    names = sorted(set(langs))
    rows = normed(np.unpackbits(packed, axis=1, count=WIDTH))
    marks = rows[:landmarks]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, good] / np.sqrt(values[good])
    features = (rows @ marks.T).astype(np.float64) @ root
    target = np.array([[float(x == n) for n in names] for x in langs])
    gram = features.T @ features + ridge * len(langs) * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(gram, features.T @ target)
    return Model(names, packed[:landmarks], weights.astype(np.float32))


def score(model: Model, marks: np.ndarray, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of texts that have a letter."""
    rows = normed(np.stack([presence(t) for t in texts]))
    values = np.maximum((rows @ marks.T) @ model.weights, 0)
    total = values.sum(1)
    best = values.argmax(1)
    share = np.where(total > 0, values.max(1) / np.where(total > 0, total, 1), 0)
    return [model.languages[i] for i in best], [float(s) for s in share]


def _remainder(folds: int):
    """crc32 of the id's text modulo folds; null for a null id, which belongs to no fold."""
    return F.crc32(F.when(F.col("id") != F.lit(NULL_ID), F.col("id")).cast("string")) % folds


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS,
        folds: int = FOLDS) -> Model | None:
    """Fit on about ``sample`` labelled documents outside fold 0; None if there are none.

    The sample takes as many of each language, by a hash of the id; never more than twice
    ``sample`` are read.  The texts of the chosen ids are turned into n-gram bits on the
    executors, and those bits (a fixed size each) are collected.
    """
    rows = keyed(docs, "lang").withColumn("fold", _remainder(folds)).filter(
        "lang IS NOT NULL AND fold <> 0")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    uniform = (F.xxhash64("id", F.lit("landmark")) / F.lit(2.0 ** 64)) + F.lit(0.5)
    share = F.lit(sample) / F.lit(max(counts.count(), 1)).cast("double")
    chosen = (rows.join(counts, "lang").select("id", (uniform * F.col("n")).alias("place"))
              .filter(F.col("place") <= share).limit(2 * sample).collect())
    if not chosen:
        return None
    place = {r["id"]: r["place"] for r in chosen}

    def run(batches):
        for batch in slices(batches):
            ids, langs, texts = lists(batch, "id", "lang", "text")
            take = [i for i, t in enumerate(texts) if has_letter(t)]
            bits = [np.packbits(presence(texts[i])).tobytes() for i in take]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in take], pa.int64()),
                 pa.array([langs[i] for i in take], pa.string()), pa.array(bits, pa.binary())],
                ["id", "lang", "bits"])
    wanted = (keyed(docs, "lang", "text").filter(F.col("id").isin(list(place)))
              .filter("lang IS NOT NULL"))
    got = wanted.mapInArrow(run, "id long, lang string, bits binary").limit(2 * sample).collect()
    if not got:
        return None
    got.sort(key=lambda r: (place[r["id"]], r["id"], r["lang"], bytes(r["bits"])))
    packed = np.stack([np.frombuffer(bytes(r["bits"]), np.uint8) for r in got])
    return fit_kernel([r["lang"] for r in got], packed, landmarks)


def predict(docs: DataFrame, model: Model | None, folds: int = FOLDS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score in [0, 1].

    The whole text counts.  A null text, one without a letter, or any text when nothing could be
    learned is ``und`` with score 0.  Ties go to the first language by name.  A null doc_id is
    never held out.
    """
    def run(batches):
        marks = model.kernel_rows() if model else None
        for batch in slices(batches, 128):
            ids, texts, held = lists(batch, "id", "text", "held_out")
            langs, scores = [UNKNOWN] * len(ids), [0.0] * len(ids)
            take = [i for i, t in enumerate(texts) if model and has_letter(t)]
            if take:
                for i, lang, value in zip(take, *score(model, marks, [texts[i] for i in take])):
                    langs[i], scores[i] = lang, value
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()),
                 pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["id", "held_out", "lang_pred", "score"])
    held = F.coalesce(_remainder(folds) == 0, F.lit(False)).alias("held_out")
    return (keyed(docs, "text").select("id", "text", held)
            .mapInArrow(run, "id long, held_out boolean, lang_pred string, score double")
            .select(real_id().alias("doc_id"), "held_out", "lang_pred", "score"))


def accepted(docs: DataFrame, model: Model | None, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, all columns as they are.

    Rejected are ``und`` documents and those that score below ``min_score``.  Without anything to
    learn from, nothing is rejected.
    """
    if model is None:
        return docs
    columns = docs.columns

    def run(batches):
        marks = model.kernel_rows()
        for batch in slices(batches, 128):
            texts = batch.column(columns.index("text")).to_pylist()
            good = np.zeros(len(texts), bool)
            take = [i for i, t in enumerate(texts) if has_letter(t)]
            if take:
                good[take] = np.array(score(model, marks, [texts[i] for i in take])[1]) >= min_score
            yield batch.filter(pa.array(good))
    return docs.mapInArrow(run, docs.schema)
