"""Hard negatives against all scores, computed one by one in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonde.llm import negatives
from sonde.llm.queries import table
from tests.llm.test_rows import rows


def brute(table, count=5):
    """The contract over (vec_id, label, vector) rows, equal rows once."""
    seen, points = set(), []
    for i, label, v in table:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * x) for x in v)
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        if (i, label, q) not in seen:
            seen.add((i, label, q))
            points.append((i, label, q))
    out = []
    order = lambda s: (-s[0], s[1] is not None, s[1] or 0)
    for a, label, q in points:
        if a is None or a % 100:
            continue
        scores = [(sum(x * y for x, y in zip(q, p)), i, k) for i, k, p in points if i != a]
        mine = sorted([s for s in scores if s[2] == label], key=order)[:count]
        others = sorted([s for s in scores if s[2] != label], key=order)
        for top, positive, _ in mine:
            good = [s for s in others if 80 * top <= 100 * s[0] <= 100 * top][:count]
            out += [(a, positive, r, i, top, s) for r, (s, i, _) in enumerate(good, 1)]
    return out


def result(df):
    return sorted(map(str, ((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"],
                             r["positive_score"], r["negative_score"]) for r in rows(df))))


def compare(df):
    want = sorted(map(str, brute([(r["vec_id"], r["label"], r["embedding"]) for r in rows(df)])))
    assert result(negatives.mined(df)) == want
    return want


def test_whole_table(spark, folder):
    assert compare(table(spark, folder, "embeddings"))


@pytest.mark.parametrize("block, chunk", [(4, 16), (64, 64)])
def test_blocks_and_chunks(spark, monkeypatch, block, chunk):
    """Dense clusters, ties and negative scores; small blocks, chunks and shared parts."""
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(6, 8))
    data = [(int(i), (centres[i % 6] + rng.normal(size=8) * 0.05).tolist(), int(rng.integers(0, 3)))
            for i in range(0, 4000, 10)]
    data += [(i, [0.5] * 8, i % 2) for i in range(4001, 4100)] + [(4100, [0.5] * 8, 1)]
    data += [(5000, [0.0] * 8, 0), (5001, [0.0] * 8, 0), (5002, [-0.0] * 8, 1)]
    monkeypatch.setattr(negatives, "SPREAD", 4)
    monkeypatch.setattr(negatives.hard_negatives, "__defaults__",
                        (5, 5, 80, 100, 256, block, chunk))
    assert compare(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"))


def test_odd(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [0.5, 0.25], 1, "x"), (1, [0.5, 0.25], 0, "x"), (1, [0.5, 0.25], 0, "y"),
            (2, [0.5, 0.25], 2, "x"), (3, [0.5], 0, "x"), (4, [], 0, "x"), (5, None, 0, "x"),
            (6, [0.5, None], 0, "x"), (8, [nan, 1.0], 0, "x"), (9, [inf, 1.0], 0, "x"),
            (10, [0.5, 0.25], None, "x"), (None, [0.5, 0.25], 2, "x"), (None, [0.5, 0.25], 3, "x"),
            (100, [0.25, 0.5, 1.0], 0, "x"), (100, [0.25, 0.5], 2, "x"), (200, [], 2, "x"),
            (300, [-0.5, -0.25], 2, "x"), (1, [0.5, 0.25], 0, "x"), (11, [0.51, 0.25], 1, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, id string")
    extra = df.withColumns({"block": F.lit(1), "rank": F.lit(None), "score": F.lit("s")})
    assert compare(extra)
    assert compare(df.filter("vec_id <> 0")) == compare(extra.filter("vec_id <> 0"))
    for part in (df.limit(0), df.filter("vec_id = 0"), df.filter("vec_id IN (1, 2)")):
        assert compare(part) == []


def test_parts_beyond_doubles(spark):
    data = [(0, [1e9, 3.0], 1), (1, [1.0, 1e9], 1), (2, [1.0 + 2 ** -8, 1e9], 2), (3, [0.9, 9e8], 2),
            (4, [1e300, -1e300], 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = {(r["positive_id"], r["negative_id"]): (r["positive_score"], r["negative_score"])
           for r in rows(negatives.mined(df))}
    first = 256 * 10 ** 9
    near = [first * q + 768 * math.floor(256 * y) for q, y in ((256, 1e9), (230, 9e8))]
    # Label of vec_id 0 becomes 2, so that 2 and 3 are its positives and 1 is the negative.
    assert got == {(2, 1): (first * 257 + 768 * first, near[0])}


@pytest.mark.parametrize("n", [1, 2, 50])
def test_spanning_tree(n):
    points = np.random.default_rng(n).integers(-50, 50, (n, 4))
    parent, length, depth = negatives.spanning_tree(points)
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    assert (parent == -1).sum() == 1 and depth[parent == -1] == 0
    for i, p in enumerate(parent):
        if p >= 0:
            assert depth[i] == depth[p] + 1 and length[i] == pytest.approx(far[i, p])
    inside, total = {0}, 0.0  # total length by growing from another point
    while len(inside) < n:
        edge, new = min((far[i, j], j) for i in inside for j in range(n) if j not in inside)
        inside.add(new)
        total += edge
    assert length.sum() == pytest.approx(total)


def test_bounds_spare_scores():
    """Far candidates are skipped, and every candidate that may matter is scored."""
    rng = np.random.default_rng(2)
    anchors = (np.array([100] * 8) + rng.integers(-3, 4, (30, 8))).astype(np.int16)
    points = np.concatenate([rng.integers(-40, 0, (500, 8)), rng.integers(90, 110, (5, 8))])
    truth = anchors.astype(int) @ points.T
    seen = np.zeros(truth.shape, bool)
    for i, places, scores in negatives.bounded_scores(
            anchors, negatives.spanning_tree(anchors), points, lambda some, low, high: high >= 60_000):
        assert (scores == truth[i, places]).all()
        seen[i, places] = True
    assert seen[truth >= 60_000].all() and seen.sum() < 30 * 30


def test_a_task_holds_no_copies_of_the_anchors(spark, monkeypatch):
    """Blocks are not copied to every chunk, neither in a broadcast nor in a task's rows."""
    seen, met = [], negatives._met

    def noted(*args):
        out = met(*args)
        plan = out.applyInArrow(lambda a, b: a.select(["part"]), "part int")._jdf
        seen.append(plan.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(negatives, "_met", noted)
    monkeypatch.setattr(negatives, "TEAM", 2)
    data = [(i * 10, [float(i % 7), float(i % 5) - 2.0], i % 3) for i in range(400)]
    monkeypatch.setattr(negatives.hard_negatives, "__defaults__", (5, 5, 80, 100, 256, 8, 64))
    assert compare(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"))
    assert len(seen) == 2 and all("FlatMapCoGroupsInArrow" in p for p in seen)
    assert "Broadcast" not in seen[0]
