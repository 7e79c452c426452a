"""Toxicity: voters on small texts, the label model against a known one, held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonde.llm import toxicity as tox
from sonde.llm.queries import QUERIES, table
from tests.llm.test_rows import rows


def votes(text, learned=()):
    voters = tox.Voters([list(w) for w in learned])
    return {n: v for n, v in zip(voters.names, voters.votes(voters.read(text))) if v}


@pytest.mark.parametrize("text, toxic", [
    ("What an Idiot.", {"stupidity"}), ("You are such a loser!", {"worthlessness", "address"}),
    ("a1diot i.d.i.o.t", {"disguised"}), ("st0pid and m0ron", {"disguised"}),
    ("stuuuupid thing", {"stretched"}), ("tr*sh f**k", {"censored"}),
    ("SHOUTING ALL DAY long", {"shouting"}), ("why???", {"calls"}),
    ("zork here", {"learned_0"}), ("trash, trash$$$ here", {"worthlessness", "two_insults"}),
    ("Du bist ein Trottel", {"german", "address"}), ("a classic trashcan", set()),
    ("", set()), (None, set()), (" \n", set())])
def test_voters(text, toxic):
    got = votes(text, [("zork",)])
    assert {n for n, v in got.items() if v == tox.TOXIC} == toxic
    assert {n for n, v in got.items() if v == tox.CLEAN} <= set(tox.CLEAN_VOTERS)


def test_stems_need_several_forms():
    assert votes("blargo and blarga", [("blarg*",)])["learned_0"] == tox.TOXIC
    for text in ("blargo blargo", "blarg blargo", "ablargo ablarga"):
        assert "learned_0" not in votes(text, [("blarg*",)])


def test_voters_look_at_whole_texts():
    long = "and so on " * 20_000
    assert votes(long + "moron")["stupidity"] == tox.TOXIC
    assert votes(long) == {} and votes(long + "please write to a@b.cd") == dict.fromkeys(
        ("polite", "contact"), tox.CLEAN)
    assert "address" not in votes("you " + long + "moron")


def planted(n=4000, seed=1):
    """Votes of voters with known accuracies; voter 1 mostly repeats voter 0; the last is the mark."""
    rng = np.random.default_rng(seed)
    truth = (rng.random(n) < 0.2).astype(int)
    given, right = [0.6, 0.6, 0.5, 0.4, 0.3], [0.9, 0.9, 0.8, 0.7, 0.95]
    out = np.zeros((n, 5), np.int64)
    for i in range(5):
        says = np.where(rng.random(n) < right[i], truth, 1 - truth) + 1
        out[:, i] = np.where(rng.random(n) < given[i], says, 0)
    again = rng.random(n) < 0.85
    out[again, 1] = out[again, 0]
    return truth, out


def test_label_model_finds_accuracies_and_correlations(spark):
    truth, out = planted()
    texts = ["".join(map(str, row)) for row in out]
    patterns = spark.createDataFrame([(t, 1) for t in texts], "votes string, n long")
    model = tox.fit_labels(patterns, [tox.TOXIC] * 4, rounds=12)
    assert model.prior == pytest.approx(truth.mean(), abs=0.05)
    real = [(out[:, i][out[:, i] > 0] - 1 == truth[out[:, i] > 0]).mean() for i in range(5)]
    assert model.accuracies() == pytest.approx(real, abs=0.05)
    assert (model.parent[1] == 0) != (model.parent[0] == 1) and model.parent[4] == -1
    guess = model.posterior(out)
    seen = Counter(zip(texts, truth))  # nothing tells more than the class most frequent in a pattern
    best = sum(max(seen[t, 0], seen[t, 1]) for t in set(texts)) / len(texts)
    assert ((guess > 0.5) == truth).mean() > best - 0.02
    # Grouped patterns are the same evidence as single rows.
    grouped = patterns.groupBy("votes").agg(F.sum("n").alias("n")).repartition(3)
    again = tox.fit_labels(grouped, [tox.TOXIC] * 4, rounds=12)
    assert again.posterior(out) == pytest.approx(guess, abs=1e-6)


def test_expected_counts_add_up():
    _, out = planted(500)
    model = tox.LabelModel.start([tox.TOXIC] * 4)
    pairs = tox.expected(model, out, np.full(500, 2.0))
    toxic = model.posterior(out)
    for i, j, a, b in [(0, 1, 2, 2), (2, 4, 0, 1), (3, 3, 1, 1), (3, 3, 1, 2)]:
        mine = (out[:, i] == a) & (out[:, j] == b)
        assert pairs[i, j, a, b] == pytest.approx(
            [2 * (1 - toxic)[mine].sum(), 2 * toxic[mine].sum()])


def test_logistic_reaches_the_minimum():
    rng = np.random.default_rng(4)
    x = (rng.random((300, 6)) < 0.3).astype(float)
    target = 1 / (1 + np.exp(2 - 3 * x[:, 0] - x[:, 1]))
    w = tox.logistic(x, target)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert np.abs(x.T @ (p - target) + 0.5 * w[1:]).max() < 1e-4 and abs((p - target).sum()) < 1e-4


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, larger):
    got = {r["doc_id"]: r for r in rows(QUERIES["op11_toxicity"](spark, larger))}
    texts = {r["doc_id"]: r["text"] for r in rows(table(spark, larger, "documents"))}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    marks = {r["doc_id"]: r["toxic"] for r in rows(table(spark, larger, "labels"))}
    held = [(m, got[i]["predicted"]) for i, m in marks.items() if i in got and got[i]["held_out"]]
    right = np.mean([m == p for m, p in held])
    caught = np.mean([p for m, p in held if m])
    alarms = np.mean([p for m, p in held if not m])
    assert right > 0.95 and caught > 0.6 and alarms < 0.02


def test_marks_of_the_held_out_fold_do_not_matter(spark, folder, docs):
    labels = table(spark, folder, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (tox.fit(docs, x) for x in (labels, other))
    assert a.learned == b.learned and a.buckets == b.buckets
    assert a.weights == pytest.approx(b.weights, abs=1e-6)
    hidden = docs.select("doc_id", "text", F.lit("xx").alias("lang"), F.lit("s").alias("source"))
    assert rows(tox.score(docs, a).orderBy("doc_id")) == rows(tox.score(hidden, a).orderBy("doc_id"))


def test_wrong_marks_are_outvoted(spark):
    """New insults are learned from marks, a tenth of which are wrong."""
    rng = np.random.default_rng(6)
    plain, data, marks, truth = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)], [], [], {}
    for i in range(1500):
        words = list(rng.choice(plain, 30))
        truth[i] = int(rng.random() < 0.2)
        if truth[i]:
            words[int(rng.integers(0, 30))] = str(rng.choice(["zork", "blarg", "idiot"]))
        data.append((i, " ".join(words)))
        if rng.random() < 0.6:
            marks.append((i, truth[i] if rng.random() < 0.9 else 1 - truth[i]))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    model = tox.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert {"zork", "blarg"} <= {w for words in model.learned for w in words}
    got = {r["doc_id"]: r["predicted"] for r in rows(tox.score(docs, model))}
    assert np.mean([got[i] == t for i, t in truth.items()]) > 0.98
    report = {n: (a, p) for n, a, p in model.report()}
    assert 0.8 < report["mark"][0] < 0.98 and report["learned_0"][0] > 0.75


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 0, "x"), (2, None, "x"), (None, 1, "x"), (4, 1, "y"), (4, 1, "y"), (6, 0, "z"),
         (77, 5, "z")], "doc_id long, toxic int, text string")
    none = labels.limit(0)
    for docs, marks in ((odd, labels), (odd, none), (odd.limit(1), labels), (empty, labels), (empty, none)):
        model = tox.fit(docs, marks)
        for target in (odd, empty):
            got = rows(tox.score(target, model))
            assert len(got) == target.count()
            assert all(0 <= r["score"] <= 1 for r in got)
            same = {r["score"] for r in got if r["doc_id"] in (0, 1)}
            assert len(same) <= 1  # a null text is an empty one
    learned = {i: m for i, m in ((4, 1), (6, 0)) if zlib.crc32(str(i).encode()) % 5}
    assert {r["id"]: r["mark"] for r in tox._marks(labels).collect()} == learned
