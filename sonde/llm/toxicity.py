"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters are word lists and patterns; each votes toxic, not toxic, or abstains.  A few of them are
lists, of words and of stems, learned from labelled rows.  The label model explains the votes of all documents by a hidden
class: per voter a table of votes given the class (its accuracy), and for pairs that agree beyond
that, a table given the class and the other voter (their correlation).  The labels of the learning
rows are one more voter with an accuracy of its own, so wrong marks are outvoted.  A logistic
classifier on words and votes is then fitted to the model's posteriors.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.frames import NULL_ID, keyed, lists, real_id, sampled, slices, staged

FOLDS = 5

# Bounds of what is fitted: labelled rows read for word lists, rows the classifier is fitted on,
# words (or stems) in learned lists, lists they are dealt into, words and stems the classifier
# looks at.
LABELLED, SAMPLE, LEARNED, LISTS, WORDS = 20_000, 8_000, 64, 8, 256

# A text has a stem if this many different longer words begin with it; stems have these lengths.
FORMS, STEMS = 2, (4, 5, 6)

# Ranges words are hashed into before the classifier chooses some.
BUCKETS = 1 << 20

# Tokens whose words a worker remembers.
REMEMBERED = 200_000

# Rounds of expectation and maximisation, the one after which correlated pairs are chosen if there
# are too few marks to choose them by, and the marks of each class that are enough.
ROUNDS, PAIRS_AFTER, ENOUGH = 10, 4, 20

ABSTAIN, CLEAN, TOXIC = 0, 1, 2

# Words of the lists, by what they say.
LEXICON = {
    "stupidity": "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass imbecile "
                 "imbeciles fool fools foolish dimwit halfwit brainless dunce cretin cretins dense",
    "worthlessness": "worthless useless loser losers pathetic trash garbage scum filth rubbish "
                     "vermin parasite pest failure nobody pitiful",
    "ridicule": "clown clowns joke laughable ridiculous buffoon freak weirdo jerk creep coward "
                "hypocrite liar liars",
    "disgust": "disgusting disgusted disgrace gross vile repulsive revolting nasty sickening ugly "
               "stinking rotten",
    "profanity": "damn damned crap bastard bastards bitch ass asshole shit shitty bullshit fuck "
                 "fucking fucked fucker piss pissed dick prick",
    "threat": "kill killed killing die dies hurt destroy murder hang burn beat shoot stab choke",
    "hate": "hate hates hated hatred despise loathe detest",
    "german": "dumm dummkopf trottel vollidiot schwachkopf blödmann arschloch abschaum dreck "
              "widerlich ekelhaft erbärmlich wertlos versager scheiße mistkerl müll",
    "french": "idiote idiots imbécile crétin stupide débile minable nul nulle ordure dégoûtant "
              "pathétique connard connasse salaud merde clown inutile",
    "spanish": "idiota idiotas estúpido estúpida imbécil basura patético asqueroso asquerosa inútil "
               "escoria perdedor payaso mierda cabrón tonto",
}
YOU = "you your you're youre u ya du dich dir ihr euch tu toi vous eres usted"
# Voters that only ever vote for clean.  None of them is the absence of other votes: abstaining has
# a probability given the class as well, and a voter that follows from others would count twice.
CLEAN_VOTERS = ("polite", "license", "table", "contact")
POLITE = "please thanks thank sorry welcome bitte danke merci pardon gracias perdón"

LICENSE = ("licensed under", "licenced under", "copyright", "all rights reserved")

# Marks that surround ordinary words, and signs used in place of letters.
MARKS_AROUND = ".,;:!?()\"'»«"
SIGNS = str.maketrans("0134578@$!|", "oieastbasil")

_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[\W\d_]+")
_AGAIN = re.compile(r"(.)\1+")
_CENSORED = re.compile(r"(?<!\S)[^\W\d_][*#@$%]{2,}[^\W\d_]")
_TABLE = re.compile(r"(?: \| \S+){4}")
_CONTACT = re.compile(r"\w@\w+\.\w|https?://")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_CAPITALS = re.compile(r"[A-ZÀ-Þ]{3}")
_SHOUT = re.compile(r"(?:\b[^\W\d_a-zß-öø-ÿ]{3,}\b\W+){3}")
_CALLS = re.compile(r"[!?]{3}")


class Read(NamedTuple):
    """A text, lower-cased, its words, marks of disguised words, learned stems, and insults."""

    text: str
    lower: str
    words: set[str]
    signs: int
    stems: list[str]
    hits: int


class Voters:
    """All voters over fixed and learned word lists; ``names`` are in the order of the votes."""

    def __init__(self, learned: list[list[str]]):
        self.lists = {n: frozenset(w.split()) for n, w in LEXICON.items()}
        self.lists |= {f"learned_{i}": frozenset(w) for i, w in enumerate(learned)}
        self.stems = frozenset(w[:-1] for words in learned for w in words if w.endswith("*"))
        self.heads = frozenset(stem[:STEMS[0]] for stem in self.stems)
        self.insults = frozenset().union(*(self.lists[n] for n in self.lists
                                           if n not in ("threat", "hate")))
        self.owners: dict[str, list[int]] = {}
        for i, words in enumerate(self.lists.values()):
            for w in words:
                self.owners.setdefault(w, []).append(i)
        self.folded = {_AGAIN.sub(r"\1", w): w for w in self.insults if len(w) > 3}
        self.memory: dict[str, tuple] = {}
        self.you, self.polite = frozenset(YOU.split()), frozenset(POLITE.split())
        self.names = [*self.lists, "address", "disguised", "stretched", "two_insults", "censored",
                      "shouting", "calls", *CLEAN_VOTERS]

    def votes(self, read: Read) -> list[int]:
        """One vote per voter."""
        text, lower, words, signs = read.text, read.lower, read.words, read.signs
        n = len(self.lists)
        out = [ABSTAIN] * len(self.names)
        said = words & self.owners.keys() if len(words) < len(self.owners) else {
            w for w in self.owners if w in words}
        for w in said.union(read.stems):
            for i in self.owners[w]:
                out[i] = TOXIC
        if read.hits and not self.you.isdisjoint(words):
            out[n] = TOXIC if self._addressed(lower) else ABSTAIN
        out[n + 1] = TOXIC if signs & 1 else ABSTAIN
        out[n + 2] = TOXIC if signs & 2 else ABSTAIN
        out[n + 3] = TOXIC if read.hits > 1 else ABSTAIN
        # Plain searches spare most texts the patterns.
        censored = any(c in text for c in "*#@$%")
        out[n + 4] = TOXIC if censored and _CENSORED.search(text) else ABSTAIN
        out[n + 5] = TOXIC if _CAPITALS.search(text) and _SHOUT.search(text) else ABSTAIN
        calls = "!!" in text or "??" in text or "!?" in text or "?!" in text
        out[n + 6] = TOXIC if calls and _CALLS.search(text) else ABSTAIN
        out[n + 7] = ABSTAIN if self.polite.isdisjoint(words) else CLEAN
        out[n + 8] = CLEAN if any(p in lower for p in LICENSE) else ABSTAIN
        out[n + 9] = CLEAN if lower.count(" | ") > 3 and _TABLE.search(text) else ABSTAIN
        contact = ("@" in text or "://" in text) and _CONTACT.search(text)
        out[n + 10] = CLEAN if contact else ABSTAIN
        return out

    def _addressed(self, lower: str) -> bool:
        """Whether an insult stands within six words of a word for "you"."""
        last_you = last_insult = -7
        for i, m in enumerate(_WORD.finditer(lower)):
            w = m.group()
            if w in self.you:
                last_you = i
            elif w in self.insults:
                last_insult = i
            else:
                continue
            if abs(last_you - last_insult) <= 6:
                return True
        return False

    def read(self, text: str | None) -> Read:
        """Look at a whole text once.  What a token holds is remembered, as most come again."""
        text = text or ""
        lower = text.lower()
        words, signs, some, hits, memory = set(), 0, set(), 0, self.memory
        for token, n in Counter(lower.split()).items():
            held = memory.get(token)
            if held is None:
                if len(memory) >= REMEMBERED:
                    memory.clear()
                held = memory[token] = self._token(token)
            if held.__class__ is str:
                words.add(held)
            else:
                found, sign, heads, insults = held
                words.update(found)
                signs |= sign
                some.update(heads)
                hits += n * insults
        stems = [f"{stem}*" for stem in stems_of(some) if stem in self.stems] if some else []
        return Read(text, lower, words, signs, stems, hits)

    def _token(self, token: str):
        """The only word of an ordinary token; else its words, disguises, words that begin like
        learned stems, and the number of insults."""
        found, sign = _WORD.findall(token), self._disguise(token)
        heads = [w for w in found if w[:STEMS[0]] in self.heads]
        insults = sum(w in self.insults for w in found)
        if len(found) == 1 and not (sign or heads or insults):
            return found[0]
        return found, sign, heads, insults

    def _disguise(self, token: str) -> int:
        """Whether a word of the lists is written with signs or digits (1) or drawn-out letters (2)."""
        if len(token) > 40:
            return 0
        bare = token.strip(MARKS_AROUND)
        if not bare.isalpha():
            bare = _ODD.sub("", token.strip(".,;:!?()\"").translate(SIGNS))
            return int(bare in self.insults and bare not in _ODD.split(token))
        if not _STRETCHED.search(bare):
            return 0
        known = self.folded.get(_AGAIN.sub(r"\1", bare))
        return 2 if known is not None and known != bare else 0


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS


def stems_of(words: Iterable[str]) -> list[str]:
    """Stems that several of the (different) words of a text begin with."""
    forms = Counter(w[:k] for w in words for k in STEMS if len(w) > k)
    return [stem for stem, n in forms.items() if n >= FORMS]


# --- label model --------------------------------------------------------------------------------

@dataclass
class LabelModel:
    """Votes given the class: ``prior`` of toxic, ``single[i, vote, class]``, and for voters with a
    partner (``parent[i]`` >= 0) ``joint[i, vote of the parent, vote, class]``.

    The last voter is the mark of a labelled row; a row without a mark says nothing by that.
    """

    prior: float
    single: np.ndarray
    parent: np.ndarray
    joint: np.ndarray

    @staticmethod
    def start(kinds: list[int]) -> LabelModel:
        """Before any data: toxic votes come ten times as often from toxic texts, and so on."""
        single = np.empty((len(kinds) + 1, 3, 2))
        single[:-1] = [(0.98, 0.7), (0.0, 0.0), (0.02, 0.3)]
        for i, kind in enumerate(kinds):
            if kind == CLEAN:
                single[i] = [(0.6, 0.8), (0.4, 0.2), (0.0, 0.0)]
        single += 1e-3
        single[-1] = MARKS
        m = len(single)
        return LabelModel(0.1, single, np.full(m, -1), np.full((m, 3, 3, 2), 1 / 3))

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        """Log-likelihood of the votes (rows) under both classes, without the prior."""
        out = np.zeros((len(votes), 2))
        for i in range(votes.shape[1]):
            p = self.parent[i]
            out += np.log(self.single[i, votes[:, i]] if p < 0
                          else self.joint[i, votes[:, p], votes[:, i]])
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of toxic; without a column for the mark, there is none."""
        if votes.shape[1] == len(self.single) - 1:
            votes = np.concatenate([votes, np.zeros((len(votes), 1), votes.dtype)], 1)
        logs = self.evidence(votes) + np.log([1 - self.prior, self.prior])
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))

    def accuracies(self) -> np.ndarray:
        """Per voter the probability that a vote given (not an abstention) is right."""
        right = self.single[:, CLEAN, 0] * (1 - self.prior) + self.single[:, TOXIC, 1] * self.prior
        given = (self.single[:, 1:, 0].sum(1) * (1 - self.prior)
                 + self.single[:, 1:, 1].sum(1) * self.prior)
        return right / given


# What a mark is worth before any data: right in 19 of 20 rows (the first line stands for no mark).
MARKS = np.array([[1.0, 1.0], [0.95, 0.05], [0.05, 0.95]])


def _digits(texts: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(texts).encode(), np.uint8).reshape(-1, width).astype(np.int64) - 48


def maximise(pairs: np.ndarray, parent: np.ndarray) -> LabelModel:
    """The model that explains expected counts ``pairs[i, j, vote i, vote j, class]``."""
    m = len(pairs)
    alone = np.stack([pairs[i, i].sum(1) for i in range(m)])    # [i, vote, class]
    prior = float((alone[0].sum(0)[1] + 1) / (alone[0].sum() + 10))
    smooth = alone + 0.5
    single = smooth / smooth.sum(1, keepdims=True)
    # The marks' right to speak: as if 200 rows of each class had been seen.
    given = smooth[-1, 1:] + 200 * MARKS[1:]
    single[-1] = [(1, 1), *(given / given.sum(0))]
    joint = np.full((m, 3, 3, 2), 1 / 3)
    for i in np.flatnonzero(parent >= 0):
        table = pairs[parent[i], i] + 2 * single[i][None]       # [parent's vote, vote, class]
        joint[i] = table / table.sum(1, keepdims=True)
    return LabelModel(min(max(prior, 1e-4), 0.9), single, parent, joint)


def correlated(pairs: np.ndarray, least: float = 30.0) -> np.ndarray:
    """A forest of voters that agree beyond what the class explains: each one's partner, or -1.

    Edges are taken by falling likelihood gain (conditional mutual information) while they join
    different trees; the mark stays alone.
    """
    m = len(pairs)
    gains = []
    for i in range(m - 1):
        for j in range(i + 1, m - 1):
            t = pairs[i, j] + 1e-9
            own = t.sum(1, keepdims=True) * t.sum(0, keepdims=True) / t.sum((0, 1), keepdims=True)
            gains.append((2 * float((t * np.log(t / own)).sum()), i, j))
    tree, links = list(range(m)), [[] for _ in range(m)]
    for gain, i, j in sorted(gains, reverse=True):
        if gain < least:
            break
        if tree[i] != tree[j]:
            old, new = tree[j], tree[i]
            tree = [new if t == old else t for t in tree]
            links[i].append(j)
            links[j].append(i)
    parent, seen = np.full(m, -1), set()
    for root in range(m):
        stack = [] if root in seen else [root]
        seen.add(root)
        while stack:
            node = stack.pop()
            for other in links[node]:
                if other not in seen:
                    seen.add(other)
                    parent[other] = node
                    stack.append(other)
    return parent


def expected(model: LabelModel, votes: np.ndarray, counts: np.ndarray, marked: bool = False
             ) -> np.ndarray:
    """``pairs`` of the rows: how often two voters gave two votes, split by the posterior (or by
    what a mark alone is worth)."""
    toxic = MARKS[votes[:, -1], 1] if marked else model.posterior(votes)
    m = votes.shape[1]
    marks = np.zeros((len(votes), m * 3))
    marks[np.arange(len(votes))[:, None], np.arange(m) * 3 + votes] = 1
    both = [marks.T @ (marks * (counts * share)[:, None]) for share in (1 - toxic, toxic)]
    return np.stack(both, -1).reshape(m, 3, m, 3, 2).transpose(0, 2, 1, 3, 4)


def fit_labels(patterns: DataFrame, kinds: list[int], rounds: int = ROUNDS) -> LabelModel:
    """Expectation and maximisation over all vote patterns (votes: a digit a voter, n: rows).

    The rows with a mark come first, taken at their word: they give the first model and show which
    voters agree beyond the class.  Without such rows the pairs are chosen after some rounds.  A
    round is one pass; what leaves a task has the size of the pairs' table, whatever it read, and
    is added up by Spark before the driver sees it.
    """
    model, m = LabelModel.start(kinds), len(kinds) + 1
    for at in range(-1, rounds):
        def run(batches, model=model, marked=at < 0):
            total = np.zeros((m, m, 3, 3, 2))
            for batch in slices(batches, 4096):
                texts, counts = lists(batch, "votes", "n")
                votes, counts = _digits(texts, m), np.array(counts, float)
                if marked:
                    votes, counts = votes[votes[:, -1] > 0], counts[votes[:, -1] > 0]
                total += expected(model, votes, counts, marked)
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int64()), pa.array(total.ravel()[cells], pa.float64())],
                ["cell", "value"])
        sums = (patterns.select("votes", "n").mapInArrow(run, "cell long, value double")
                .groupBy("cell").agg(F.sum("value").alias("value")).collect())
        pairs = np.zeros(m * m * 18)
        for r in sums:
            pairs[r["cell"]] = r["value"]
        pairs = pairs.reshape(m, m, 3, 3, 2)
        if at < 0:
            marked = pairs[0, 0].sum((0, 1)).min() >= ENOUGH
            model = maximise(pairs, correlated(pairs)) if marked else model
        else:
            choose = at == PAIRS_AFTER and not marked
            model = maximise(pairs, correlated(pairs) if choose else model.parent)
    return model


# --- classifier ---------------------------------------------------------------------------------

@dataclass
class Model:
    """Everything a score needs; ``labels`` tells the voters' accuracies and correlations."""

    learned: list[list[str]]
    labels: LabelModel
    buckets: list[int]
    weights: np.ndarray                 # intercept, toxic votes, clean votes, buckets
    names: list[str] = field(default_factory=list)

    def report(self) -> list[tuple[str, float, str | None]]:
        """(voter, accuracy, voter it is correlated with) of all voters and the mark."""
        names = [*self.names, "mark"]
        return [(n, float(a), names[p] if p >= 0 else None)
                for n, a, p in zip(names, self.labels.accuracies(), self.labels.parent)]


def logistic(rows: np.ndarray, target: np.ndarray, ridge: float = 0.5, steps: int = 25) -> np.ndarray:
    """Weights (the first is the intercept, which is not shrunk) for soft targets, by Newton."""
    x = np.concatenate([np.ones((len(rows), 1)), rows], 1)
    weights, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    share = np.clip(target.mean(), 1e-6, 1 - 1e-6)
    weights[0] = math.log(share / (1 - share))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - target) + shrink * weights
        curve = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(shrink)
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def features(votes: np.ndarray, present: np.ndarray) -> np.ndarray:
    return np.concatenate([votes == TOXIC, votes == CLEAN, present], 1).astype(np.float64)


def _marks(labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(id, mark) of the rows to learn from; marks that contradict each other are none."""
    held = F.crc32(F.col("id").cast("string")) % folds
    rows = keyed(labels, "toxic").withColumn("toxic", F.col("toxic").cast("double")).filter(
        (F.col("id") != F.lit(NULL_ID)) & (held != 0) & F.col("toxic").isin(0.0, 1.0))
    return rows.groupBy("id").agg(F.avg("toxic").alias("mark")).filter("mark <> 0.5").select(
        "id", (F.col("mark") > 0.5).cast("int").alias("mark"))


def learn_lists(docs: DataFrame, marks: DataFrame, labelled: int = LABELLED, most: int = LEARNED,
                lists_: int = LISTS) -> list[list[str]]:
    """Lists of the words, and of the stems, that labelled toxic texts hold far more often than
    other labelled ones; stems end with ``*``.

    About ``labelled`` marks, by a hash, and the texts they belong to are read.  Words and stems
    are counted once a text; the strongest of each, by their z-scores, are dealt into lists by
    strength.
    """
    few = sampled(marks, labelled, "id")
    n = {r["mark"]: r["n"] for r in few.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return []
    texts = keyed(docs, "text").join(F.broadcast(few), "id")   # at most 2 * labelled rows

    def run(batches):
        voters = Voters([])
        for batch in slices(batches):
            every, toxic = Counter(), Counter()
            for text, mark in zip(*lists(batch, "text", "mark")):
                words = voters.read(text).words
                found = [w for w in words if len(w) > 2] + [f"{s}*" for s in stems_of(words)]
                every.update(found)
                if mark:
                    toxic.update(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(every.keys(), pa.string()),
                 pa.array([toxic[w] for w in every], pa.int64()),
                 pa.array(every.values(), pa.int64())], ["word", "a", "n"])
    counts = (texts.select("text", F.col("mark").cast("long").alias("mark"))
              .mapInArrow(run, "word string, a long, n long").groupBy("word")
              .agg(F.sum("a").alias("a"), F.sum("n").alias("n")))
    share = n[1] / (n[0] + n[1])
    z = (F.col("a") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    good = staged(counts.filter("a >= 5").withColumn("z", z).filter("z >= 5").filter(
        F.col("a") >= 0.7 * F.col("n")), "words")
    out = []
    for kind in (~F.col("word").endswith("*"), F.col("word").endswith("*")):
        words = [r["word"] for r in good.filter(kind).orderBy(F.desc("z"), "word")
                 .limit(most).collect()]
        size = -(-len(words) // lists_) or 1
        out += [words[i:i + size] for i in range(0, len(words), size)]
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, labelled: int = LABELLED) -> Model:
    """Fit voters, label model and classifier.

    The label model covers the votes of all documents; word lists and classifier come from bounded
    samples (``labelled`` marks, about ``sample`` documents, never more than twice as many).
    ``labels`` has doc_id and toxic; only marks outside fold 0 are looked at.  Without marks the
    voters decide among themselves.
    """
    marks = staged(_marks(labels), "marks")
    learned = learn_lists(docs, marks, labelled)
    names = Voters(learned).names
    kinds = [CLEAN if n in CLEAN_VOTERS else TOXIC for n in names]
    share = sample / max(docs.count(), 1)

    def run(batches):
        voters = Voters(learned)
        for batch in slices(batches):
            ids, texts, drawn = lists(batch, "id", "text", "drawn")
            read = [voters.read(t) for t in texts]
            votes = ["".join(map(str, voters.votes(r))) for r in read]
            words = [sorted({bucket(w) for w in [*r.words, *r.stems]}) if d else None
                     for r, d in zip(read, drawn)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(votes, pa.string()),
                 pa.array(words, pa.list_(pa.int64()))], ["id", "votes", "words"])
    place = F.xxhash64("id", "text", F.lit("classifier")) / F.lit(2.0 ** 64) + F.lit(0.5)
    given = staged(keyed(docs, "text").select("id", "text", (place < share).alias("drawn"))
                   .mapInArrow(run, "id long, votes string, words array<long>"), "votes")
    # A mark is a vote like the others; ids without one join with nothing.
    alone = given.select("id", "votes").groupBy("id", "votes").agg(F.count("*").alias("n"))
    mark = F.when(F.col("mark").isNull(), "0").otherwise((F.col("mark") + 1).cast("string"))
    patterns = alone.join(marks, "id", "left").groupBy(
        F.concat("votes", mark).alias("votes")).agg(F.sum("n").alias("n"))
    model = fit_labels(staged(patterns, "patterns"), kinds)

    drawn = staged(given.filter("words IS NOT NULL").select("votes", "words").limit(2 * sample),
                   "drawn")
    buckets = _chosen(drawn, model)
    votes, present = _rows(drawn, buckets, len(names))
    weights = np.zeros(1 + 2 * len(names) + len(buckets))
    if len(votes):
        weights = logistic(features(votes, present), model.posterior(votes))
    return Model(learned, model, buckets, weights, names)


def _chosen(drawn: DataFrame, model: LabelModel, words: int = WORDS) -> list[int]:
    """Buckets whose words go with the posterior most clearly, at most ``words`` of them."""
    width = len(model.single) - 1

    def run(batches):
        for batch in slices(batches):
            votes, words = lists(batch, "votes", "words")
            toxic = model.posterior(_digits(votes, width)) if votes else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.int64())), pa.array(toxic, pa.float64())],
                ["words", "toxic"])
    rated = staged(drawn.mapInArrow(run, "words array<long>, toxic double"), "rated")
    base = rated.agg(F.avg("toxic")).first()[0]
    if base is None or not 0 < base < 1:
        return []
    z = (F.sum("toxic") - F.count("*") * base) / F.sqrt(F.count("*") * base * (1 - base))
    top = (rated.select(F.explode("words").alias("bucket"), "toxic").groupBy("bucket")
           .agg(z.alias("z"), F.count("*").alias("n")).filter("n >= 5 AND abs(z) >= 4")
           .orderBy(F.desc(F.abs("z")), "bucket").limit(words).collect())
    return sorted(r["bucket"] for r in top)


def _rows(drawn: DataFrame, buckets: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Votes and chosen words of the sample: a bounded number of rows of a bounded size."""
    at = {b: i for i, b in enumerate(buckets)}

    def run(batches):
        for batch in slices(batches):
            votes, words = lists(batch, "votes", "words")
            bits = [np.packbits(_present(w, at)).tobytes() for w in words]
            yield pa.RecordBatch.from_arrays(
                [pa.array(votes, pa.string()), pa.array(bits, pa.binary())], ["votes", "bits"])
    got = drawn.mapInArrow(run, "votes string, bits binary").collect()
    got.sort(key=lambda r: (r["votes"], bytes(r["bits"])))
    if not got:
        return np.zeros((0, width), np.int64), np.zeros((0, len(buckets)))
    packed = np.frombuffer(b"".join(bytes(r["bits"]) for r in got), np.uint8).reshape(len(got), -1)
    return (_digits([r["votes"] for r in got], width),
            np.unpackbits(packed, axis=1, count=len(buckets)).astype(float))


def _present(words, at: dict[int, int]) -> np.ndarray:
    out = np.zeros(len(at), np.uint8)
    out[[at[w] for w in words if w in at]] = 1
    return out


def score(docs: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """One row per document: doc_id, held_out, score in 0..1, predicted (1 from 0.5 on).

    The whole text counts, and nothing else; a null text is scored like an empty one.  Repeated
    rows are scored each; a null doc_id is never held out.
    """
    at = {b: i for i, b in enumerate(model.buckets)}

    def run(batches):
        voters, places = Voters(model.learned), {}
        for batch in slices(batches):
            ids, texts, held = lists(batch, "id", "text", "held_out")
            read = [voters.read(t) for t in texts]
            votes = np.array([voters.votes(r) for r in read]).reshape(len(read), -1)
            present = np.zeros((len(read), len(at)))
            for row, r in zip(present, read):
                for w in (*r.words, *r.stems):
                    place = places.get(w)
                    if place is None:
                        if len(places) >= REMEMBERED:
                            places.clear()
                        place = places[w] = at.get(bucket(w), -1)
                    if place >= 0:
                        row[place] = 1
            x = features(votes, present)
            line = model.weights[0] + x @ model.weights[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()),
                 pa.array(1 / (1 + np.exp(-np.clip(line, -30, 30))), pa.float64())],
                ["id", "held_out", "score"])
    rest = F.crc32(F.when(F.col("id") != F.lit(NULL_ID), F.col("id")).cast("string")) % folds
    held = F.coalesce(rest == 0, F.lit(False)).alias("held_out")
    out = (keyed(docs, "text").select("id", "text", held)
           .mapInArrow(run, "id long, held_out boolean, score double"))
    return out.select(real_id().alias("doc_id"), "held_out", "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
