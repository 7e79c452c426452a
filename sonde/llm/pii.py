"""Personal data: base patterns, and a character BiLSTM-CRF that adds spans they miss."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.frames import keyed, lists, real_id, slices

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Possessive and look-behind forms match what the plain forms
# match, without their repeated scans of long runs.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")

# The tagger reads windows of WINDOW characters, one every half window, wherever a digit or an
# at sign occurs: no kind of span is without them.
WINDOW = 64
HIDDEN, STEPS, BATCH, RATE = 16, 160, 64, 0.02
CODES = 129                                   # ASCII, and one code for all other characters
TAGS = 1 + 2 * len(KINDS)                     # outside, then begin and inside of each kind

# Bounds of what is fitted: labelled windows read, and the confidence of an added span.
SAMPLE, CONFIDENCE = 4000, 0.95


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Every at sign with the run of local characters before it, and the domain behind it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
        end = match.end() if match else at + 1
        at = text.find("@", end)


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as in KINDS, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256
                       for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                    if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


def windows(text: str, width: int = WINDOW) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an at sign, on a half-width grid."""
    half, out = width // 2, set()
    for m in _TRIGGER.finditer(text):
        out.update(range(max(m.start() // half - 1, 0), (m.end() - 1) // half + 1))
    return [half * i for i in sorted(out)]


def codes(text: str, starts: list[int], width: int = WINDOW) -> np.ndarray:
    """Character codes of windows; code 0 pads behind the end of the text."""
    out = np.zeros((len(starts), width), np.int64)
    for row, at in zip(out, starts):
        part = np.frombuffer(text[at:at + width].encode("utf-32-le", "replace"), "<u4")
        row[:len(part)] = np.minimum(part, CODES - 1)
    return out


def gold_tags(spans: list[tuple[str, int, int]], starts: list[int],
              width: int = WINDOW) -> np.ndarray:
    out = np.zeros((len(starts), width), np.int64)
    for kind, a, b in spans:
        tag = 1 + 2 * KINDS.index(kind)
        for row, at in zip(out, starts):
            lo, hi = max(a - at, 0), min(b - at, width)
            if lo < hi and not row[lo:hi].any():
                row[lo:hi] = tag + 1
                if a >= at:
                    row[lo] = tag
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Weights: ``look`` (code to gate inputs), ``back`` (recurrent) per direction, and the CRF."""

    look: list[np.ndarray]     # 2 x (CODES, 4 HIDDEN)
    back: list[np.ndarray]     # 2 x (HIDDEN, 4 HIDDEN)
    out: np.ndarray            # (2 HIDDEN, TAGS)
    bias: np.ndarray           # (TAGS,)
    move: np.ndarray           # (TAGS, TAGS) transition scores

    def params(self) -> list[np.ndarray]:
        return [*self.look, *self.back, self.out, self.bias, self.move]

    @classmethod
    def fresh(cls, seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
        look = [make(CODES, 4 * HIDDEN) for _ in range(2)]
        for w in look:
            w[:, HIDDEN:2 * HIDDEN] += 1  # remember by default
        return cls(look, [make(HIDDEN, 4 * HIDDEN) for _ in range(2)], make(2 * HIDDEN, TAGS),
                   np.zeros(TAGS, np.float32), make(TAGS, TAGS))

    def _direction(self, d: int, x: np.ndarray):
        """Hidden states in reading order of direction d, and what training needs of each step."""
        n, width = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        states, tape = np.empty((width, n, HIDDEN), np.float32), []
        for t in range(width):
            gates = self.look[d][x[:, t]] + h @ self.back[d]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN:])
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            tape.append((h, before, i, f, o, g, squashed))
            h = o * squashed
            states[t] = h
        return states, tape

    def scores(self, x: np.ndarray):
        ahead, tape_a = self._direction(0, x)
        behind, tape_b = self._direction(1, x[:, ::-1])
        both = np.concatenate([ahead, behind[::-1]], axis=2)
        return both @ self.out + self.bias, both, (tape_a, tape_b)

    def _sums(self, emit: np.ndarray):
        """Log sums over all tag paths up to and from each place."""
        width = len(emit)
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[0] = emit[0]
        for t in range(1, width):
            alpha[t] = emit[t] + np.logaddexp.reduce(alpha[t - 1][:, :, None] + self.move, axis=1)
        for t in range(width - 2, -1, -1):
            beta[t] = np.logaddexp.reduce(
                self.move[None] + (emit[t + 1] + beta[t + 1])[:, None, :], axis=2)
        return alpha, beta, np.logaddexp.reduce(alpha[-1], axis=1)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of tag paths, and its gradient."""
        n, width = x.shape
        emit, both, tapes = self.scores(x)
        alpha, beta, total = self._sums(emit)
        share = np.exp(alpha + beta - total[None, :, None])
        gold = np.eye(TAGS, dtype=np.float32)[y.T]
        loss = float((total - (emit * gold).sum((0, 2))
                      - self.move[y[:, :-1], y[:, 1:]].sum(1)).mean())
        d_move = np.zeros_like(self.move)
        for t in range(width - 1):
            pair = np.exp(alpha[t][:, :, None] + self.move + (emit[t + 1] + beta[t + 1])[:, None, :]
                          - total[:, None, None])
            d_move += pair.sum(0) - gold[t].T @ gold[t + 1]
        d_emit = ((share - gold) / n).astype(np.float32)
        flat = d_emit.reshape(-1, TAGS)
        d_out = both.reshape(-1, 2 * HIDDEN).T @ flat
        d_both = d_emit @ self.out.T
        d_look, d_back = [], []
        for d, tape in enumerate(tapes):
            into = d_both[..., d * HIDDEN:(d + 1) * HIDDEN]
            order = x if d == 0 else x[:, ::-1]
            into = into if d == 0 else into[::-1]
            look, back = np.zeros_like(self.look[d]), np.zeros_like(self.back[d])
            d_h, d_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for t in range(width - 1, -1, -1):
                h, before, i, f, o, g, squashed = tape[t]
                d_h = d_h + into[t]
                d_c = d_c + d_h * o * (1 - squashed ** 2)
                gates = np.concatenate([d_c * g * i * (1 - i), d_c * before * f * (1 - f),
                                        d_h * squashed * o * (1 - o), d_c * i * (1 - g ** 2)], 1)
                np.add.at(look, order[:, t], gates)
                back += h.T @ gates
                d_h, d_c = gates @ self.back[d].T, d_c * f
            d_look.append(look)
            d_back.append(back)
        return loss, [*d_look, *d_back, d_out, flat.sum(0), d_move / n]

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag path of each window, and the posterior of each tag on it."""
        emit, _, _ = self.scores(x)
        width, n, _ = emit.shape
        best, came = emit[0], np.empty((width, n, TAGS), np.int8)
        for t in range(1, width):
            ways = best[:, :, None] + self.move
            came[t] = ways.argmax(1)
            best = ways.max(1) + emit[t]
        path = np.empty((n, width), np.int64)
        path[:, -1] = best.argmax(1)
        for t in range(width - 1, 0, -1):
            path[:, t - 1] = came[t][np.arange(n), path[:, t]]
        alpha, beta, total = self._sums(emit)
        share = np.exp(alpha + beta - total[None, :, None])
        return path, np.take_along_axis(share.transpose(1, 0, 2), path[:, :, None], 2)[..., 0]


def train(x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 7) -> Tagger:
    """Adam on windows; each batch is half windows with spans, half without, where there are."""
    model, rng = Tagger.fresh(seed), np.random.default_rng(seed)
    pools = [p for p in (np.flatnonzero(y.any(1)), np.flatnonzero(~y.any(1))) if len(p)]
    first = [np.zeros_like(p) for p in model.params()]
    second = [np.zeros_like(p) for p in model.params()]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(p, BATCH // len(pools)) for p in pools])
        _, grads = model.gradients(x[pick], y[pick])
        size = np.sqrt(sum(float((g ** 2).sum()) for g in grads))
        for p, g, m, v in zip(model.params(), grads, first, second):
            g = g * min(1, 5 / max(size, 1e-9))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Tagger | None:
    """Train on the labelled spans of about ``sample`` windows; None without any span.

    The labels are the base spans.  Half of the windows have spans, half have none; both halves
    are counted, then drawn by a hash of id and place, and never more than twice the sample.
    Every window has a fixed size, so what is collected is bounded.
    """
    def run(batches):
        for batch in slices(batches):
            out = []
            for i, text in zip(*lists(batch, "id", "text")):
                if not text or not _TRIGGER.search(text):
                    continue
                starts, spans = windows(text), base_spans(text)
                xs = codes(text, starts).astype(np.uint8)
                ys = gold_tags(spans, starts).astype(np.uint8)
                for at, x, y in zip(starts, xs, ys):
                    key = int(hashlib.md5(f"{i}:{at}".encode()).hexdigest()[:12], 16) / 2 ** 48
                    out.append((bool(y.any()), key, x.tobytes(), y.tobytes()))
            cols = list(zip(*out)) or [[]] * 4
            kinds = [pa.bool_(), pa.float64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["spans", "key", "x", "y"])
    rows = keyed(docs, "text").mapInArrow(run, "spans boolean, key double, x binary, y binary")
    counts = {r["spans"]: r["n"] for r in rows.groupBy("spans").agg(F.count("*").alias("n"))
              .collect()}
    half = sample / 2
    share = (F.when(F.col("spans"), half / max(counts.get(True, 0), 1))
             .otherwise(half / max(counts.get(False, 0), 1)))
    got = rows.filter(F.col("key") < share).limit(2 * sample).collect()
    got.sort(key=lambda r: (not r["spans"], r["key"], bytes(r["x"]), bytes(r["y"])))
    if not any(r["spans"] for r in got):
        return None
    x = np.stack([np.frombuffer(bytes(r["x"]), np.uint8) for r in got]).astype(np.int64)
    y = np.stack([np.frombuffer(bytes(r["y"]), np.uint8) for r in got]).astype(np.int64)
    return train(x, y, steps)


def tagged_spans(text: str, starts: list[int], path: np.ndarray, sure: np.ndarray,
                 confidence: float = CONFIDENCE) -> list[tuple[str, int, int]]:
    """Spans of one text from its decoded windows.

    Of overlapping windows, each character takes the tag of the window whose edge is farthest
    (the earlier one in a tie).  Spans are then read over the whole text, so one that crosses
    windows comes out once.  Kept are spans with that mean posterior, which hold an at sign
    between other characters (email) or at least seven digits (other kinds).
    """
    width = path.shape[1]
    tags: dict[int, tuple[int, int, float]] = {}
    edge = np.minimum(np.arange(width) + 1, width - np.arange(width))
    for at, row, share in zip(starts, path, sure):
        for k in np.flatnonzero(row):
            far = int(edge[k])
            if at + k < len(text) and far > tags.get(at + k, (0,))[0]:
                tags[at + k] = (far, int(row[k]), float(share[k]))
        for k in np.flatnonzero(row == 0):
            if int(edge[k]) > tags.get(at + k, (width,))[0]:
                tags[at + k] = (int(edge[k]), 0, 1.0)
    out, run = [], []

    def close():
        if run:
            kind, a, b = KINDS[(run[0][1] - 1) // 2], run[0][0], run[-1][0] + 1
            part = text[a:b]
            enough = (0 < part.find("@") < len(part) - 1 if kind == "email"
                      else sum(c.isdigit() for c in part) >= 7)
            if enough and sum(s for _, _, s in run) / len(run) >= confidence:
                out.append((kind, a, b))
            run.clear()

    for place in sorted(tags):
        _, tag, share = tags[place]
        kind = (tag - 1) // 2 if tag else -1
        joined = run and place == run[-1][0] + 1 and kind == (run[0][1] - 1) // 2 and tag % 2 == 0
        if not joined:
            close()
        if tag and (joined or tag % 2):
            run.append((place, tag, share))
    close()
    return out


def find(model: Tagger | None, texts: list[str | None]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; all spans are the base ones and, where these leave
    room, those of the tagger."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    starts = [windows(t) if t else [] for t in texts]
    out = []
    for first in range(0, len(texts), 64):
        group = range(first, min(first + 64, len(texts)))
        rows = [codes(texts[i], starts[i]) for i in group if starts[i]]
        if rows:
            x = np.concatenate(rows)
            got = [model.decode(x[a:a + 4096]) for a in range(0, len(x), 4096)]
            path = np.concatenate([p for p, _ in got])
            sure = np.concatenate([s for _, s in got])
        at = 0
        for i in group:
            n, added = len(starts[i]), []
            if n:
                added = tagged_spans(texts[i], starts[i], path[at:at + n], sure[at:at + n])
                at += n
            taken = [(a, b) for _, a, b in base[i]]
            extra = [s for s in added if all(s[2] <= a or b <= s[1] for a, b in taken)]
            both = base[i] + extra
            out.append((base[i], sorted(both, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return out


def _listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and base_sha256 are those of the base spans; ``spans`` lists base and added spans
    as kind:start:end, by kind and start.  A null text is empty; repeated rows stay rows.
    """
    def run(batches):
        for batch in slices(batches):
            ids, texts = lists(batch, "id", "text")
            out = []
            for i, (base, spans) in zip(ids, find(model, texts)):
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                out.append((i, *counts, hashlib.sha256(_listed(base).encode()).hexdigest(),
                            _listed(spans)))
            names = ["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 7, kinds)], names)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return (keyed(docs, "text")
            .mapInArrow(run, f"id long, {counts}, base_sha256 string, spans string")
            .select(real_id().alias("doc_id"), *[f"n_{k}" for k in KINDS], "base_sha256", "spans"))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans as one."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` (if present) recounted."""
    names = docs.columns

    def run(batches):
        for batch in slices(batches):
            texts = batch.column(names.index("text")).to_pylist()
            texts = [mask(t, spans) if t and spans else t
                     for t, (_, spans) in zip(texts, find(model, texts))]
            at = names.index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, c.type) if k == at else c for k, c in enumerate(batch.columns)],
                names)
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out
