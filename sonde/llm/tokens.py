"""Token ids of whole texts with a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

# Encoded pieces that a worker remembers before it forgets the later half.
REMEMBERED = 800_000


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write each character below 0x180: a letter for every UTF-8 byte.

    Printable bytes stand for themselves, the others for the characters from 0x100 on.  The mark
    between joined pieces stays.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    letter = {b: chr(b if b in shown else next(spare)) for b in range(0x100)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x180) if c != 1}


_BYTE_LETTERS = _byte_letters()


class _Known(dict):
    """Ids of pieces.  What is missing is made by the library's model alone, for pieces that the
    tokenizer would neither change nor cut; at ``most`` pieces the later half is forgotten.
    """

    def __init__(self, model, most: int):
        super().__init__()
        self.tokenize, self.most = model.tokenize, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.make_room(1)
        return self.learn(piece)

    def learn(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isalnum()  # written as it is
        tokens = self.tokenize(piece if plain else piece.translate(_BYTE_LETTERS))
        ids = self[piece] = b"".join([t.id.to_bytes(4, "little") for t in tokens])
        return ids

    def make_room(self, more: int) -> None:
        if len(self) + more > self.most:
            # What came first is what comes often: the later half goes.
            for _ in range(len(self) // 2):
                self.popitem()


class Encoder:
    """Encodes whole texts; texts are cut where the tokenizer cuts anyway, and pieces are kept.

    ``cut`` is "space" for byte-level vocabularies, whose pieces start with their one space, or
    "drop" for vocabularies that discard white space and case.  Texts in Latin letters are cut by
    the vocabulary's own rule, so that words with other marks or case around them are one piece;
    other texts are cut at spaces.  A text that has white space in other arrangements than that
    is proven for is encoded in one call.  Strings of special tokens in a text are ordinary text.
    """

    # White space beyond space, tab and line ends, and the mark between joined pieces.
    _ODD = re.compile("[\x01\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029"
                      "\u202f\u205f\u3000]")
    # Letters whose case and composition are one to one; a text with more is cut at spaces only.
    _LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f"
    _RARE = re.compile(f"[^\\x00-\\x7f{_LATIN}]")
    # The rules by which the two kinds of vocabulary cut a text.
    _ENDINGS = "'(?:[stmd]|re|ve|ll)"
    _RULES = {
        "space": re.compile(f" ?[{_LATIN}]+| ?[0-9]+|{_ENDINGS}| ?[^\\s{_LATIN}0-9]+"
                            r"|\s+(?!\S)|\s+"),
        "drop": re.compile(f"[{_LATIN}]+|[0-9]|{_ENDINGS}|[^\\s{_LATIN}0-9]+")}
    # Spaces that touch other white space.
    _TOUCHING = ("  ", " \n", " \t", " \r", "\n ", "\t ", "\r ")

    def __init__(self, path: str, cut: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cut, self.known = cut, _Known(self.tokenizer.model, remembered)
        if cut == "space":  # a byte-level token has one character for each of its bytes
            self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.width[i] = len(token)
        else:
            self.mark = self._ids("\x01")
            if len(self.mark) != 1:
                raise ValueError("the vocabulary lacks a token for the mark between pieces")

    def _by_rule(self, text: str) -> list[str] | None:
        """Pieces that the tokenizer would neither change nor cut, where they are known."""
        if self._ODD.search(text) or not (text.isascii() or not self._RARE.search(text)):
            return None
        return self._RULES[self.cut].findall(text.lower() if self.cut == "drop" else text)

    def _at_spaces(self, text: str) -> list[str] | None:
        if self._ODD.search(text):
            return None
        if self.cut == "drop":
            return text.split()
        if text[0] == " " or text[-1] == " " or any(t in text for t in self._TOUCHING):
            return None
        first, *rest = text.split(" ")
        return [first, *[" " + p for p in rest]]

    def _ids(self, text: str) -> np.ndarray:
        got = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(got.ids, dtype="<u4")

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, from one call for all: cut by byte widths, or at the mark."""
        if self.cut == "space":
            ids = self._ids("".join(pieces))
            ends = np.cumsum([len(p.encode()) for p in pieces])
            cuts = np.searchsorted(np.cumsum(self.width[ids]), ends, "left") + 1
            starts = np.concatenate([[0], cuts[:-1]])
        else:
            ids = self._ids(" \x01 ".join(pieces))
            cuts = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
            starts = np.concatenate([[0], cuts[:-1] + 1])
        data = ids.tobytes()
        return [data[4 * lo:4 * hi] for lo, hi in zip(starts.tolist(), cuts.tolist())]

    def _learn(self, new: set[str]) -> None:
        whole = self._RULES[self.cut].fullmatch
        for p in new:
            if whole(p) and not self._RARE.search(p) and (self.cut == "space" or p == p.lower()):
                self.known.learn(p)
        new = list(new.difference(self.known))
        if self.cut == "space":  # pieces without a space before them would grow together
            alone = [p for p in new if p[0] != " " or p[-1].isspace()]
            for at in range(0, len(alone), 8192):
                part = alone[at:at + 8192]
                got = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                self.known.update((p, np.array(g.ids, "<u4").tobytes())
                                  for p, g in zip(part, got))
            new = [p for p in new if p[0] == " " and not p[-1].isspace()]
        for at in range(0, len(new), 8192):
            part = new[at:at + 8192]
            self.known.update(zip(part, self._joined(part)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; null is empty."""
        look, out, others = self.known.__getitem__, [b""] * len(texts), {}
        for i, text in enumerate(texts):
            own = self._by_rule(text or "")
            if own is None:
                others[i] = self._at_spaces(text)
            else:
                out[i] = b"".join(map(look, own))
        wanted = set().union(*filter(None, others.values()))
        # These may have no ids by the model alone, so all are known before they are looked up.
        self.known.make_room(len(wanted.difference(self.known)))
        self._learn(wanted.difference(self.known))
        for i, own in others.items():
            out[i] = self._ids(texts[i]).tobytes() if own is None else b"".join(map(look, own))
        return out


@lru_cache(maxsize=2)
def shared_encoder(path: str, cut: str, remembered: int = REMEMBERED) -> Encoder:
    """The encoder of a Python worker, which later tasks of that worker find warm."""
    return Encoder(path, cut, remembered)
