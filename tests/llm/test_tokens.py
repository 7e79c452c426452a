"""Pieces that are remembered give the ids of one call for the whole text."""

import numpy as np
import pyarrow as pa
import pytest

from sonde.llm import frames, packing
from sonde.llm.queries import BYTE_BPE, WORD_BPE
from sonde.llm.tokens import Encoder

ODD = ["", " ", "a", " a", "a ", "a  b", "a \n b", "it's he'll\tx y", "\n\nab  \n", "x　y z",
       "<|endoftext|> a", "a\x1cb c", "é́ É", "́a ́", "İstanbul ΣΑΣ x", "123 45a, !!",
       "a\r\nb", "ab cd ef", "a\n b", "x\x01y \x01 z", "we're 'tis ' s", "\t", "a  b", None]


@pytest.mark.parametrize("path, cut", [(BYTE_BPE, "space"), (WORD_BPE, "drop")])
@pytest.mark.parametrize("remembered", [3, 1000])
def test_pieces_give_the_ids_of_whole_texts(path, cut, remembered, corpus):
    encoder = Encoder(path, cut, remembered)
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list("aBt. ,'s\n\t9éÉİ²"[:int(rng.integers(8, 16))]), 40)) for _ in range(300)]
    for texts in (ODD, made, list(corpus.values())[:80], ODD):
        got = encoder.encode(texts)
        for text, ids in zip(texts, got):
            want = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text


@pytest.mark.parametrize("path, cut", [(BYTE_BPE, "space"), (WORD_BPE, "drop")])
def test_every_character_of_latin_texts(path, cut):
    encoder = Encoder(path, cut)
    texts = [form.replace("?", chr(c)) for c in range(0x181)
             for form in ("a?b ?", "??", " ? 's?", "?1 A?\n ?.")]
    for text, ids in zip(texts, encoder.encode(texts)):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)


def test_remembered_words_change_no_piece(docs):
    as_rows = lambda df: sorted(map(tuple, df.collect()))
    want = as_rows(packing.pieces(docs, BYTE_BPE))
    assert as_rows(packing.pieces(docs, BYTE_BPE, remembered=500)) == want


def test_arrow_gives_back_memory_between_batches(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            self.released += 1

    pool = Pool()
    monkeypatch.setattr(frames.pa, "default_memory_pool", lambda: pool)
    batch = pa.RecordBatch.from_arrays([pa.array(range(10))], ["n"])
    assert [s.num_rows for s in frames.slices(iter([batch, batch]), 4)] == [4, 4, 2] * 2
    assert pool.released == 2


@pytest.mark.parametrize("path, cut", [(BYTE_BPE, "space"), (WORD_BPE, "drop")])
def test_texts_in_latin_letters_are_looked_up_once(path, cut, monkeypatch):
    """New pieces are learned where they are met, not in a second walk over all pieces of a batch."""
    encoder = Encoder(path, cut, 50)
    monkeypatch.setattr(encoder, "_learn", lambda new: pytest.fail(str(new)) if new else None)
    texts = [f"New word{i % 70}, x{i}é {i}." for i in range(200)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(
            text, add_special_tokens=False).ids
        assert len(encoder.known) <= 50


def test_other_texts_keep_their_pieces_until_they_are_joined():
    """Pieces that the model alone would write otherwise are not forgotten within a batch."""
    encoder, texts = Encoder(WORD_BPE, "drop", 4), ["É́a ΣΑΣ b", "ΣΑΣ c d e f g h", "É́a ΣΑΣ i j k l m n o"]
    for _ in range(3):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(
                text, add_special_tokens=False).ids
