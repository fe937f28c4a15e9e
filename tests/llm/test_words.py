"""Words that a worker's encoder keeps from one task to the next."""

import numpy as np
import public_tokenizers
import pytest

from lossloom.llm import packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def fresh():
    packing.word_encoder.cache_clear()
    yield
    packing.word_encoder.cache_clear()


def test_words_of_one_task_are_known_to_the_next(monkeypatch):
    first = packing.word_encoder(VOCABULARY).encode([b"Zyxwvq unthinkable, of."])
    monkeypatch.setattr(packing.WordIds, "merged", lambda self, piece: pytest.fail(f"{piece} is merged again"))
    assert packing.word_encoder(VOCABULARY).encode([b"zyxwvq Unthinkable, OF."]) == first


def test_marks_at_the_end_of_a_word_are_one_piece(monkeypatch):
    encoder = packing.word_encoder(VOCABULARY)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "|"]
    texts = ["word" + a + b + c for a in marks for b in marks for c in ("", "'", "s", "'s", "é")] + ["it's.", "...", "a1.", "é,"]
    want = [np.array(e.ids, "<u2").tobytes() for e in encoder.model.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode([t.encode() for t in texts]) == want
    # The usual word with marks behind it needs no search for pieces.
    encoder.encode([b";"])
    monkeypatch.setattr(packing, "PIECES", None)
    assert encoder.encode([b"unseen;"]) == [encoder.words[b"unseen"] + encoder.words[b";"]]
