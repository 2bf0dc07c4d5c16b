"""What an encoder keeps of the pieces it has met."""

import tracemalloc

import pyarrow as pa
import pytest

from ledgerloom.llm import tokens


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.default_tokenizer())


def test_ids_are_those_of_whole_texts(encoder):
    texts = ["", None, "one two  three", "é　ж 雪 one two", "two one\n x y", " two one three "] * 3
    want = [encoder._tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [ids.tolist() for ids in encoder.encode(pa.array(texts))] == want


def test_known_pieces_take_few_bytes(encoder):
    encoder._clear()
    list(encoder.encode(pa.array(["warm up"])))
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        pieces = 1 << 18
        for a in range(0, pieces, 1 << 14):
            list(encoder.encode(pa.array([" ".join(f"k{k}" for k in range(a, a + (1 << 14)))])))
        held = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert held < 64 * pieces


def test_ids_are_made_a_slice_at_a_time(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "slices", lambda offsets: ((k, k + 1) for k in range(len(offsets) - 1)))
    done = []
    made = encoder._slice
    monkeypatch.setattr(encoder, "_slice", lambda *a: done.append(1) or made(*a))
    found = encoder.encode(pa.array(["a b", "c d", "e f"]))
    next(iter(found))
    assert len(done) == 1
