from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import pieces
from starmart.llm.pieces import MODEL, Model
from starmart.llm.words import slices

pytestmark = pytest.mark.skipif(not os.path.isfile(MODEL), reason="no model file")


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as file:
        return Model(file.read())


def hard_texts():
    rng = random.Random(6)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\r", ";\r", "\x0c", "é", "▁", "😀", " the", "tion", "<s>", "<0x0A>", ".", "日本"]
    return ["", " ", "\n", "▁", " a ", *("".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(1500))]


@pytest.mark.parametrize("whole", [False, True])
def test_parity_with_the_library(model, whole):
    texts = hard_texts()
    got = []
    for _, _, data, offsets in slices(pa.array(texts), 2000):
        if whole:
            got += model.encode([t.decode() for t in (data[i:j].tobytes() for i, j in zip(offsets[:-1], offsets[1:], strict=True))])
        else:
            ids, at, same = model.encode_slice(data, offsets)
            assert same.all()
            assert [x.decode("utf-8", "replace") for x in model.decode_slice(ids, at)] == model.decode([x.tolist() for x in np.split(ids, at[1:-1])])
            got += [x.tolist() for x in np.split(ids, at[1:-1])]
    assert got == model.processor.encode(texts)
    assert model.decode(got) == [t.replace("▁", " ") for t in texts]


def test_table(model, edge):
    df, pairs = edge
    got = pieces.encoded(df).collect()
    want = [(i, None if t is None else model.processor.encode(t)) for i, t in pairs]
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(want, key=str)
    assert all((r.parity, r.round_trip, r.n_tokens) == ((None, None, None) if r.ids is None else (True, True, len(r.ids))) for r in got)
    back = pieces.decoded(pieces.encoded(df, verify=False))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(pairs, key=str)


def test_empty_table(frame):
    assert pieces.encoded(frame([])).collect() == []


def test_memo_forgets_and_stays_right(model):
    small = Model(model.raw)
    small.memo.limit = 50
    texts = hard_texts()[:300]
    out = [x.tolist() for _, _, data, offsets in slices(pa.array(texts), 300) for ids, at, _ in [small.encode_slice(data, offsets)] for x in np.split(ids, at[1:-1])]
    assert out == model.processor.encode(texts)


def test_unigram_model_is_rebuilt(model):
    """A small unigram model with byte fallback, written field by field."""
    def field(number, payload):
        size = len(payload)
        return bytes([number << 3 | 2]) + (bytes([size]) if size < 128 else bytes([size & 127 | 128, size >> 7])) + payload

    import struct
    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind]))

    raw = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3) + b"".join(piece(f"<0x{b:02X}>", -9, 6) for b in range(256))
    raw += b"".join(piece(t, s, 1) for t, s in [("▁", -2.0), ("a", -2.5), ("b", -2.6), ("ab", -3.0), ("▁ab", -3.2), ("ba", -4.5)])
    trainer = bytes([3 << 3, 1]) + bytes([35 << 3 & 127 | 128, 35 << 3 >> 7, 1])
    raw += field(2, trainer) + field(3, field(1, b"identity") + bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1]))
    small = Model(raw)
    texts = ["abba", "", " ab  ba", "é\nab", "bab aab"]
    assert small.type == pieces.UNIGRAM
    assert small.encode(texts) == small.processor.encode(texts)
