from __future__ import annotations

import os
import zlib

import numpy as np
import pytest

from starmart.llm import language
from starmart.llm.language import grams, learned, predicted
from starmart.llm.storage import importable

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, held_out boolean, score string"


def docs(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, t, x, None, "own") for i, t, x in rows], SCHEMA).repartition(2)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")
def test_held_out_accuracy(spark):
    importable(spark)
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = predicted(table, learned(table)).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.lang_pred == r.lang for r in held]) >= 0.98


EN, FR = "the quick brown fox jumps over the lazy dog and then ", "le renard brun saute par dessus le chien paresseux et puis "


def test_mixtures_and_edges(spark):
    train = [(i, (EN if i % 2 else FR) * 3, "en" if i % 2 else "fr") for i in range(60)]
    mixed = [(100, EN * 20 + FR * 10, None), (101, None, "en"), (102, "", None), (103, "123 !?", None), (104, "a", None), (105, "é", None), (106, EN * 4000, None), (104, "a", None), (None, FR, None), (107, "日", None)]
    table = docs(spark, train + mixed)
    got = {r.doc_id: r for r in predicted(table, learned(table)).collect()}
    assert got[100].lang_pred == "en" and set(got[100].proportions) == {"en", "fr"} and 0.5 < got[100].score < 0.85
    assert {i: got[i].lang_pred for i in (101, 102, 103)} == {101: "und", 102: "und", 103: "und"} and got[101].score == 0
    assert all(got[i].lang_pred in ("en", "fr") for i in (104, 105, 107)) and got[106].lang_pred == "en" and got[106].score == 1.0
    assert got[None].lang_pred == "fr" and got[None].held_out is False


@pytest.mark.parametrize("k", [6, 30])
def test_two_languages_of_many(k):
    """Against all pairs: a mixture that gains more than one penalty, but less than k - 1, is found."""
    rng = np.random.default_rng(k)
    letters = [rng.dirichlet(np.full(26, 0.7)) for _ in range(k)]
    draw = lambda j, n: bytes(rng.choice(26, n, p=letters[j]).astype(np.uint8) + 97)
    table = np.full((k, language.CELLS), 0.1)
    for j in range(k):
        text = draw(j, 30_000)
        np.add.at(table[j], grams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0], 1)
    model = language.Mixture([f"l{j:02}" for j in range(k)], np.log(table / table.sum(1, keepdims=True)).astype(np.float32))
    texts = [draw(i % k, 200) + draw((i + 1) % k, n) for i, n in enumerate((0, 3, 6, 9, 12, 15, 20, 60))]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    got, _ = model.proportions(np.frombuffer(b"".join(texts), np.uint8), offsets)
    gated = 0
    for i, text in enumerate(texts):
        cell = grams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        share = np.exp(model.logs[:, cell].astype(np.float64))
        size = np.log(len(cell))
        single = np.log(share).sum(1)
        top = int(single.argmax())
        pairs = {}
        for j in set(range(k)) - {top}:
            w = np.full(2, 0.5)
            for _ in range(300):
                joint = share[[top, j]] * w[:, None]
                w = (joint / joint.sum(0)).mean(1)
            pairs[j] = np.log((share[[top, j]] * w[:, None]).sum(0)).sum()
        j = max(pairs, key=pairs.get)
        gain = pairs[j] - single[top]
        if gain > size + 0.2:
            assert np.count_nonzero(got[i]) >= 2 and got[i][top] < 1, (i, gain, size)
        elif gain < size - 0.2:
            assert np.count_nonzero(got[i]) == 1 and got[i][top] == 1
        gated += size + 0.2 < gain < (k - 1) * size
    assert gated and np.count_nonzero(got[0]) == 1


def test_held_out_rows_are_not_learned(spark):
    rows = [(i, EN, "en") for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    table = docs(spark, rows)
    assert learned(table).names == []
    assert {(r.lang_pred, r.score) for r in predicted(table, learned(table)).collect()} == {("und", 0.0)}
    assert predicted(docs(spark, []), learned(docs(spark, []))).collect() == []


def test_grams_stay_inside_their_text():
    from starmart.llm.words import slices
    import pyarrow as pa

    texts = ["Ab  c!d", "", "é", "x", None, "ab c d"]
    whole = [grams(d, o) for _, _, d, o in slices(pa.array(texts), 10**9)][0]
    parts = [grams(d, o)[0].tolist() for x in texts for _, _, d, o in slices(pa.array([x], pa.string()))]
    assert [whole[0][a:b].tolist() for a, b in zip(whole[1][:-1], whole[1][1:], strict=True)] == parts
    assert parts[0] == parts[5] and parts[1] == parts[4] == []
    assert (language._letters(*[x for x in slices(pa.array(["1", "é", "日", "a", "😀"]))][0][2:]) == [False, True, True, True, False]).all()
