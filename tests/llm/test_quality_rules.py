from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from starmart.llm import quality
from starmart.llm.quality import Field, Measured
from starmart.llm.words import slices


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in quality.SYMBOLS), dup, len(repeated), len(w) < 50 or 100 * len(repeated) > 50 * len(w)


TEXTS = ["a b c\na b c\n\na b c \n", "x " * 60, " ".join(map(str, range(60))), "# $ %\n" * 20, "é|ü\n\n \né|ü", "one\rtwo\x0bthree\x0c"]


def test_base_counts(edge, frame):
    df, pairs = edge
    for docs, want in ((df, pairs), (frame(TEXTS), list(enumerate(TEXTS)))):
        got = quality.judged(docs, Field.untrained()).collect()
        assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(((i, *brute(t)) for i, t in want), key=str)
        assert all(r.kept == (not r.base_failed) for r in got)


def test_viterbi_finds_the_best_sequence():
    rng = np.random.default_rng(1)
    for _ in range(20):
        field = Field(rng.normal(size=(len(quality.FEATURES), 2)), rng.normal(size=(2, 2)))
        length = rng.integers(0, 7, 5)
        first = np.concatenate([[0], np.cumsum(length)])
        x = rng.normal(size=(first[-1], len(quality.FEATURES)))
        got = field.viterbi(x, first)
        score = x @ field.emission
        for a, b in itertools.pairwise(first.tolist()):
            value = lambda s, a=a: sum(score[a + i, y] for i, y in enumerate(s)) + sum(field.transition[p, q] for p, q in itertools.pairwise(s))
            assert value(got[a:b].tolist()) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=b - a))))


def test_likelihood_and_gradient():
    rng = np.random.default_rng(2)
    field = Field(rng.normal(size=(len(quality.FEATURES), 2)), rng.normal(size=(2, 2)))
    x = rng.normal(size=(3, 4, len(quality.FEATURES)))
    mask = np.arange(4) < np.array([4, 2, 1])[:, None]
    labels = rng.integers(0, 2, (3, 4))
    one = np.eye(2)[labels] * mask[:, :, None]
    two = one[:, :-1, :, None] * one[:, 1:, None, :]
    value, emission, transition = field.likelihood(x, one, two, mask)
    total = 0.0
    for d in range(3):
        n = int(mask[d].sum())
        s = x[d] @ field.emission
        score = lambda y, s=s: sum(s[i, v] for i, v in enumerate(y)) + sum(field.transition[p, q] for p, q in itertools.pairwise(y))
        total += score(labels[d, :n].tolist()) - np.log(sum(np.exp(score(y)) for y in itertools.product((0, 1), repeat=n)))
    assert value == pytest.approx(total)
    for name, gradient in (("emission", emission), ("transition", transition)):
        moved = getattr(field, name).copy()
        moved[1, 1] += 1e-6
        near = Field(**{"emission": field.emission, "transition": field.transition, name: moved})
        assert (near.likelihood(x, one, two, mask)[0] - value) / 1e-6 == pytest.approx(gradient[1, 1], abs=1e-3)


def test_trained_field_tells_junk_from_prose(spark, frame):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("aeinorst"), rng.integers(2, 9)))
    prose = lambda: "\n".join(" ".join(word() for _ in range(15)).capitalize() + "." for _ in range(6))
    junk = lambda: "\n".join(" ".join(word() + str(rng.choice(["***", "###"])) for _ in range(15)) for _ in range(6))
    docs = frame([prose() if i % 2 else junk() for i in range(80)])
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    field = quality.trained(docs, labels)
    assert all(r.kept == bool(r.doc_id % 2) for r in quality.judged(docs, field).collect())
    kept = quality.retained(docs, field)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(1, 80, 2))
    assert quality.judged(frame([]), field).collect() == [] and quality.retained(frame([]), field).collect() == []
    assert (quality.trained(docs, labels.limit(0)).emission == Field.untrained().emission).all()


def test_marginals_are_sums_over_all_sequences():
    rng = np.random.default_rng(4)
    field = Field(np.zeros((len(quality.FEATURES), 2)), rng.normal(size=(2, 2)))
    score, mask = rng.normal(size=(2, 4, 2)), np.arange(4) < np.array([4, 3])[:, None]
    total, one, two = field.marginals(score, mask)
    for d, n in enumerate((4, 3)):
        weight = {y: np.exp(sum(score[d, i, v] for i, v in enumerate(y)) + sum(field.transition[p, q] for p, q in itertools.pairwise(y))) for y in itertools.product((0, 1), repeat=n)}
        assert np.exp(total[d]) == pytest.approx(sum(weight.values()))
        for i in range(n):
            assert one[d, i, 1] == pytest.approx(sum(w for y, w in weight.items() if y[i]) / sum(weight.values()))
        for i in range(n - 1):
            assert two[d, i, 1, 0] == pytest.approx(sum(w for y, w in weight.items() if y[i : i + 2] == (1, 0)) / sum(weight.values()))
    assert not one[1, 3].any() and not two[1, 2].any()


def _lines(rng, junk):
    word = lambda: "".join(rng.choice(list("aeinorst"), rng.integers(2, 9)))
    if junk:
        return " ".join(word() + str(rng.choice(["***", "###", "|"])) for _ in range(12))
    return " ".join(word() for _ in range(12)).capitalize() + "."


def _measured(texts):
    import pyarrow as pa

    (_, _, data, offsets), = slices(pa.array(texts), 10**9)
    return Measured(data, offsets)


def test_lines_of_a_mixed_document_are_told_apart():
    """Documents carry one label, and none is of one kind; still every line gets its own, also past the first segment."""
    rng = np.random.default_rng(5)
    kinds = [[bool(rng.random() < (0.15 if good else 0.85)) for _ in range(20)] for good in (1, 0) * 40]
    training = quality.Training(segment=8)
    m = _measured(["\n".join(_lines(rng, j) for j in k) for k in kinds])
    features = [m.features[a:b] for a, b in itertools.pairwise(m.first.tolist())]
    field = quality.fit(features, [1, 0] * 40, training)
    mixed = [[False] * 40 + [True] * 30 + [False] * 10, [True] * 9 + [False] * 3, [False] * 3 + [True]]
    m = _measured(["\n".join(_lines(rng, j) for j in k) for k in mixed])
    labels = field.viterbi(m.features, m.first)
    assert (labels == ~np.concatenate(mixed)).mean() > 0.97
    share = m.content_share(field)
    assert share == pytest.approx([50 / 80, 3 / 12, 3 / 4], abs=0.05)


def test_expected_labels_keep_to_the_document():
    rng = np.random.default_rng(6)
    m = _measured(["\n".join(_lines(rng, bool(rng.random() < 0.5)) for _ in range(30)) for _ in range(10)])
    features = [m.features[a:b] for a, b in itertools.pairwise(m.first.tolist())]
    training = quality.Training(segment=7)
    rows = quality.Sequences(features, [1, 0] * 5, training)
    one, _ = rows.expected(Field(rng.normal(size=(len(quality.FEATURES), 2)), rng.normal(size=(2, 2))), training)
    share = np.bincount(rows.document, (one[:, :, 1] * rows.weight).sum(1))
    assert (share[::2] > training.share - 0.01).all() and (share[1::2] < 1 - training.share + 0.01).all()


def test_slices_do_not_change_counts():
    import pyarrow as pa

    column = pa.array([None, *TEXTS, ""])
    whole = [Measured(data, offsets).n_repeat_words.tolist() for _, _, data, offsets in slices(column, 10**9)]
    parts = [x for _, _, data, offsets in slices(column, 1) for x in Measured(data, offsets).n_repeat_words.tolist()]
    assert whole == [parts]
