from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starmart.llm import resampling, spread


def features(text, n):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return w, [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(pairs, target, n=1, buckets=10_000, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in pairs for f in features(t, n)[1])
    t = Counter(bucket(f) for x in target for f in features(x, n)[1])
    S, T = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, text in pairs:
        w, f = features(text, n)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(w)])
    able = sorted((r for r in rows if r[5] >= least and r[3] is not None), key=lambda r: (-r[3], r[0], r[5], r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(df, target, **more):
    return sorted(map(tuple, resampling.resampled(df, target, **more).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture
def bench(spark):
    def make(texts):
        return spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "item_id long, text string, line string").repartition(2)

    return make


def test_crc_of_words():
    rng = random.Random(1)
    said = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 7, 63, 64, 65, 66, 300]))) for _ in range(400)]
    edges = np.cumsum([0, *map(len, said)])
    state = np.array([zlib.crc32(str(i).encode()) if i % 3 else 0 for i in range(len(said))], np.uint32)
    found = resampling.crc_on(state, np.frombuffer(b"".join(said), np.uint8), edges[:-1], edges[1:])
    assert found.tolist() == [zlib.crc32(x, int(c)) for x, c in zip(said, state, strict=True)]


def test_edges(edge, bench):
    df, pairs = edge
    target = ["", None, "word a b é", "w1x1 w2x2"]
    assert got(df, bench(target)) == brute(pairs, target)


@pytest.mark.parametrize("n, buckets", [(1, 10_000), (2, 50), (3, 70_000)])
def test_random_texts_with_hot_lines(frame, bench, monkeypatch, n, buckets):
    monkeypatch.setattr(spread, "LEAST_SHARE", 5)
    monkeypatch.setattr(spread, "SHARES", 9)
    rng = random.Random(n)
    lines = [" ".join(f"{rng.choice('abÄéX')}{rng.randrange(30)}" for _ in range(rng.randrange(12))) for _ in range(40)]
    pairs = [(i, "\n".join([lines[0]] * (rng.random() < 0.7) + [rng.choice(lines) for _ in range(rng.randrange(7))])) for i in rng.sample(range(999), 150)]
    pairs += [pairs[0], pairs[0], (pairs[1][0], pairs[2][1]), (None, pairs[3][1]), (5000, None)]
    target = [rng.choice(lines) + "\n" + rng.choice(lines) for _ in range(8)]
    want = brute(pairs, target, n, buckets, percent=40)
    assert sum(r[4] is not None for r in want) > 5
    assert got(frame(pairs), bench(target), n=n, buckets=buckets, percent=40) == want


def test_ties_and_shares(frame, bench):
    """Equal rows tie; every share from none to all is drawn exactly."""
    text = "one two three four five six seven eight nine ten " * 2
    pairs = [(7, text), (7, text), (9, text), (8, text + "x"), (1, "short")]
    for percent in (0, 25, 49, 50, 100):
        assert got(frame(pairs), bench(["five"]), percent=percent) == brute(pairs, ["five"], percent=percent)


def test_empty_tables(frame, bench):
    assert got(frame([]), bench(["a"])) == []
    pairs = [(i, "a b c d e " * 5) for i in range(20)]
    assert got(frame(pairs), bench([])) == brute(pairs, [])
