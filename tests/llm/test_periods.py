from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from starmart.llm import periods
from starmart.llm.words import BLANKS, words


def brute_runs(w, least=12):
    """Every lag of every word, one after the other."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            m = 0
            while i + m < len(w) and w[i + m] == w[i + m - q]:
                m += 1
            if m and m + q >= max(least, 2 * q):
                best.setdefault((i - q, m + q), q)  # lags rise, so the smallest period stays
            i += m + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def brute(pairs):
    out = []
    for i, t in pairs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((i, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                    sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=str)


def got(df):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted(map(tuple, periods.digest(df).select(*columns).collect()), key=str)


def direct(texts, least=12):
    """Runs of several texts in one slice, without Spark."""
    raw = [" ".join(t).encode() for t in texts]
    found = words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), BLANKS)
    out = [[] for _ in texts]
    for text, start, length, period in zip(*(x.tolist() for x in periods.runs_of(found, found.hashes(), least)), strict=True):
        out[text].append((start, length, period))
    return out


def test_edges(edge):
    df, pairs = edge
    short = [p for p in pairs if p[1] is None or len(p[1]) < 1000]
    assert [r for r in got(df) if r[0] != 7] == brute(short)
    assert next(r for r in got(df) if r[0] == 7)[1] == 0


@pytest.mark.parametrize("seed", range(6))
def test_random_words_of_small_alphabets(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        k, n = rng.choice([1, 2, 2, 3, 4]), rng.randrange(0, 90)
        w = [rng.choice("abcd"[:k]) for _ in range(n)]
        for _ in range(rng.randrange(3)):  # repeats with breaks inside and around
            a = rng.randrange(n + 1)
            w[a:a] = w[max(0, a - rng.randrange(1, 30)) : a] * rng.randrange(1, 5)
        texts.append(w)
    assert [sorted(x) for x in direct(texts)] == [brute_runs(w) for w in texts]


@pytest.mark.parametrize("least", [2, 5, 8, 30])
def test_other_least_lengths(least):
    rng = random.Random(least)
    texts = [[rng.choice("ab") for _ in range(rng.randrange(60))] for _ in range(60)]
    assert [sorted(x) for x in direct(texts, least)] == [brute_runs(w, least) for w in texts]


def test_nested_and_touching_runs():
    inner = list("aaaaaaaaaaaab")
    texts = [inner * 9, list("abababababab") + list("babababababa"), (list("abc") * 5 + ["x"]) * 4, list("aabaab" * 6) + list("aab"), ["a"] * 400 + ["b"] + ["a"] * 400]
    assert [sorted(x) for x in direct(texts)] == [brute_runs(w) for w in texts]


def test_long_periodic_texts_take_little_time():
    start = time.perf_counter()
    texts = [["a"] * 200_000, list("abcdefghij") * 20_000, ["a"] * 60_000 + ["b"] + ["a"] * 60_000, (["a"] * 300 + ["b"]) * 400]
    got = direct(texts)
    assert got[0] == [(0, 200_000, 1)] and got[1] == [(0, 200_000, 10)]
    assert (0, 400 * 301, 301) in got[3] and len(got[3]) == 401
    assert (0, 60_000, 1) in got[2] and (60_001, 60_000, 1) in got[2]
    assert time.perf_counter() - start < 60


def test_rows_over_spark(frame):
    rng = random.Random(3)
    pairs = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choice("ab") for _ in range(rng.randrange(70)))) for i in range(60)]
    pairs += [pairs[0], (pairs[1][0], pairs[2][1]), (None, "a " * 30)]
    assert sum(r[1] for r in brute(pairs)) > 20
    assert got(frame(pairs)) == brute(pairs)


def test_planted_tail(frame):
    rng = random.Random(8)
    pairs = [(i, "  ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(120)))) for i in range(200)] + [(None, "a b c"), (300, None)]
    want = []
    for i, t in pairs:
        w, h = re.findall(r"[^\x20\x09-\x0D]+", t or ""), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
        want.append((i, " ".join(w)))
    assert got(periods.planted(frame(pairs))) == brute(want) and any(r[1] for r in brute(want))


def test_texts_and_other_columns(frame):
    df = frame([(1, "x  y"), (2, "a b c " * 8), (3, None)])
    out = periods.collapsed(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[1].text, rows[2].text, rows[3].text, rows[2].spans) == ("x  y", "a b c", None, "own")


def test_empty_table(frame):
    assert got(frame([])) == []
