from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from starmart.llm import substrings
from starmart.llm.words import pack, unpack


def brute(pairs, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in pairs]
    least = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - size + 1):
                g = tuple(w[k : k + size])
                least[g] = min(least.get(g, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - size + 1) if i is not None else ():
            if least[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **more):
    return sorted(map(tuple, substrings.removed(df, **more).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_edges(edge):
    df, pairs = edge
    assert got(df) == brute(pairs, 50)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_repeats_over_many_slices_and_buckets(frame, seed):
    rng = random.Random(seed)
    passages = [[f"p{k}_{rng.randrange(40)}" for _ in range(rng.randrange(6, 30))] for k in range(12)]
    pairs = []
    for i in rng.sample(range(1000), 80):
        w = [str(rng.randrange(9)) for _ in range(rng.randrange(20))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(3)
            w += p[a : len(p) - rng.randrange(3)] + [str(rng.randrange(50)) for _ in range(rng.randrange(5))]
        pairs.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    pairs += [pairs[0], (pairs[1][0], pairs[2][1]), (None, pairs[3][1])]
    want = brute(pairs, 10)
    assert sum(x[2] for x in want) > 0
    assert got(frame(pairs), size=10, slice_bytes=2000, per_bucket=200) == want
    assert got(frame(pairs), size=10) == want


def test_empty_table(frame):
    assert got(frame([])) == []


def test_packing_round_trips():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        for bits in (3, 34, 64):
            x = np.sort(rng.integers(0, 2**bits, n, dtype=np.uint64, endpoint=False)) if bits < 64 else np.sort(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            assert (unpack(pack(x)) == x).all()
