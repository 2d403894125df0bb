from __future__ import annotations

import random
import re

import pytest

from starmart.llm import forest
from starmart.llm.components import components
from starmart.llm.forest import Forest
from starmart.llm.storage import importable


def sets(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(pairs):
    s = [sets(t) for _, t in pairs]
    linked = [[i != j and bool(s[i]) and bool(s[j]) and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j]) for j in range(len(s))] for i in range(len(s))]
    root = list(range(len(s)))
    for _ in root:
        root = [min([root[i]] + [root[j] for j in range(len(s)) if linked[i][j]]) for i in range(len(s))]
    ids = {r: min((pairs[i][0] for i in range(len(s)) if root[i] == r and pairs[i][0] is not None), default=None) for r in root}
    return sorted(((pairs[i][0], ids[root[i]], sum(linked[i]), len(s[i])) for i in range(len(s))), key=str)


def got(df, **more):
    return sorted(map(tuple, forest.joined(df, Forest(**more)).select("doc_id", "class_id", "n_links", "n_shingles").collect()), key=str)


def test_edges(edge):
    df, pairs = edge
    assert got(df) == brute(pairs)


def near_copies(rng, groups=6, most=25):
    pairs, i = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(4, 160))]
        for _ in range(rng.randrange(1, most)):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"n{rng.randrange(500)}"
            pairs.append((i, " ".join(w)))
            i += rng.randrange(1, 3)
    rng.shuffle(pairs)
    return pairs + [pairs[0], (pairs[1][0], pairs[2][1])]


@pytest.mark.parametrize("chunk", [3, 512])
def test_near_copies_in_chunks(frame, chunk):
    pairs = near_copies(random.Random(8))
    want = brute(pairs)
    assert max(x[2] for x in want) > 5
    assert got(frame(pairs), chunk_nodes=chunk) == want


def test_leftover_buckets_become_families(frame):
    """With no round at all every bucket is a family; the exact step still decides."""
    pairs = near_copies(random.Random(9), groups=4, most=12)
    assert got(frame(pairs), rounds=0) == brute(pairs)


def test_recall_sets_the_prefix():
    assert Forest(trees=40, recall=0.99999).prefix == 6
    assert Forest(trees=40, recall=0.5).prefix > 6 > Forest(trees=10, recall=0.99999).prefix >= 1


def test_deduplicated_keeps_one_of_each_class(frame):
    pairs = near_copies(random.Random(10)) + [(9000, None), (9001, ""), (None, "alone text")]
    docs = frame(pairs)
    kept = forest.deduplicated(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    classes = brute(pairs)
    want = sorted([c for _, c, _, n in {(0, x[1], 0, 1) for x in classes if x[3]} if c is not None] + [9000, 9001])
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == want
    assert [r.text for r in rows if r.doc_id is None] == ["alone text"]


def test_empty_table(frame):
    assert got(frame([])) == [] and forest.deduplicated(frame([])).collect() == []


def test_components(spark):
    importable(spark)
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (5, 5)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {(i, 0) for i in [*range(1, 41), 100]} | {(201, 200)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
