from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from starmart.llm import lines, spread


def key(line):
    bare = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m.group().lower(), bare)


def brute(pairs, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n") if i is not None else ():
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, t in pairs:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if i is None or last.get(key(x), i) <= i]
        out.append((i, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, lines.digest(df).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


def test_edges(edge):
    df, pairs = edge
    assert got(df) == brute(pairs)


def test_threshold_length_case_and_blanks(frame):
    at = "Ünder THE same sky all lines of forty are."  # 42 code points
    short, exact = "x" * 39, "y" * 40
    pairs = [(i, f"own {i}\n \t{at}\r\n{exact}\n{short}\n\n") for i in range(4)]
    pairs += [(4, at.replace("THE", "the") + "\x0b"), (5, at.replace("Ü", "ü")), (7, exact + " \n" + exact), (8, "\n".join([at] * 3))]
    want = brute(pairs)
    assert {r[0]: r[2] for r in want} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 1, 5: 0, 7: 0, 8: 0}
    assert got(frame(pairs)) == want


def test_repeated_and_missing_ids(frame):
    a, b = "a line that is longer than forty characters, a", "a line that is longer than forty characters, b"
    pairs = [(1, f"{a}\n{b}"), (1, f"one\n{a}"), (1, f"{b}\n{a}\n{b}"), (None, a), (2, a), (3, a), (4, a), (9, f"{a}\n{a}"), (9, b), *[(i, b) for i in (2, 3, 4)]]
    assert got(frame(pairs)) == brute(pairs)


@pytest.mark.parametrize("least", [1, 1_000])
def test_random_with_hot_lines(frame, monkeypatch, least):
    monkeypatch.setattr(spread, "LEAST_SHARE", least)
    monkeypatch.setattr(spread, "SHARES", 7)
    rng = random.Random(5)
    pool = [f"line {k} " + "abc DEF " * rng.randrange(3, 8) for k in range(12)]
    pairs = []
    for i in rng.sample(range(10_000), 120):
        rows = [rng.choice(pool) for _ in range(rng.randrange(4))] + (["one very hot line that every document holds somewhere"] if rng.random() < 0.9 else [])
        rng.shuffle(rows)
        pairs.append((i, "\n".join(rows)))
    want = brute(pairs)
    assert sum(r[2] for r in want) > 100
    assert got(frame(pairs)) == want


def test_texts_and_other_columns(frame):
    line = "a license line that many documents carry at their end"
    df = frame([(i, f"text {i}\n{line}") for i in range(6)] + [(7, None), (8, "")])
    out = lines.deduplicated(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[7].text is None and rows[8].text == "" and rows[0].text == "text 0" and rows[5].text == f"text 5\n{line}" and rows[3].row == "own"


def test_empty_table(frame):
    assert got(frame([])) == []


def test_texts_are_not_exploded_with_their_lines(frame):
    """What is shuffled by line is hashes: no exchange but the last join's holds a text."""
    plan = lines.shared_lines(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a#" in plan and "partial_count" in plan
