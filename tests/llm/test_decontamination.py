from __future__ import annotations

import hashlib
import random
import re

import pytest

from starmart.llm import decontamination


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(pairs, items, size=10):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if n else ():
            grams.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for i, t in pairs:
        w, hit, ids = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                found = grams.get(tuple(w[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids |= {str(x) for x in found if x is not None}
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame([(i, t, None) for i, t in items], "item_id long, text string, row string")


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def test_edges(spark, edge):
    df, pairs = edge
    items = [(1, "Word!"), (2, None), (3, ""), (10, "A-b C d e f g h i j k"), (2, "word"), (None, "日本語")]
    assert got(decontamination.contamination(df, bench(spark, items))) == brute(pairs, items)
    assert got(decontamination.contamination(df, bench(spark, []))) == brute(pairs, [])


@pytest.mark.parametrize("block", [200, 3000, 10**9])
def test_blocks_of_any_size_give_the_same(spark, frame, block):
    rng = random.Random(5)
    vocabulary = ["Aa", "b", "é", "9", "x"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(14)))) for k in range(40)]
    pairs = [(i, "-".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(60)] + [(1, "b 9")]
    docs = frame(pairs)
    scanned = decontamination.scanned(docs.select("doc_id", "text"), bench(spark, items), ["doc_id"], max_set_bytes=block)
    want = brute(pairs, items)
    assert sorted((r.row.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in scanned.collect()) == sorted(x[:4] for x in want)
    kept = decontamination.decontaminated(docs, bench(spark, items), max_set_bytes=block)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x[0] for x in want if not x[5])


def test_spans_are_cut_out(spark, frame):
    docs = frame([None, "", "one TWO three, four!", "four five"])
    out = decontamination.spans_removed(docs, bench(spark, [(1, "two three")]))
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: None, 1: "", 2: "one , four!", 3: "four five"}
    assert decontamination.decontaminated(frame([]), bench(spark, [(1, "a")])).collect() == []
