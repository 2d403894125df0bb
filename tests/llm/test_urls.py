from __future__ import annotations

import random
import re

import numpy as np

from starmart.llm import urls
from starmart.llm.storage import importable


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def test_automaton_against_regular_expressions():
    rng = random.Random(4)
    globs = ["", "*", "**", "a", "?", "*a", "a*", "a*b", "é?", "a**b?c", "x" * 70 + "*y", "*" + "ab" * 40]
    globs += ["".join(rng.choices("ab?*é", k=rng.randrange(1, 9))) for _ in range(120)]
    texts = ["", "a", "é", "x" * 70 + "zzy", "ab" * 45] + ["".join(rng.choices("abé", k=rng.randrange(12))) for _ in range(200)]
    got = urls.Automaton(globs).matches(*slice_of(texts))
    for g, glob in enumerate(globs):
        pattern = re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob), re.S)
        assert [bool(x) for x in got[:, g]] == [pattern.fullmatch(t) is not None for t in texts], glob


def judge(spark, links):
    importable(spark)
    pages = spark.createDataFrame([(i, u, None, "own") for i, u in enumerate(links)], "page_id long, url string, html string, host string").repartition(2)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages).collect()}


def test_rules_and_edges(spark):
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme": ("", "", None, "allow"),
        "HTTP://WWW.Example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://example.com/en/": ("example.com", "/en/", "example.com/en/", "block"), "http://a.example.com/en/x": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "http://x.net/e": ("x.net", "/e", None, "allow"), "http://x.com": ("x.com", "", None, "allow"), "http://x.com?/": ("x.com", "", None, "allow"),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"), "http://evil.org/x.com/": ("evil.org", "/x.com/", None, "allow"), "a://b://c.com/": ("b:", "//c.com/", None, "allow"),
        "http://ads.x.org/": ("ads.x.org", "/", None, "block"), "http://x.org/a/banner1/b": ("x.org", "/a/banner1/b", None, "block"), "http://É.com/é": ("É.com", "/é", "com/", "allow"),
        "http://x.org/" + "p" * 5000 + ".exe": ("x.org", "/" + "p" * 5000 + ".exe", None, "block"), "http://x.com\0/": ("x.com\0", "/", None, "allow"),
    }
    links = list(cases) + ["http://x.net/es/1"]
    got = judge(spark, links)
    assert got == {i: cases[u] for i, u in enumerate(links)}
    assert judge(spark, []) == {}
