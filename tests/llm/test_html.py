from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import html
from starmart.llm.html import blocks, extracted
from starmart.llm.storage import importable
from starmart.llm.words import pack_bits, unpack_bits

CASES = [
    ("<p>a &amp; b&nbsp;c<br>d</p>tail", ["a & b c d", "tail"]), ("<p>a<b", ["a"]), ("<article><header><h1>T</h1></header><p>x &am", ["T", "x &am"]),
    ("<article><p>q<section class='comments'>no<p>no</section></p>ok</article>z", ["q", "ok"]), ("", []), ("<p>1 < 2 and 3 > 2</p>", ["1 < 2 and 3 > 2"]),
    ("<script>if(a<b){'</p>'}", []), ("<article></article><p>x", []), ("<ARTICLE>é<br/>ü</ARTICLE>", ["é ü"]), ("<nav>n<ul><li>m</ul></nav><p>x<footer>f", ["x"]),
    ("<div id=side-bar>keep</div><div class='left sidebar'>no</div>", ["keep"]), ("<main><aside>no</aside><form>no</form><p>y<!-- c --> z</main>", ["y z"]),
    ("<head><title>t</title></head><body class='nav'><p>b</p></body>", ["b"]), ("<p><b>one<br><p>two", ["one", "two"]), ("<article><div class=cookie-notice>no</div>&lt;p&gt; &#233;</article>", ["<p> é"]),
    ("<div role=navigation>no</div><p hidden>x</p><div hidden>no</div>", ["x"]), ("<!-- open", []), ("<style>p{}</style><textarea>no</textarea>v", ["v"]),
]

PROSE = " ".join(f"word{i}" for i in range(12))
CASES += [
    ("<article><p title=it's>Hello</p><p>don't stop</p></article>", ["Hello", "don't stop"]), ("<a href='a>b'>c</a> d", ["c d"]), ("<div data-hidden=1>y</div>", ["y"]),
    ("<!--><p>a</p><!-- x --><p>b</p>", ["a", "b"]), ("<!---><p>a", ["a"]), ("<p>a<!-- b --!>c", ["ac"]),
    ("<p>a</p><button>b<p>rest", ["a", "b", "rest"]), ("<p>a<noscript>n<p>rest", ["an", "rest"]), ("<p>a<button>x</button>b</p>", ["ab"]), ("<svg><title>x</title><text>n</text></svg>y", ["y"]),
    (f"<article><div id=related-work><p>{PROSE}</p></div></article>", [PROSE]), (f"<article><section class='social history'>{PROSE}</section></article>", [PROSE]),
    (f"<div class='main-content login-free'><p>{PROSE}</p></div>", [PROSE]), ("<div class=related><ul><li><a href=x>one story of another day and place</a></ul></div><p>x", ["x"]),
    ("<p>t</p><p class=ad>buy</p><ins class=adsbygoogle>no</ins><ul><li class=comment>no<ul><li>no</ul><li>yes</ul><h2 class=related>no</h2><p>u</p>", ["t", "yes", "u"]),
    ("<p class=comment>no<p>yes</p>", ["yes"]), ("<ins class=ad>never ended <p>yes", ["never ended", "yes"]),
    ("<article>of this page</article><article class=teaser>of another</article>", ["of this page"]), ("<article class=card>all there is</article>", ["all there is"]),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_blocks(html, want):
    assert [text for text, _ in blocks(html)] == want


@pytest.mark.parametrize("other", [
    "<ol class=comments><li><article class=comment-body>no</article></ol>", "<aside><article>no</article></aside>", "<!-- <main> -->", "<script>'<article>'</script>",
    "<article class=comment>no</article>", "<template><main>no</main></template>", "<p title='<main>'></p>"])
def test_only_an_undropped_main_element_decides(other):
    assert blocks(f"<div id=body><p>Text</p></div>{other}") == [("Text", False)]
    assert blocks(f"<div><p>Text</p></div>{other}<article>y</article>") == [("y", True)]


class Plain(HTMLParser):
    """Article text by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.out, self.now = False, [], ""

    def flush(self):
        text, self.now = " ".join(self.now.split()), ""
        if text:
            self.out.append(text)

    def handle_starttag(self, tag, attrs):
        self.on |= tag == "article"
        if self.on and tag in ("p", "h1", "article"):
            self.flush()
        self.now += " " if self.on and tag == "br" else ""

    def handle_endtag(self, tag):
        if self.on and tag in ("p", "h1", "article"):
            self.flush()
        self.on &= tag != "article"

    def handle_data(self, data):
        self.now += data if self.on else ""


def pages(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "own", "own") for r in rows], "page_id long, url string, html string, host string, text string").repartition(3)


def test_articles_of_the_given_pages(spark):
    importable(spark)
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in table.collect()}
    for r in extracted(table).collect():
        plain = Plain()
        plain.feed(source[r.page_id])
        plain.close()
        assert r.text == "\n".join(plain.out) and r.n_chars == len(r.text)


BANNER = "all rights of this site are kept by its very owner since the year of its birth"


def test_host_repeats_go_and_unique_runs_stay(spark):
    own = lambda i: " ".join(f"{i}unique{k}" for k in range(20))
    rows = [(i, f"http://h{i % 2}.org/{i}", f"<div>{BANNER}</div><p>{own(i)}</p><div>{BANNER} page {i}</div>") for i in range(12)]
    rows += [(50, "http://alone.org/", f"<div>{BANNER}</div><p>x</p>"), (51, None, f"<p>{own(51)}"), (52, "http://h0.org/", f"<article>{BANNER}</article>"), (53, "http://h1.org/b", None), (54, "http://h1.org/c", "")]
    rows += [(60, "http://twice.org/", f"<p>{own(60)}")] * 2 + [(None, "http://twice.org/", f"<p>{own(61)}")]
    want = {i: own(i) for i in range(12)} | {50: f"{BANNER}\nx", 51: own(51), 52: BANNER, 53: "", 54: "", 60: own(60), None: own(61)}
    for size in ({}, {"slice_bytes": 300, "per_bucket": 20}):
        got = extracted(pages(spark, rows), **size).collect()
        assert len(got) == len(rows) and {r.page_id: r.text for r in got} == want


def test_exactly_the_covered_tokens_go(spark):
    own = lambda i, n: " ".join(f"{i}own{k}" for k in range(n))
    rows = [(i, "http://h.org/", f"<p>{own(i, 3)} {BANNER} {own(i, 2)}z</p><p>{own(i, 40)} {BANNER}</p>") for i in range(4)]
    rows += [(10 + i, "http://copy.org/", f"<p>{own(9, 30)}</p><p>{BANNER}</p>") for i in range(3)]  # copies of one page, in blocks of other cuts
    rows += [(20, "http://copy.org/", f"<p>{own(9, 30)} {BANNER}</p>"), (21, "http://other.org/", f"<p>{BANNER}</p>")]
    rows += [(30, "http://same.org/", f"<p>{own(30, 9)}</p>"), (30, "http://same.org/", f"<p>{own(30, 9)} x</p>")]  # one page of two rows
    want = {i: f"{own(i, 3)} {own(i, 2)}z\n{own(i, 40)}" for i in range(4)} | {10 + i: f"{own(9, 30)}\n{BANNER}" for i in range(3)} | {20: f"{own(9, 30)} {BANNER}", 21: BANNER}
    for size in ({}, {"slice_bytes": 300, "per_bucket": 20}):
        got = extracted(pages(spark, rows), **size).collect()
        assert {r.page_id: r.text for r in got if r.page_id != 30} == want
        assert sorted(r.text for r in got if r.page_id == 30) == [own(30, 9), f"{own(30, 9)} x"]


def test_equal_keys_of_other_tokens_cover_nothing(spark, monkeypatch):
    """With one key for all windows, only the tokens tell."""
    rows = pa.table({"host": ["h", "h"], "page": [1, 2], "stream": [1, 2], "lines": ["a b c d e f g h", "b c d e f g h i"]})
    monkeypatch.setattr(html, "mix", lambda x: x * 0)
    assert len(set(html._suffixes(rows, 8, 1)[2].tolist())) == 1
    key = (pa.scalar(0),)
    sent = html._send(8, 1)(key, rows)
    found = html._candidates(8, 1)(key, rows, html._neighbours(sent))
    assert found.column("window").to_pylist() == rows.column("lines").to_pylist() and found.column("low_page").to_pylist() == found.column("high_page").to_pylist()


def test_neighbours_of_the_sorted_suffixes_are_compared():
    """Stretches of suffixes with a common start, also over the ends of batches; two pages and two streams have to be in one."""
    rows = [(0, "h", "a b c", 1, 1, 7, 7), (1, "h", "a b c", 2, 2, 8, 8), (2, "h", "a b c", 1, 1, 7, 7), (0, "h", "a b d", 1, 1, 7, 7), (0, "i", "a b d", 2, 2, 8, 8),
            (0, "i", "b c d", 3, 3, 9, 9), (1, "i", "b c d", 4, 4, 9, 9), (0, "j", "b c d", 3, 4, 8, 9)]
    table = pa.table(list(zip(*rows)), names=["slice", "host", "window", "low_page", "high_page", "low_stream", "high_stream"])
    want = [(k, "h", "a b c") for k in range(3)] + [(0, "j", "b c d")]
    for size in (1, 2, 3, 100):
        got = [tuple(x.values()) for b in html._compared(3)(iter(table.to_batches(max_chunksize=size))) for x in b.to_pylist()]
        assert got == want
    assert list(html._compared(3)(iter([]))) == []


def test_host_repeats_come_from_a_sorted_array(spark, monkeypatch):
    rows = [(i, "http://h.org/", f"<p>{BANNER}</p><p>{i}own text</p>") for i in range(4)]
    monkeypatch.setattr(html, "_compared", lambda least: lambda batches: iter(()))
    assert all(r.text.startswith(BANNER) for r in extracted(pages(spark, rows)).collect())


def test_empty_table(spark):
    assert extracted(pages(spark, [])).collect() == []


def test_pages_with_a_main_element_are_in_the_array_too(spark):
    """One page without a main element: what it shares with the others of its host goes, theirs stays whole."""
    own = lambda i, n=20: " ".join(f"{i}own{k}" for k in range(n))
    rows = [(i, "http://h.org/", f"<div>{BANNER}</div><article><p>{own(i)}</p><p>{own('same')}</p></article>") for i in range(6)]
    rows += [(10, "http://h.org/", f"<div>{BANNER}</div><p>{own(10)}</p><p>{own('same')} end</p>"), (11, "http://other.org/", f"<div>{BANNER}</div><p>{own(11)}</p>")]
    want = {i: f"{own(i)}\n{own('same')}" for i in range(6)} | {10: f"{own(10)}\nend", 11: f"{BANNER}\n{own(11)}"}
    for size in ({}, {"slice_bytes": 300, "per_bucket": 20}):
        assert {r.page_id: r.text for r in extracted(pages(spark, rows), **size).collect()} == want


def test_a_stream_of_many_copies_is_dealt_to_several_slices(spark, monkeypatch):
    own = " ".join(f"own{k}" for k in range(20))
    rows = [(1, "http://h.org/", f"<p>{own}</p>")] * 30 + [(2, "http://h.org/", f"<p>{own}</p>")] * 30 + [(3, "http://h.org/", f"<p>{BANNER}</p><p>x {BANNER}</p>"), (4, "http://i.org/", f"<p>{BANNER}</p>")]
    got = extracted(pages(spark, rows), slice_bytes=2000).collect()
    assert sorted(r.text for r in got) == sorted([own] * 60 + [f"{BANNER}\nx {BANNER}", BANNER])
    cut = html._unique_runs
    monkeypatch.setattr(html, "_unique_runs", lambda *how: lambda key, table, answers: pa.table({c: cut(*how)(key, table, answers).column(c) for c in ("page_id", "url")} | {"text": pa.array([f"{key[0].as_py()}"] * len(table))}))
    seen = {r.text for r in extracted(pages(spark, rows), slice_bytes=2000).collect() if r.page_id in (1, 2)}
    assert len(seen) > 2


def test_sorted_numbers_come_back_from_their_bits():
    made = np.random.default_rng(7)
    for n, top in ((0, 1), (1, 10), (2, 3), (1000, 1001), (20_000, 2**43), (5, 2**62)):
        x = np.unique(made.integers(0, top, n).astype(np.uint64))
        assert unpack_bits(pack_bits(x)).tolist() == x.tolist()
