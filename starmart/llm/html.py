"""HTML extraction: the main text of pages, with a host suffix array for what the markup does not decide.

Markup first. A page is read as blocks of text, each with the place it stands in. Blocks in menus, sidebars,
footers, page headers, adverts, notices, forms, comments, scripts, styles and the head are dropped. What an element is follows from its own kind, its
role and its names, on every element; names that may also belong to text (`related`, `social`, `login`) decide only with what the element holds: few
words or many links. A main element with such a name goes if there is another. Tags are read by HTML's rules: a quote
opens a value only after `=`, only script, style, textarea, title and frames hold raw text, p, li, dt, dd and headings end without an end tag, and
a button, noscript or the like that is never ended takes nothing with it. Where the reading meets an article or a main
element that is not dropped itself, blocks outside it are dropped too, and blocks inside are kept whole, repeated or not. Such an
element decides its page even if it is empty; one in a comment, a script or a dropped element does not.

Blocks of pages without such an element are decided by the suffix array of their host. Every page of the host is in it, pages with a main
element too, with all blocks that the markup does not drop, inside that element and outside: its token suffixes in sorted order, where suffixes
with a common start are neighbours. A run of `least` tokens is boilerplate if neighbours with that common start stand in two pages
with different token streams, so copies of one page do not empty each other. Suffixes are cut after `least` tokens, as a longer common start
covers nothing more. One that shares its start with no other stream has no such neighbour, and a filter leaves it out of the sort: pages are dealt to
slices by their token stream, a slice sends each bucket the sorted hashes of its suffixes' starts in one packed row, and
gets back the hashes that another slice has too; those that two of its own streams have it knows. A stream that more rows have than a
slice should hold is dealt to several slices, and what its copies then share is told apart in the array. The others are sorted by host and tokens over ranges, whatever the size of the host, each slice with one row
for equal suffixes, and neighbours are compared by their tokens, so hash collisions add nothing. Exactly the tokens
that such windows cover are cut, and the unique runs of a block stay. Only a block with more than `most` of its tokens covered, whose other
tokens are plain numbers (a page number in a footer), goes whole.

Defined results: a null or empty html has an empty text; unclosed and truncated markup is read as far as it goes; a
page with a null URL has the empty host; a null page_id counts as a page of its own; repeated rows are extracted one
by one, and rows with an equal page_id are one page for the suffix array.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.storage import stored
from starmart.llm.urls import host_and_path
from starmart.llm.words import BLANKS, Words, mix, pack_bits, slices, unpack_bits, words

LEAST = 8
SLICE = 8_000_000
BUCKET = 2_000_000
#: Bytes that a page counts for beside its text.
PAGE_BYTES = 256
#: Values of a start's hash in a bucket: a start that no other slice has is taken for shared once in about a thousand times.
STARTS = np.uint64(1 << 31)

#: Elements by their part in the reading. Raw elements hold no markup; left-out ones go with all they hold.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_LEFT_OUT = {"noscript", "template", "svg", "math", "object", "select", "button", "canvas", "audio", "video", "map"}
_DROPPED = {"nav", "aside", "footer", "form", "head", "menu", "dialog"}
_MAIN = {"article", "main"}
_BOXES = {"div", "section", "header", "ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "blockquote", "figure", "figcaption", "fieldset", "details", "summary", "center", "span"} | _DROPPED | _MAIN
_BREAKS = {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "hr", "address", "body", "html", "option", "caption", "legend", "title"} | (_BOXES - {"span"})
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Names that say what an element is, whatever it holds.
_SURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adsbygoogle|adverts?|advertisements?|sponsor(?:ed)?|promos?|banner|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|signup|"
    r"navbar|navigation|breadcrumbs?|sidebar|masthead|toolbar|pagination|pager|comments?|comment-list|disqus|respond|replies|skip-link)(?=$|[\s_-])", re.I)
#: Names that may also belong to the text: what such an element holds decides.
_MAYBE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|menu|footer|notices?|alert|share|sharing|social|related|recommended|login|search|widget|teasers?|cards?|preview)(?=$|[\s_-])", re.I)
_DROPPED_ROLES = re.compile(r"^(?:navigation|banner|contentinfo|complementary|search|form|menu|menubar|dialog|alert|alertdialog)$", re.I)
#: A quote opens a value only after "="; `<!-->` and `<!--->` are whole comments.
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|$))|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|=|[^\s/>=]+(?:\s*=\s*(?:\"[^\"]*(?:\"|$)|'[^']*(?:'|$)|[^\s>]*))?)*+)(>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>]*)))?")
#: An element with such a name is text if it has so many words and at most so large a share of them in links.
TEXT_WORDS, LINK_SHARE = 8, 0.34

_KEPT, _SUSPECT, _GONE = range(3)


def _verdict(name: str, attributes: str, main: bool) -> int:
    """What an element's own name and attributes say: kept, suspect (its content decides), or gone. Roles and the like count on boxes."""
    if name in _DROPPED or name in _LEFT_OUT or name == "header" and not main:
        return _GONE
    out = _KEPT
    if attributes and name not in ("html", "body"):
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), a or b or c
            if key in ("class", "id"):
                if _SURE_NAMES.search(value):
                    return _GONE
                if _MAYBE_NAMES.search(value):
                    out = _SUSPECT
            elif name in _BOXES and (key == "role" and _DROPPED_ROLES.match(value) or key == "hidden" or key == "aria-hidden" and value.lower() == "true"):
                return _GONE
    return out


class _Reading:
    """Blocks of a page with the suspect elements that they stand in."""

    def __init__(self) -> None:
        self.out: list[tuple[str, bool, tuple[int, ...], int]] = []
        self.parts: list[tuple[str, bool]] = []
        self.main, self.suspects = False, ()

    def add(self, text: str, main: bool, suspects: tuple[int, ...], link: bool) -> None:
        if (main, suspects) != (self.main, self.suspects):
            self.flush()
            self.main, self.suspects = main, suspects
        self.parts.append((text, link))

    def flush(self) -> None:
        if self.parts:
            text = "".join(x for x, _ in self.parts)
            if "&" in text:
                text = entities.unescape(text)
            text = " ".join(text.split())
            if text:
                self.out.append((text, self.main, self.suspects, sum(len(x.split()) for x, link in self.parts if link)))
            self.parts.clear()

    def decided(self, main: set[int]) -> list[tuple[str, bool]]:
        """The blocks that the markup does not drop. Suspects (in `main` those that are main elements themselves) are judged by their words and links;
        a suspect main element stays if it is all there is."""
        words: dict[int, int] = {}
        links: dict[int, int] = {}
        for text, _, suspects, link in self.out:
            for x in suspects:
                words[x] = words.get(x, 0) + len(text.split())
                links[x] = links.get(x, 0) + link
        plain = any(inside and not set(suspects) & main for _, inside, suspects, _ in self.out)
        gone = {x for x, n in words.items() if (plain if x in main else n < TEXT_WORDS or links[x] > LINK_SHARE * n)}
        return [(text, inside) for text, inside, suspects, _ in self.out if not gone.intersection(suspects)]


def blocks(html: str) -> list[tuple[str, bool]]:
    """(text, inside a main element) of the blocks that the markup keeps, in page order: with a main element only those inside."""
    found, any_main = all_blocks(html)
    return [x for x in found if x[1]] if any_main else found


def all_blocks(html: str) -> tuple[list[tuple[str, bool]], bool]:
    """(text, inside a main element) of the blocks that no element drops, in page order, and whether a main element decides the page."""
    reading = _Reading()
    # Open elements that matter: (element, what held before it: dropped, main, suspects).
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = []
    dropped = main = any_main = False
    suspects: tuple[int, ...] = ()
    of_main: set[int] = set()
    link, at, end = 0, 0, len(html)
    last_close: dict[str, int] = {}

    def closes(name: str, after: int) -> bool:
        """Is there an end tag of this name later on? Each name is looked for once."""
        if name not in last_close:
            last_close[name] = max((x.start() for x in re.finditer(rf"</{re.escape(name)}(?=[\s/>])", html, re.I)), default=-1)
        return last_close[name] >= after

    def close(names: set[str] | str, within: set[str] = frozenset()) -> None:
        """End the innermost open element of that name, with all inside it; `within` bounds the search."""
        nonlocal dropped, main, suspects
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == names or stack[k][0] in names:
                _, dropped, main, suspects = stack[k]
                del stack[k:]
                return
            if stack[k][0] in within:
                return

    while at < end:
        found = _TAG.search(html, at)
        stop = found.start() if found else end
        if stop > at and not dropped:
            reading.add(html[at:stop], main, suspects, link > 0)
        if not found:
            break
        at = found.end()
        name = found[2]
        if not name:
            if html.startswith("<![CDATA[", stop) and not dropped:
                reading.add(" ", main, suspects, False)
            continue
        name, opening = name.lower(), not found[1]
        if name in _RAW and opening:
            ended = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)", re.I).search(html, at)
            at = ended.end() if ended else end
            if reading.parts:
                reading.add(" ", reading.main, reading.suspects, False)
            continue
        if name in _BREAKS:
            reading.flush()
            # End tags that may be left out: of p before any block, of items and headings before their like.
            if opening:
                close("p", _BOXES)
                if name == "li":
                    close("li", {"ul", "ol", "menu"})
                elif name in ("dt", "dd"):
                    close({"dt", "dd"}, {"dl"})
                elif name in _HEADINGS:
                    close(_HEADINGS, _BOXES)
        elif name == "br" and reading.parts:
            reading.add(" ", reading.main, reading.suspects, False)
        if name == "a":
            link = 1 if opening else 0
        if not opening:
            close(name)
            continue
        if name in _VOID or found[3].endswith("/") and name in _BOXES | _LEFT_OUT:
            continue
        verdict = _verdict(name, found[3], main)
        if name in _LEFT_OUT and not closes(name, at):
            continue  # never ended: it would take the rest of the page
        if name not in _BOXES and name not in _LEFT_OUT:
            # Other elements matter only if they go, and if something ends them.
            if verdict == _KEPT or not (name in _BREAKS or closes(name, at)):
                continue
        stack.append((name, dropped, main, suspects))
        if verdict == _SUSPECT and not dropped:
            number = at
            suspects = (*suspects, number)
            if name in _MAIN:
                of_main.add(number)
        dropped = dropped or verdict == _GONE
        main = main or name in _MAIN
        any_main = any_main or main and not dropped
    reading.flush()
    return reading.decided(of_main), any_main


def _page(html: str | None) -> tuple[bool, str, bytes, int]:
    """Of a page: does a main element decide it, for each block whether it is inside (1) or not (0), the blocks joined by line ends, and the token stream.

    A token stream is known by the hash of the page's tokens: blocks are cut by line ends, which are no tokens.
    """
    found, decided = all_blocks(html) if html else ([], False)
    lines = "\n".join(text for text, _ in found).encode()
    stream = hashlib.blake2b(lines.replace(b"\n", b" "), digest_size=8).digest()
    return decided, "".join("01"[inside] for _, inside in found), lines, int.from_bytes(stream, "little", signed=True)


def _streams(pages: DataFrame) -> DataFrame:
    """(stream, bytes): the size of all pages with a token stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [_page(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[3] for x in read], pa.int64()), pa.array([len(x[2]) + PAGE_BYTES for x in read], pa.int64())], names=["stream", "bytes"])

    return pages.select("html").mapInArrow(run, "stream long, bytes long").groupBy("stream").agg(F.sum("bytes").alias("bytes"))


def _read(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, page, decided, inside, stream, size, lines) of `_page`: lines are compressed, size is theirs before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            read = [_page(x) for x in batch.column("html").to_pylist()]
            decided, inside, lines, stream = (list(x) for x in zip(*read, strict=True)) if read else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names), pa.array(decided, pa.bool_()), pa.array(inside, pa.string()), pa.array(stream, pa.int64()),
                pa.array([len(x) for x in lines], pa.int64()), pa.array([codec.compress(x, asbytes=True) for x in lines], pa.binary())], names=schema.names)

    names = ["page_id", "url", "host", "page"]
    host, _ = host_and_path("url")
    # A page is its id, or, for a null, the row's own content.
    page = F.when(F.col("page_id").isNull(), F.xxhash64("url", "html")).otherwise(F.xxhash64("page_id"))
    rows = pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), page.alias("page"), "html")
    schema = T.StructType([pages.schema["page_id"], *(T.StructField(c, T.StringType()) for c in ("url", "host")), *(T.StructField(c, t) for c, t in (
        ("page", T.LongType()), ("decided", T.BooleanType()), ("inside", T.StringType()), ("stream", T.LongType()), ("size", T.LongType()), ("lines", T.BinaryType())))])
    return rows.mapInArrow(run, schema)


def _lines(table: pa.Table) -> pa.ChunkedArray | pa.Array:
    """The blocks of each page, joined by line ends."""
    column = table.column("lines")
    if not pa.types.is_binary(column.type):
        return column
    codec = pa.Codec("zstd")
    return pa.array([codec.decompress(x, n, asbytes=True) for x, n in zip(column.to_pylist(), table.column("size").to_pylist(), strict=True)], pa.large_binary()).cast(pa.large_string())


def _suffixes(table: pa.Table, least: int, buckets: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, first token, key and text of each window): the key is the bucket and a hash of the host and the tokens."""
    (_, _, data, offsets), = slices(_lines(table), limit=1 << 62)
    tokens = words(data, offsets, BLANKS)
    start, hashes = tokens.windows(tokens.hashes(), least)
    text = tokens.text_of(start)
    host = np.array([hash_host(x) for x in table.column("host").to_pylist()], np.uint64)
    hashes = mix(hashes + host[text])
    n = np.uint64(buckets)
    key = (hashes % n) * STARTS + (hashes // n) % STARTS
    return tokens, start, key, text


def hash_host(host: str) -> int:
    raw = np.frombuffer(host.encode(), np.uint8)
    return int(words(raw, np.array([0, len(raw)]), BLANKS).hashes().sum()) & (2**64 - 1) if len(raw) else 0


def _ends(ranked: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the length."""
    return np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(ranked) else np.zeros(1, np.int64)


def _span(keys: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest and largest tag."""
    order = np.argsort(keys, kind="stable")
    ranked, tags = keys[order], tags[order]
    first = _ends(ranked)[:-1]
    if not len(first):
        return ranked, tags, tags
    return ranked[first], np.minimum.reduceat(tags, first), np.maximum.reduceat(tags, first)


def _send(least: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys = np.unique(_suffixes(table, least, buckets)[2])
        bucket = keys // STARTS
        edge = _ends(bucket)
        rows = [(int(bucket[a]), pack_bits(keys[a:b])) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.table({
            "slice": pa.array([key[0].as_py()] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int64()),
            "suffixes": pa.array([r[1] for r in rows], pa.binary())})

    return run


def _neighbours(table: pa.Table) -> pa.Table:
    """For each slice of one bucket: its keys that another slice has too, packed."""
    parts = [unpack_bits(x.as_py()) for x in table.column("suffixes")]
    ranked = np.sort(np.concatenate(parts))
    several = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    mine = [pack_bits(np.intersect1d(x, several, assume_unique=True)) for x in parts]
    return pa.table({"slice": table.column("slice"), "suffixes": pa.array(mine, pa.binary())})


def _window_tokens(tokens: Words, start: np.ndarray, least: int) -> list[str]:
    """The tokens of the windows at `start`, joined by one space. Tokens of a page stand one byte apart."""
    raw = tokens.data.tobytes().replace(b"\n", b" ")
    return [raw[a:b].decode() for a, b in zip(tokens.start[start].tolist(), tokens.end[start + least - 1].tolist(), strict=True)]


def _candidates(least: int, buckets: int, decided: str | None = None):
    """The windows of the keys that came back, by their tokens, with the ranges of the pages and the streams they stand in.

    Only a slice that has the window in a page which `decided` does not mark can cut it: others give theirs without their number.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, start, keys, text = _suffixes(table, least, buckets)
        known, low, high = _span(keys, table.column("stream").to_numpy()[text])
        hit = np.isin(keys, np.concatenate([known[low != high], *(unpack_bits(x.as_py()) for x in answers.column("suffixes"))]))
        start, text = start[hit], text[hit]
        hosts = table.column("host").to_pylist()
        which: dict[tuple[str, str], int] = {}
        number = np.array([which.setdefault((hosts[t], w), len(which)) for t, w in zip(text.tolist(), _window_tokens(tokens, start, least), strict=True)], np.int64)
        marked = table.column(decided).to_numpy().astype(np.int64) if decided else np.zeros(len(table), np.int64)
        _, spared, _ = _span(number, marked[text])
        _, low_page, high_page = _span(number, table.column("page").to_numpy()[text])
        _, low_stream, high_stream = _span(number, table.column("stream").to_numpy()[text])
        return pa.table({
            "slice": pa.array([key[0].as_py()] * len(which), pa.int64(), mask=spared == 1), "host": pa.array([h for h, _ in which], pa.string()), "window": pa.array([w for _, w in which], pa.string()),
            "low_page": low_page, "high_page": high_page, "low_stream": low_stream, "high_stream": high_stream})

    return run


def _common(a: list[str], b: list[str]) -> int:
    """The length of the common start of two suffixes, in tokens."""
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


def _compared(least: int):
    """Neighbours of the sorted suffixes: of each stretch with a common start of `least` tokens in two pages and two streams, the start and
    the slices it stands in, as far as they can cut it. A stretch has a row for each slice at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, tokens, stretch = None, [], None
        shared: list[tuple[int, str, str]] = []

        def end() -> None:
            if stretch is not None and stretch["low_page"] != stretch["high_page"] and stretch["low_stream"] != stretch["high_stream"]:
                shared.extend((x, before, " ".join(tokens[:least])) for x in sorted(stretch["slices"]))

        for batch in batches:
            for row in batch.to_pylist():
                mine = row["window"].split(" ")
                if stretch is not None and row["host"] == before and _common(tokens, mine) >= least:
                    for c in ("page", "stream"):
                        stretch[f"low_{c}"], stretch[f"high_{c}"] = min(stretch[f"low_{c}"], row[f"low_{c}"]), max(stretch[f"high_{c}"], row[f"high_{c}"])
                    stretch["slices"] |= {row["slice"]} - {None}
                else:
                    end()
                    stretch = row | {"slices": {row["slice"]} - {None}}
                before, tokens = row["host"], mine
            yield from sent(shared)
        end()
        yield from sent(shared)

    def sent(shared: list[tuple[int, str, str]]) -> Iterator[pa.RecordBatch]:
        if shared:
            columns = list(zip(*shared, strict=True))
            shared.clear()
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)], names=["slice", "host", "window"])

    return run


def _unique_runs(least: int, most: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        # What a main element holds stays whole, whatever the array has of it.
        main = table.filter(table.column("decided"))
        lines = [raw.split("\n") if raw else [] for raw in _lines(main).to_pylist()]
        inside = ["\n".join(x for x, y in zip(parts, marks, strict=True) if y == "1") for parts, marks in zip(lines, main.column("inside").to_pylist(), strict=True)]
        whole = pa.table({"page_id": main.column("page_id"), "url": main.column("url"), "text": pa.array(inside, pa.string())})
        table = table.filter(pc.invert(table.column("decided")))
        if not len(table):
            return whole
        tokens, start, _, text = _suffixes(table, least, 1)
        hosts, known = table.column("host").to_pylist(), set(zip(answers.column("host").to_pylist(), answers.column("window").to_pylist(), strict=True))
        hit = np.array([(hosts[t], w) in known for t, w in zip(text.tolist(), _window_tokens(tokens, start, least), strict=True)], bool)
        covered = tokens.covered(start[hit], least)
        texts = []
        for i, raw in enumerate(_lines(table).to_pylist()):
            at, kept = int(tokens.first[i]), []
            for line in raw.split("\n") if raw else []:
                parts = line.split(" ")
                gone = covered[at : at + len(parts)]
                at += len(parts)
                if gone.any():
                    left = [x for x, y in zip(parts, gone.tolist(), strict=True) if not y]
                    if gone.sum() > most * len(parts) and all(x.isdecimal() for x in left):
                        left = []
                    line = " ".join(left)
                if line:
                    kept.append(line)
            texts.append("\n".join(kept))
        return pa.concat_tables([whole, pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(texts, pa.string())})])

    return run


def extracted(pages: DataFrame, least: int = LEAST, most: float = 0.5, slice_bytes: int = SLICE, per_bucket: int = BUCKET) -> DataFrame:
    """One row per page row: page_id, url, text, n_chars (code points)."""
    streams = stored(_streams(pages), "streams")
    total = streams.agg(F.sum("bytes")).first()[0] or 0
    n_slices, buckets = max(1, total // slice_bytes), max(1, total // (6 * per_bucket))
    # Hot streams are at most as many as there are slices.
    hot = streams.where(F.col("bytes") > slice_bytes).select(F.col("stream").alias("_hot"), F.ceil(F.col("bytes") / slice_bytes).alias("_parts"))
    read = _read(pages).withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(hot), F.col("stream") == F.col("_hot"), "left")
    dealt = F.pmod(F.xxhash64("stream", F.pmod("_row", F.coalesce("_parts", F.lit(1)))), F.lit(n_slices)).alias("slice")
    every = read.select(dealt, "page_id", "url", "host", "page", "decided", "inside", "stream", "size", "lines").repartition("slice")
    sent = every.groupBy("slice").applyInArrow(_send(least, buckets), "slice long, bucket long, suffixes binary")
    answers = sent.groupBy("bucket").applyInArrow(_neighbours, "slice long, suffixes binary")
    ranges = ["low_page", "high_page", "low_stream", "high_stream"]
    found = every.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _candidates(least, buckets, "decided"), f"slice long, host string, window string, {', '.join(f'{c} long' for c in ranges)}")
    # The suffix array: equal suffixes are in one range, so neighbours with a common start are in one task.
    array = found.repartitionByRange("host", "window").sortWithinPartitions("host", "window")
    shared = array.mapInArrow(_compared(least), "slice long, host string, window string")
    schema = T.StructType([pages.schema["page_id"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
    out = every.groupBy("slice").cogroup(shared.groupBy("slice")).applyInArrow(_unique_runs(least, most), schema)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
