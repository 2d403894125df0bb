"""Periodic runs of words, found by a sparse dynamic programme over lags.

A run is a stretch of consecutive words with smallest period q and a length of at least max(`least`, 2q) that no neighbour extends.
In the table of words against earlier words a run of period q is a diagonal of lag q: word i matches word i - q for
length - q words in a row. Every word looks up its own earlier occurrences; each one adds to the match length of its lag, a lag that
is not matched any more ends, and its diagonal is a run if it is long enough.

What keeps the table sparse: lags are taken in octaves. A run with a lag from L to 2L - 1 matches L words in a row at least, so in that
octave an earlier occurrence counts only if the L - 1 words before match too (L is `least` / 2 at first, where lags below L
belong as well). Occurrences of one such gram that follow each other by at most L / 2 words form a chain. Both ends of a match in one
chain lie in a shorter period, whose multiple the lag is; and where two chains match, the diagonal passes the first word of
one of them. So a pair of occurrences is met only if it is between chains, and first in one of them: a text of n
words has some n log n pairs, also when it repeats one word a million times. The match length of each diagonal that was met is then grown to both sides by
doubling steps over prefix sums of word hashes. Of runs with the same words the one of smallest period is the run.

How the work is dealt: documents are independent, so nothing is shuffled; a task takes texts in slices of about a megabyte.
Words are compared by 64-bit hashes within one document.

Defined results: a null or empty text has no words and no runs; repeated rows are judged one by one; a null doc_id is a row like any other;
columns of any name pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.words import BLANKS, Words, _powers as powers, mix, slices, words

LEAST = 12
_RUN = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))
_ARROW_RUN = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
#: Pairs of occurrences that are met at a time.
_CHUNK = 2_000_000
_BASE = 0xD1342543DE82EF95


class Stretches:
    """Stretches of words compared by prefix sums of the words' hashes."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        up, self.down = powers(_BASE, n)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=self.total[1:])

    def hashes(self, start: np.ndarray, size: int) -> np.ndarray:
        return (self.total[start + size] - self.total[start]) * self.down[start]

    def reach(self, i: np.ndarray, j: np.ndarray, room: np.ndarray, forward: bool) -> np.ndarray:
        """How many words match from i and j on (or before them), up to `room`."""
        got = np.zeros(len(i), np.int64)
        step = 1 << (int(room.max()).bit_length() - 1) if len(room) and room.max() > 0 else 0
        while step:
            able = np.flatnonzero(got + step <= room)
            a, b = (i[able] + got[able], j[able] + got[able]) if forward else (i[able] - got[able] - step, j[able] - got[able] - step)
            same = able[self.hashes(a, step) == self.hashes(b, step)]
            got[same] += step
            step >>= 1
        return got


def _pairs(keys: np.ndarray, at: np.ndarray, low: int, high: int, chain: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(later, earlier) of `at` with equal `keys` and a lag from `low` to `high`, between chains and first in one of them.

    `keys` is sorted, and `at` rises within equal keys; a chain's occurrences follow each other by at most `chain`."""
    n = len(at)
    new_key = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = new_key | np.concatenate([[True], np.diff(at) > chain])
    number = np.cumsum(first)
    group = np.cumsum(new_key)
    # Occurrences of one key within `high` of each other stand side by side; `span` sorts by key, then place.
    span = group * (int(at.max()) + 1 + high) + at
    ahead = np.flatnonzero(first)
    # Backward from each first occurrence, then forward from it: its partners on both sides.
    for lo, hi, later in ((np.searchsorted(span, span[ahead] - high), np.searchsorted(span, span[ahead] - low, "right"), True),
                          (np.searchsorted(span, span[ahead] + low), np.searchsorted(span, span[ahead] + high, "right"), False)):
        lo, hi = np.minimum(np.maximum(lo, 0), n), np.minimum(hi, n)
        counts = np.maximum(hi - lo, 0)
        edges = np.concatenate([[0], np.cumsum(counts)])
        a = 0
        while a < len(ahead):
            b = max(a + 1, int(np.searchsorted(edges, edges[a] + _CHUNK, "right")) - 1)
            mine = counts[a:b]
            one = np.repeat(ahead[a:b], mine)
            other = np.repeat(lo[a:b] - edges[a:b], mine) + np.arange(edges[a], edges[b])
            keep = number[one] != number[other]
            one, other = at[one[keep]], at[other[keep]]
            yield (one, other) if later else (other, one)
            a = b


def runs_of(found: Words, hashes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (word number within the text), length and period of all runs, by text, start and period."""
    text = np.repeat(np.arange(len(found.first) - 1), found.counts)
    begin, end = found.first[text], found.first[text + 1]
    stretches = Stretches(hashes)
    out = [np.zeros((0, 4), np.int64)]

    def emit(i: np.ndarray, lag: np.ndarray) -> None:
        """Grow the diagonals through word i at `lag`, and keep those that are long enough."""
        if not len(i):
            return
        j = i - lag
        before = stretches.reach(i + 1, j + 1, j + 1 - begin[i], forward=False)
        after = stretches.reach(i + 1, j + 1, end[i] - i - 1, forward=True)
        start, length = j + 1 - before, before + after + lag
        good = length >= np.maximum(least, 2 * lag)
        out.append(np.unique(np.stack([text[i], start - begin[i], length, lag], 1)[good], axis=0))

    octave = smallest = max(2, least // 2)
    # Lags up to half of the first octave are chains of their own there: each is one comparison of neighbours.
    for lag in range(1, octave // 2 + 1):
        match = np.zeros(len(found), bool)
        match[lag:] = (hashes[lag:] == hashes[:-lag]) & (text[lag:] == text[:-lag]) if len(found) > lag else False
        starts = match & ~np.concatenate([[False], match[:-1]])
        emit(np.flatnonzero(starts), np.full(int(starts.sum()), lag))
    alive = np.arange(len(found))
    while len(alive):
        alive = alive[alive - begin[alive] >= octave - 1]
        keys = mix(stretches.hashes(alive - (octave - 1), octave) ^ mix(text[alive].astype(np.uint64)))
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], alive[order]
        same = keys[1:] == keys[:-1]
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(keys) else np.zeros(0, bool)
        keys, at = keys[again], at[again]
        if not len(at):
            break
        for i, j in _pairs(keys, at, octave // 2 + 1 if octave == smallest else octave, 2 * octave - 1, octave // 2):
            met = np.stack(np.divmod(np.unique((i - j) * len(found) + i), len(found)), 1)
            # Of neighbours on one diagonal the first will do.
            alone = np.concatenate([[True], (met[1:, 0] != met[:-1, 0]) | (met[1:, 1] != met[:-1, 1] + 1)]) if len(met) else np.zeros(0, bool)
            emit(met[alone, 1], met[alone, 0])
        # A gram of twice the length recurs only where both of its halves do.
        recurs = np.zeros(len(found) + octave, bool)
        recurs[at] = True
        at = np.sort(at)
        alive = at[recurs[np.maximum(at - octave, 0)] & (at - begin[at] >= octave)]
        octave *= 2
    runs = np.concatenate(out)
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    # Same words, several periods: the smallest one counts.
    distinct = np.concatenate([[True], (runs[1:, :3] != runs[:-1, :3]).any(1)]) if len(runs) else np.zeros(0, bool)
    runs = runs[distinct]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2], runs[:, 3]


def collapsing(docs: DataFrame, carry: list[str], least: int = LEAST) -> DataFrame:
    """One row per document row: row (a struct of the `carry` columns), n_words, runs (start, length and period of each, by start and
    period) and collapsed (the words that stay, joined by one space: of each run its first period, unless another run takes that too)."""
    rows = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs["text"])
    schema = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", _RUN), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                found = words(data, offsets, BLANKS)
                text, start, length, period = runs_of(found, found.hashes(), least)
                keep = ~found.covered(found.first[text] + start + period, length - period)
                edges = np.searchsorted(text, np.arange(b - a + 1))
                told = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array(found.counts.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(edges, pa.int32()), told, type=_ARROW_RUN),
                     pa.array([found.kept(i, keep).decode() for i in range(b - a)], pa.string())],
                    names=["row", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema)


def collapsed(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of `docs` with all but the first period of each run cut out of `text`; texts without runs and all other columns stay as they are."""
    names = docs.columns
    cut = collapsing(docs, names, least)
    return cut.select(*[F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("row.text")).alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names])


def digest(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_runs, the longest run (start, length, period, exponent_milli; ties: smallest start, then period),
    runs_sha256 (of a line `start,length,period` for each run) and collapsed_sha256."""
    told = collapsing(docs, ["doc_id"])
    top = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))[0]
    best = told.withColumn("best", F.when(F.size("runs") > 0, top))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    longest = -F.col("best.length")
    return best.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), longest.alias("length"), F.col("best.period").alias("period"),
        F.floor(longest * 1000 / F.col("best.period")).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted(docs: DataFrame) -> DataFrame:
    """`docs` with a periodic tail in the text of every document whose crc32(doc_id) ends in 0, as the query's contract lays down; null ids stay."""
    names = docs.columns
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select(*names, F.when(h % 10 == 0, F.floor(h / 10)).cast("long").alias("_g"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_tailed(t.as_py(), g) if g is not None else t.as_py() for t, g in zip(batch.column("text"), batch.column("_g").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)

    return rows.mapInArrow(run, docs.schema)


def _tailed(text: str | None, g: int) -> str | None:
    """From word g % n on, the words repeat with a period of about a third to a tenth of what follows."""
    if not text:
        return text
    raw = np.frombuffer(text.encode(), np.uint8)
    found = words(raw, np.array([0, len(raw)]), BLANKS)
    n = len(found)
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    said = found.joined(0, n).split(b" ")
    return b" ".join(said[:a] + (said[a : a + p] * (-(-(n - a) // p)))[: n - a]).decode()
