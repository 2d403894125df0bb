"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned by every training token window.

Normalising lower-cases A-Z and takes words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. A window is `size` consecutive words
of an item; an item with fewer words, but not none, is one window. Every window of a document is probed: first in a
bitmap, then in the sorted hashes, and each hit is verified by its words. The words in hits are hit words.

The hash set is broadcast only up to `max_set_bytes`, measured on the driver while it is built from a stream of
items. A larger benchmark is taken in blocks of that size: each block's scan adds its hits to those of the scans
before it, in the same pass over the documents and without a shuffle, so any size gives the same result.

Defined results: a null or empty text has no words and no hits; null or empty items never hit; items with equal
windows are all reported; repeated document rows are judged one by one; a null item_id takes part as a hit, but has no name to list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.words import NON_ALNUM, slices, words

#: Bytes that one broadcast block of test n-grams may take.
MAX_SET_BYTES = 32_000_000


class NgramSet:
    """Windows of benchmark items: sorted hashes by window length, their words for verification, and the items that hold them."""

    def __init__(self) -> None:
        self.by_size: dict[int, dict[int, list[tuple[bytes, list]]]] = {}
        self.bytes = 0

    def add(self, item_id: int | None, text: str | None, size: int) -> None:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        found = words(raw, np.array([0, len(raw)]), NON_ALNUM, lower=True)
        if not len(found):
            return
        n = min(size, len(found))
        start, hashes = found.windows(found.hashes(), n)
        table = self.by_size.setdefault(n, {})
        for i, h in zip(start.tolist(), hashes.tolist(), strict=True):
            gram = found.joined(i, i + n)
            entries = table.setdefault(h, [])
            items = next((items for known, items in entries if known == gram), None)
            if items is None:
                entries.append((gram, items := []))
                self.bytes += len(gram) + 300
            if item_id not in items:
                items.append(item_id)
                self.bytes += 16

    def frozen(self) -> NgramSet:
        self.sorted = {n: np.sort(np.fromiter(table, np.uint64, len(table))) for n, table in self.by_size.items()}
        self.bits = {}
        for n, hashes in self.sorted.items():
            width = max(16, int(len(hashes)).bit_length() + 5)
            bitmap = np.zeros(1 << width, bool)
            bitmap[hashes >> np.uint64(64 - width)] = True
            self.bits[n] = np.uint64(64 - width), bitmap
        return self

    def scan(self, found, hashes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, list]]]:
        """Hit words, and (start word, items) of each verified window."""
        hit, where = np.zeros(len(found), bool), []
        for n, known in self.sorted.items():
            start, window = found.windows(hashes, n)
            shift, bitmap = self.bits[n]
            near = np.flatnonzero(bitmap[window >> shift])
            near = near[known[np.minimum(np.searchsorted(known, window[near]), len(known) - 1)] == window[near]]
            for i, h in zip(start[near].tolist(), window[near].tolist(), strict=True):
                gram = found.joined(i, i + n)
                items = next((items for text, items in self.by_size[n][h] if text == gram), None)
                if items is not None:
                    hit[i : i + n] = True
                    where.append((i, items))
        return hit, where


def _blocks(benchmark: DataFrame, size: int, max_set_bytes: int) -> Iterator[NgramSet]:
    """The benchmark as sets of bounded size; items are streamed, one partition at a time. At least one set, maybe empty."""
    block = NgramSet()
    for item_id, text in benchmark.select("item_id", "text").toLocalIterator():
        block.add(item_id, text, size)
        if block.bytes >= max_set_bytes:
            yield block.frozen()
            block = NgramSet()
    yield block.frozen()


def scanned(docs: DataFrame, benchmark: DataFrame, carry: list[str], size: int = 10, max_set_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """One row per document row: row (a struct of the `carry` columns), n_words, n_hit, hits (ranges of hit words), items
    (ids of the items that occur, sorted as strings)."""
    row = F.struct(*[docs[c] for c in carry]).alias("row")
    empty = [F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<array<bigint>>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items")]
    out = docs.select(row, docs["text"], *empty)
    blocks = _blocks(benchmark, size, max_set_bytes)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        schema = T.StructType([f for f in out.schema if following is not None or f.name != "text"])
        out = out.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(block), schema.names), schema)
        block = following
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return out.select("row", "n_words", n_hit.alias("n_hit"), "hits", "items")


def _scan(held, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                found = words(data, offsets, NON_ALNUM, lower=True)
                hit, where = known.scan(found, found.hashes())
                hits, items = part.column("hits").to_pylist(), part.column("items").to_pylist()
                texts = found.text_of(np.array([i for i, _ in where], np.int64))
                for text in np.unique(texts).tolist():
                    hits[text] = _ranges(hit[found.first[text] : found.first[text + 1]], hits[text])
                for text, (_, ids) in zip(texts.tolist(), where, strict=True):
                    items[text] = sorted({*items[text], *(str(x) for x in ids if x is not None)})
                made = {
                    "row": part.column("row"), "text": part.column("text"), "n_words": pa.array(found.counts.astype(np.int64)),
                    "hits": pa.array(hits, pa.list_(pa.list_(pa.int64()))), "items": pa.array(items, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays([made[x] for x in names], names=names)

    return run


def _ranges(hit: np.ndarray, more: list[list[int]]) -> list[list[int]]:
    """Maximal ranges of marked words, with those of `more` marked too."""
    for i, j in more:
        hit[i:j] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    return edge.reshape(-1, 2).tolist()


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, max_set_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """The rows of `docs`, all columns as they are, without the documents that hold a window of the benchmark."""
    return scanned(docs, benchmark, docs.columns, size, max_set_bytes).where("n_hit = 0").select("row.*")


def without_spans(text: str | None, hits: list[list[int]]) -> str | None:
    """`text` without the words in `hits` (ranges of word numbers) and without what separates the words of one range."""
    if not text or not hits:
        return text
    raw = np.frombuffer(text.encode(), np.uint8)
    found = words(raw, np.array([0, len(raw)]), NON_ALNUM, lower=True)
    out, at, data = [], 0, raw.tobytes()
    for i, j in hits:
        out.append(data[at : found.start[i]])
        at = int(found.end[j - 1])
    return (b"".join(out) + data[at:]).decode()


def spans_removed(docs: DataFrame, benchmark: DataFrame, size: int = 10, max_set_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """The rows of `docs` with the hit words cut out of `text`; all other columns stay as they are."""
    names = docs.columns
    whole = scanned(docs, benchmark, names, size, max_set_bytes).select("row", "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            texts = pa.array([without_spans(t.as_py(), h.as_py()) for t, h in zip(row.field(names.index("text")), batch.column("hits"), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if x == "text" else row.field(k) for k, x in enumerate(names)], names=names)

    return whole.mapInArrow(cut, docs.schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of `scanned` per document row: n_words, n_hit, n_items, items_sha256 (of the comma-joined ids), contaminated."""
    return scanned(docs, benchmark, ["doc_id"]).select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
