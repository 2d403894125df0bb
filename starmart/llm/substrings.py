"""Substring dedup by fixed-block anchors: word sequences that an earlier document already has are removed.

Every document's words are cut into non-overlapping blocks of half a window; these are the index. A window of `size`
words always contains one whole block of each document it stands in, so every repeat of a window or more is
found by probing the index with every rolling window of a block's length. Hits are extended to the windows around
them, whose full hashes decide, so that runs of windows give the maximal exact repeats.

How the work is dealt: documents lie in slices, by a hash of doc_id. A slice sends each hash bucket one row with the sorted hashes of
all its rolling windows and of its blocks, packed as differences; the bucket answers with one bit per distinct hash,
set where the hash is a block's and occurs in two documents or more. Only the windows around set bits go on, packed
likewise with the slice's smallest document; the second answer is one bit, set where another slice has a smaller
one. So no row is made per window or per pair, a sequence that many documents share costs each slice a
few bytes, and texts move twice: once to their slice, and once more for documents with a hit. The numbers of slices and buckets follow
from the bytes of text.

Hashes only choose among windows; the last decision is made by 64 bits within blocks that already agree by 34 to 64 bits more.

Defined results: a null or empty text has no words; documents with a null doc_id are left whole and count nowhere as the
earlier one; rows with equal doc_id never remove each other's words; repeats inside one document stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.storage import stored
from starmart.llm.words import BLANKS, Words, pack, slices, unpack, words

SLICE = 4_000_000
#: Rolling windows per bucket, on average.
BUCKET = 2_000_000
_REST = np.uint64(34)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts `key`, and the first place of each distinct value in it."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    return order, np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(key) else np.zeros(0, np.int64)


def _key(hashes: np.ndarray, buckets: int, bits: np.uint64 = _REST) -> np.ndarray:
    """Bucket in front, then the remaining hash cut to `bits` bits."""
    n = np.uint64(buckets)
    return ((hashes % n) << bits) | ((hashes // n) & ((np.uint64(1) << bits) - np.uint64(1)))


class Slice:
    """The documents of one slice with all their words."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("doc_id").to_numpy()
        column = table.column("text").combine_chunks()
        parts = list(slices(column, limit=1 << 62))
        data, offsets = (parts[0][2], parts[0][3]) if parts else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        self.words: Words = words(data, offsets, BLANKS)
        self.hashes = self.words.hashes()

    def anchors(self, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start word, key and text of every rolling window of a block's length."""
        start, hashes = self.words.windows(self.hashes, block)
        return start, _key(hashes, buckets), self.words.text_of(start)

    def digest(self, text: int, keep: np.ndarray) -> str:
        return hashlib.sha256(self.words.kept(text, keep)).hexdigest()


def _by_bucket(key: np.ndarray, bits: np.uint64 = _REST):
    """(bucket, slice of the sorted `key`) of each bucket."""
    bucket = key >> bits
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(key) else np.zeros(0, np.int64)
    return [(int(bucket[a]), slice(int(a), int(b))) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _probe(block: int, buckets: int):
    """A slice's packed probes and blocks for each bucket."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        docs = Slice(table)
        start, keys, text = docs.anchors(block, buckets)
        order, first = _groups(keys)
        ranked, owner = keys[order], docs.ids[text[order]]
        distinct = ranked[first]
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first) if len(first) else np.zeros(0, bool)
        twice = np.repeat(distinct, 1 + several)
        index = np.unique(keys[(start - docs.words.first[text]) % block == 0])
        blocks = {b: index[part] for b, part in _by_bucket(index)}
        rest = (np.uint64(1) << _REST) - np.uint64(1)
        rows = [(b, pack(twice[part] & rest), pack(blocks.get(b, index[:0]) & rest)) for b, part in _by_bucket(twice)]
        return pa.table({
            "slice": pa.array([key[0].as_py()] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int64()),
            "probes": pa.array([r[1] for r in rows], pa.binary()), "blocks": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _hits(table: pa.Table) -> pa.Table:
    """For each slice of one bucket, a bit per distinct probe: it is a block and occurs in two documents or more."""
    blocks = [unpack(x.as_py()) for x in table.column("blocks")]
    index = np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, np.uint64)
    count = np.zeros(len(index) + 1, np.int64)
    kept = []
    for x in table.column("probes"):
        probes = unpack(x.as_py())
        first = np.concatenate([[True], probes[1:] != probes[:-1]])
        at = np.searchsorted(index, probes)
        known = index[np.minimum(at, len(index) - 1)] == probes if len(index) else np.zeros(len(probes), bool)
        count += np.bincount(at[known], minlength=len(count))
        at[~known] = -1
        kept.append(at[first].astype(np.int32))
    out = []
    for row, at in enumerate(kept):
        bit = (at >= 0) & (count[at] > 1)
        if bit.any():
            out.append((row, np.packbits(bit).tobytes()))
    picked = table.take(pa.array([row for row, _ in out], pa.int64()))
    return pa.table({"slice": picked.column("slice"), "bucket": picked.column("bucket"), "bits": pa.array([bits for _, bits in out], pa.binary())})


def _extend(size: int, block: int, buckets: int, wide: int):
    """Final rows of documents without a hit; of the others the text and candidate ranges; and the slice's packed candidate windows."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        docs = Slice(table)
        found, n = docs.words, len(docs.ids)
        start, keys, _ = docs.anchors(block, buckets)
        distinct = np.unique(keys)
        said = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True))
        hit = [distinct[part][np.unpackbits(np.frombuffer(said[b], np.uint8), count=part.stop - part.start).astype(bool)] for b, part in _by_bucket(distinct) if b in said]
        hit_keys = np.concatenate(hit) if hit else distinct[:0]
        total = np.zeros(len(found) + 1, np.int64)
        if len(hit_keys):
            near = hit_keys[np.minimum(np.searchsorted(hit_keys, keys), len(hit_keys) - 1)] == keys
            total[start[near] + 1] = 1
        np.cumsum(total, out=total)
        windows, _ = found.windows(docs.hashes, size)
        candidate = windows[total[np.minimum(windows + (size - block + 1), len(found))] > total[windows]]
        text = found.text_of(candidate)
        ranges = [b""] * n
        for i in np.unique(text).tolist():
            ranges[i] = _ranges(candidate[slice(*np.searchsorted(text, [i, i + 1]))] - found.first[i])
        keep = np.ones(len(found), bool)
        texts = table.column("text").to_pylist()
        rows = [
            (int(docs.ids[i]), int(found.counts[i]), texts[i] if ranges[i] else None, ranges[i] or None, None if ranges[i] else docs.digest(i, keep), None, None)
            for i in range(n)]
        for b, hashes, owners in _candidates(docs, candidate, size, wide):
            rows.append((None, None, None, None, None, b, _with_owners(hashes, owners)))
        names = ["doc_id", "n_words", "text", "ranges", "kept_sha256", "bucket", "windows"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        at = key[0].as_py()
        return pa.table({"slice": pa.array([at] * len(rows), pa.int64())} | {x: pa.array(c, k) for x, c, k in zip(names, columns, kinds, strict=True)})

    return run


def _ranges(starts: np.ndarray) -> bytes:
    """Sorted window starts as (first, end) pairs of runs."""
    edge = np.flatnonzero(np.diff(starts) != 1) + 1
    return np.stack([starts[np.concatenate([[0], edge])], starts[np.concatenate([edge - 1, [len(starts) - 1]])] + 1], 1).astype("<i8").tobytes()


def _candidates(docs: Slice, candidate: np.ndarray, size: int, wide: int):
    """(bucket, distinct hashes, smallest document of each) of candidate windows, hashes sorted."""
    hashes = docs.words.window_at(docs.hashes, candidate, size)
    owner = docs.ids[docs.words.text_of(candidate)]
    order = np.lexsort((hashes, hashes % np.uint64(wide)))
    ranked = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(order) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(owner[order], first) if len(first) else owner[:0]
    distinct = ranked[first]
    bucket = distinct % np.uint64(wide)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(distinct) else np.zeros(0, np.int64)
    return [(int(bucket[a]), distinct[a:b], least[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _with_owners(hashes: np.ndarray, owners: np.ndarray) -> bytes:
    """Packed hashes, then each one's document as a place in the blob's own list of documents."""
    table, place = np.unique(owners, return_inverse=True)
    narrow = place.astype("<u2" if len(table) < 65536 else "<u4").tobytes()
    packed = pack(hashes)
    return len(packed).to_bytes(8, "little") + len(table).to_bytes(8, "little") + packed + table.astype("<i8").tobytes() + narrow


def _read_owners(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    hashes = unpack(raw[16 : 16 + n])
    table = np.frombuffer(raw, "<i8", count=m, offset=16 + n)
    return hashes, table[np.frombuffer(raw, "<u2" if m < 65536 else "<u4", offset=16 + n + 8 * m)]


def _earlier(table: pa.Table) -> pa.Table:
    """For each slice of one bucket, a bit per distinct window: another slice has it in a smaller document."""
    parts = [_read_owners(x.as_py()) for x in table.column("windows")]
    hashes, owners = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order, first = _groups(hashes)
    least = np.minimum.reduceat(owners[order], first)
    everywhere = np.empty(len(hashes), np.int64)
    everywhere[order] = np.repeat(least, np.diff(np.append(first, len(hashes))))
    bit, at, out = everywhere < owners, 0, []
    for p in parts:
        out.append(np.packbits(bit[at : at + len(p[0])]).tobytes())
        at += len(p[0])
    return pa.table({"slice": table.column("slice"), "bucket": table.column("bucket"), "bits": pa.array(out, pa.binary())})


def _remove(size: int, wide: int):
    """Rows of documents with candidate windows."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        docs = Slice(table)
        found = docs.words
        starts = [np.zeros(0, np.int64)]
        for i, raw in enumerate(table.column("ranges").to_pylist()):
            starts += [np.arange(a, b) + found.first[i] for a, b in np.frombuffer(raw, "<i8").reshape(-1, 2).tolist()]
        candidate = np.concatenate(starts)
        said = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True))
        hashes = found.window_at(docs.hashes, candidate, size)
        owner = docs.ids[found.text_of(candidate)]
        gone = np.zeros(len(candidate), bool)
        bucket = hashes % np.uint64(wide)
        for b, distinct, least in _candidates(docs, candidate, size, wide):
            mine = np.flatnonzero(bucket == np.uint64(b))
            at = np.searchsorted(distinct, hashes[mine])
            bits = np.unpackbits(np.frombuffer(said[b], np.uint8), count=len(distinct)).astype(bool)
            gone[mine] = bits[at] | (least[at] < owner[mine])
        keep = ~found.covered(candidate[gone], size)
        total = np.concatenate([[0], np.cumsum(~keep)])
        removed = total[found.first[1:]] - total[found.first[:-1]]
        return pa.table({
            "doc_id": table.column("doc_id"), "n_words": table.column("n_words"), "n_removed": pa.array(removed.astype(np.int64)),
            "kept_sha256": pa.array([docs.digest(i, keep) for i in range(len(docs.ids))], pa.string())})

    return run


def removed(docs: DataFrame, size: int = 50, slice_bytes: int = SLICE, per_bucket: int = BUCKET) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space)."""
    block = size // 2
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices, buckets = max(1, total // slice_bytes), max(1, total // (6 * per_bucket))
    wide = max(1, buckets // 4)
    # Repeated ids stay together, so that a slice sees them as one document.
    sliced = rows.where("doc_id is not null").select(F.expr(f"pmod(xxhash64(doc_id), {n_slices})").alias("slice"), "doc_id", "text").repartition("slice")
    probes = sliced.groupBy("slice").applyInArrow(_probe(block, buckets), "slice long, bucket long, probes binary, blocks binary")
    answers = probes.groupBy("bucket").applyInArrow(_hits, "slice long, bucket long, bits binary")
    schema = "slice long, doc_id long, n_words long, text string, ranges binary, kept_sha256 string, bucket long, windows binary"
    extended = stored(sliced.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_extend(size, block, buckets, wide), schema), "substrings")
    earlier = extended.where("windows is not null").select("slice", "bucket", "windows").groupBy("bucket").applyInArrow(_earlier, "slice long, bucket long, bits binary")
    open_docs = extended.where("ranges is not null").select("slice", "doc_id", "n_words", "text", "ranges")
    changed = open_docs.groupBy("slice").cogroup(earlier.groupBy("slice")).applyInArrow(_remove(size, wide), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    whole = extended.where("kept_sha256 is not null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return changed.unionByName(whole).unionByName(_unnamed(rows))


def _unnamed(rows: DataFrame) -> DataFrame:
    """Documents without an id, left whole."""
    kept = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return rows.where("doc_id is null").select(
        "doc_id", F.size(kept).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.sha2(F.array_join(kept, " "), 256).alias("kept_sha256"))
