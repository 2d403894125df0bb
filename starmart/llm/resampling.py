"""Importance resampling toward a target distribution, with feature counts taken once for each distinct line.

A feature is a run of 1 to `n` consecutive words (`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, A-Z in lower case) joined by one space; it falls
into the bucket crc32(feature) mod `buckets`. Each bucket has a gain from its counts in the documents and in the target; a document's weight is the
floored mean of its features' gains, its score the weight plus noise from a hash of its id, and the highest scores are drawn.

Line ends separate words, so a text's features are those inside its lines and those that reach over a line end. Lines are grouped first:
the buckets of a distinct line are worked out once and written down, packed in two or four bytes each. The corpus counts are those buckets times the line's
occurrences; a document's sum of gains is the sum over its lines of the line's own sum. Features over line ends are
counted from the documents, apart from that, and added to both (for n = 1 there are none, and no pass is made for them).

How the work is dealt: lines are grouped with partial counts on the map side. Documents meet their lines' sums by two 64-bit hashes of the line, in a
join that deals hot lines to several tasks. Counts come back to the driver as one number for each bucket, which `buckets` bounds. The
cut is found in a histogram of scores (scores are whole numbers in a narrow range), and only documents at or over it are sorted, in
ranges whose sizes give the ranks; no task numbers all rows.

Defined results: a null or empty text has no features and weight 0; a document with a null id has a weight, but no score and is
never drawn; repeated rows count and are drawn one by one; ties go to the smaller doc_id; an empty table or target gives an empty
result or gains against nothing. Columns of other names play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.spread import spread_join
from starmart.llm.storage import stored
from starmart.llm.words import NON_ALNUM, Words, slices, words

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32 (reversed polynomial 0xEDB88320)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()
#: Longer words are left to zlib.
_SHORT = 64


def crc_on(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each word's bytes carried on from `state`, byte place by byte place over all words that are so long."""
    state, size = state ^ np.uint32(0xFFFFFFFF), end - start
    order = np.argsort(-np.minimum(size, _SHORT + 1), kind="stable")
    longer = np.searchsorted(-size[order].clip(max=_SHORT + 1), -np.arange(_SHORT + 2), "left")  # how many words exceed each size
    sorted_state, sorted_start = state[order], start[order]
    first = longer[_SHORT]
    for k in range(_SHORT):
        n = longer[k]
        if n == first:
            break
        part = slice(first, n)
        sorted_state[part] = _CRC[(sorted_state[part] ^ data[sorted_start[part] + k]) & np.uint32(255)] ^ (sorted_state[part] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = sorted_state ^ np.uint32(0xFFFFFFFF)
    for i in order[:first].tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(state[i] ^ np.uint32(0xFFFFFFFF)))
    return out


def grams(found: Words, n: int, across: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each run of 1 to `n` words inside one text, and its text; with `across` (a line number for each word) only runs of several lines."""
    text = np.repeat(np.arange(len(found.first) - 1), found.counts)
    state = np.zeros(len(found), np.uint32)
    start = np.arange(len(found))
    space = np.full(1, 0x20, np.uint8)
    out, owner = [], []
    for k in range(n):
        last = start + k
        inside = last < found.first[1:][text[start]] if len(start) else np.zeros(0, bool)
        start, last, state = start[inside], last[inside], state[inside]
        if k:
            state = crc_on(state, space, np.zeros(len(start), np.int64), np.ones(len(start), np.int64))
        state = crc_on(state, found.data, found.start[last], found.end[last])
        pick = slice(None) if across is None else across[start] != across[last]
        out.append(state[pick])
        owner.append(text[start][pick])
    return np.concatenate(out), np.concatenate(owner)


def _by_text(owner: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """`values` in the order of their texts, and where each text's begin."""
    order = np.argsort(owner, kind="stable")
    return values[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])


def line_features(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """The distinct lines of `docs`, written down: two hashes (a, b), occurrences, words, and the packed buckets of their features."""
    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
    distinct = lines.groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("line")):
                found = words(data, offsets, NON_ALNUM, lower=True)
                crc, owner = grams(found, n)
                packed, edges = _by_text(owner, (crc % np.uint32(buckets)).astype(kind), b - a)
                blob = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((edges * packed.itemsize).astype(np.int32)), pa.py_buffer(packed)])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), part.column("times"), pa.array(found.counts.astype(np.int64)), blob],
                                                 names=["a", "b", "times", "words", "features"])

    keyed = distinct.select("line", "times", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), F.col("line")).alias("b"))
    return stored(keyed.mapInArrow(run, "a long, b long, times long, words long, features binary"), "features")


def _summed(counted: DataFrame, buckets: int) -> np.ndarray:
    """(bucket, n) rows as one vector; the driver gets a number for each bucket."""
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def _one_vector(buckets: int, of_batch):
    """A task's bucket counts, given once at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            of_batch(batch, total)
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], names=["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, features: DataFrame, n: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs in `docs`: features of distinct lines times occurrences, and those over line ends."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def lines(batch: pa.RecordBatch, total: np.ndarray) -> None:
        blob, times = batch.column("features"), batch.column("times").to_numpy()
        sizes = pc.binary_length(blob).to_numpy() // np.dtype(kind).itemsize
        found = np.frombuffer(b"".join(blob.to_pylist()), kind)
        np.add.at(total, found, np.repeat(times, sizes))

    def over_ends(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for _, _, data, offsets in slices(batch.column("text")):
            crc, _ = _over_ends(data, offsets, n)
            total += np.bincount(crc % np.uint32(buckets), minlength=buckets)

    schema = "bucket long, n long"
    counted = features.select("times", "features").mapInArrow(_one_vector(buckets, lines), schema)
    if n > 1:
        counted = counted.unionByName(docs.select("text").mapInArrow(_one_vector(buckets, over_ends), schema))
    return _summed(counted, buckets)


def _over_ends(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and text of the features that reach over a line end."""
    found = words(data, offsets, NON_ALNUM, lower=True)
    line = np.cumsum(data == 0x0A)[found.start] if len(found) else np.zeros(0, np.int64)
    return grams(found, n, across=line)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed target share / smoothed corpus share)) of each bucket."""
    s, t, k = corpus.astype(float), target.astype(float), len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def _line_sums(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """a, b, times, words, n (features) and gain (their sum) of each distinct line."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob = batch.column("features")
            edges = np.concatenate([[0], np.cumsum(pc.binary_length(blob).to_numpy() // np.dtype(kind).itemsize)])
            total = np.concatenate([[0], np.cumsum(gain[np.frombuffer(b"".join(blob.to_pylist()), kind)])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), batch.column("times"), batch.column("words"), pa.array(np.diff(edges)), pa.array(np.diff(total[edges]))],
                names=["a", "b", "times", "words", "n", "gain"])

    return features.mapInArrow(run, "a long, b long, times long, words long, n long, gain long")


def _end_sums(docs: DataFrame, gain: np.ndarray, n: int) -> DataFrame:
    """id, of, first, words, n and gain of the features over each document's line ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                crc, owner = _over_ends(data, offsets, n)
                found, edges = _by_text(owner, gain[crc % np.uint32(len(gain))], b - a)
                total = np.concatenate([[0], np.cumsum(found)])
                part = batch.slice(a, b - a)
                zero = pa.array(np.zeros(b - a, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("of"), zero, zero, pa.array(np.diff(edges)), pa.array(np.diff(total[edges]))],
                    names=["id", "of", "copies", "words", "n", "gain"])

    return docs.select("id", "of", "text").mapInArrow(run, "id long, of long, copies long, words long, n long, gain long")


def weighed(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_features, weight."""
    features = line_features(docs, n, buckets)
    gain = gains(bucket_counts(docs, features, n, buckets), bucket_counts(target, line_features(target, n, buckets), n, buckets))
    sums = stored(_line_sums(features, gain), "gains")
    # Rows of one doc_id differ by their text; equal rows add up, and are told apart again by their number.
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("of"), F.coalesce("text", F.lit("")).alias("text"))
    lines = rows.select("id", "of", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    keyed = lines.select("id", "of", (F.col("place") == 0).cast("long").alias("copies"), F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), F.col("line")).alias("b"))
    met = spread_join(keyed, sums, ["a", "b"], "times", "id, of").drop("a", "b")
    if n > 1:
        met = met.unionByName(_end_sums(rows, gain, n))
    total = met.groupBy("id", "of").agg(*[F.sum(c).alias(c) for c in ("copies", "words", "n", "gain")])
    one = total.select("id", "copies", *[F.expr(f"{c} div copies").alias(c) for c in ("words", "n", "gain")])
    mean = F.when(F.col("n") > 0, F.floor(F.col("gain") / F.col("n"))).otherwise(0).cast("long")
    each = one.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select(F.col("id").alias("doc_id"), F.col("words").alias("n_words"), F.col("n").alias("n_features"), mean.alias("weight"))


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds score: the weight plus Gumbel noise in thousandths, from a hash of `seed` and the id; null without an id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weights.withColumn("score", F.col("weight") + noise)


def drawn(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Adds rank, from 1 on, to the highest scores: `percent` of the documents with `min_words` words or more, rounded down."""
    scores = stored(scores, "scores")
    able = F.coalesce((F.col("n_words") >= min_words) & F.col("score").isNotNull(), F.lit(False))
    by_score = scores.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("c"))
    total = by_score.agg(F.sum("c")).first()[0] or 0
    size = percent * total // 100
    # A histogram row for each whole score; scores span some ten thousand values whatever the number of documents.
    upto = by_score.withColumn("upto", F.sum("c").over(Window.orderBy(F.desc("score"))))
    cut = upto.where(F.col("upto") >= size).agg(F.max("score")).first()[0] if size else None
    over = able & (F.col("score") >= cut) if cut is not None else F.lit(False)
    none = scores.where(~over).withColumn("rank", F.lit(None).cast("long"))
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_words"), F.asc("n_features")]
    top = stored(scores.where(over).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "drawn")
    sizes = top.groupBy("part").agg(F.count(F.lit(1)).alias("c"))  # one row for each range
    before = sizes.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("before")
    ranked = top.join(F.broadcast(before), "part").withColumn("rank", place.cast("long")).drop("part", "before")
    return ranked.withColumn("rank", F.when(F.col("rank") <= size, F.col("rank"))).unionByName(none)


def resampled(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document row: doc_id, n_features, weight, score, rank (null where the document was not drawn)."""
    return drawn(scored(weighed(docs, target, n, buckets), seed), percent, min_words).select("doc_id", "n_features", "weight", "score", "rank")
