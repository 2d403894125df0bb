"""N-gram Jaccard join by banded MinHash, the fixed-depth form of an LSH forest, with exact verification of every candidate.

Documents are sets of word shingles (`[^\\x20\\x09-\\x0D]+`, five words, unchanged; a document of fewer words, but not none,
is one shingle). Two documents are linked if the Jaccard similarity of their sets is `threshold` or more. Documents with equal
sets are one node. Every node has a signature per tree. The depth at which a forest would stop shortening its prefixes follows from threshold, recall
and number of trees alone: the longest k, from `depth` down, with 1 - (1 - threshold**k)**trees at `recall` or more. So no trie is
built, and prefixes do not adapt to what they matched: nodes that share the first k values of a tree are a bucket.

Buckets never emit pairs. Each points its members at its smallest node; sketches of the signatures tell how close they are.
Members about as close as 0.4 join the centre's family, those about 0.6 or closer are done with this bucket (whatever they
are linked to is then 0.4 close to the centre, so in the family too), the rest go round again among themselves,
and after `rounds` rounds what is left of a bucket is one family. Families are connected components.
Then the exact step: a family's nodes lie in chunks of bounded size, each two chunks meet in one task, and all their
similarities are counted from the shingles themselves. Only sums per node leave the task, and a forest
of the links for the classes. So a family of any size is split over many tasks, nothing is capped, and copies are never expanded.

Defined results: a null or empty text has no shingles, no links and its own id as class; the class id is the smallest
doc_id of the class; rows with equal doc_id are rows of their own; rows with a null doc_id take part, and their class
has a null id only if all its rows do. Shingles are compared by 48 bits within a pair of documents, sets by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.components import components
from starmart.llm.storage import stored
from starmart.llm.words import BLANKS, mix, pack, slices, unpack, words


@dataclass(frozen=True)
class Forest:
    size: int = 5
    threshold: float = 0.8
    trees: int = 40
    depth: int = 12
    recall: float = 0.99999
    rounds: int = 3
    family: float = 0.27  # estimated similarity from which a member joins: true 0.4 less four deviations
    done: float = 0.73  # and is done: true 0.6 and four deviations
    chunk_nodes: int = 512
    chunk_shingles: int = 256_000

    @property
    def prefix(self) -> int:
        """The longest prefix, from `depth` down, with the target recall."""
        return next((k for k in range(self.depth, 0, -1) if 1 - (1 - self.threshold**k) ** self.trees >= self.recall), 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes."""
    found = words(data, offsets, BLANKS)
    hashes = found.hashes()
    start, whole = found.windows(hashes, size)
    at = np.searchsorted(start, found.first)
    out = []
    for i, n in enumerate(found.counts.tolist()):
        if n >= size:
            out.append(np.unique(whole[at[i] : at[i + 1]]))
        elif n:
            out.append(found.window_at(hashes, found.first[i : i + 1], n))
        else:
            out.append(whole[:0])
    return out


def _node(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each set, with the sign bit clear."""
    sums = np.array([np.add.reduce(mix(x)) if len(x) else 0 for x in sets], np.uint64)
    return (mix(sums + mix(np.array([len(x) for x in sets], np.uint64))) >> np.uint64(1)).astype(np.int64)


def _signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """Minima of n linear permutations of 32 bits, for each non-empty set."""
    rng = np.random.default_rng(20240517)
    factor, shift = rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)
    full = [x for x in sets if len(x)]
    out = np.zeros((len(full), n), np.uint32)
    if full:
        flat = (np.concatenate(full) >> np.uint64(32)).astype(np.uint32)
        first = np.concatenate([[0], np.cumsum([len(x) for x in full])])[:-1]
        for j in range(n):
            out[:, j] = np.minimum.reduceat(flat * factor[j] + shift[j], first)
    return out


def row_id() -> Column:
    """doc_id, or for a null a number of 2**62 or more made of the text, so that null ids come last."""
    return F.coalesce(F.col("doc_id").cast("long"), F.expr("4611686018427387904 + (xxhash64(text) & 4611686018427387903)"))


def _signed(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, row_id, node, n_shingles, keys, sketch) of each row; node, keys and sketch are null without shingles."""
    k, trees = forest.prefix, forest.trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                sets = shingle_sets(data, offsets, forest.size)
                full = np.array([len(x) > 0 for x in sets], bool)
                signature = _signatures(sets, k * trees)
                low = (signature & np.uint32(15)).astype(np.uint8)
                sketch = low[:, 0::2] | (low[:, 1::2] << 4) if k * trees % 2 == 0 else low
                keys = np.zeros((len(signature), trees), np.uint64)
                for t in range(trees):
                    h = np.full(len(signature), np.uint64(t + 1))
                    for j in range(t * k, t * k + k):
                        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, j].astype(np.uint64))
                    keys[:, t] = h
                at = np.cumsum(full) - 1
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), batch.column("row_id").slice(a, b - a), pa.array(_node(sets), mask=~full),
                    pa.array(np.array([len(x) for x in sets], np.int64)),
                    pa.array([keys[i].view(np.int64) if x else None for i, x in zip(at, full, strict=True)], pa.list_(pa.int64())),
                    pa.array([sketch[i].tobytes() if x else None for i, x in zip(at, full, strict=True)], pa.binary()),
                ], names=schema.names)

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("row_id", T.LongType()), T.StructField("node", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])
    return docs.select(F.col("doc_id").cast("long"), row_id().alias("row_id"), "text").mapInArrow(run, schema)


def _likeness(k_trees: int):
    """Estimated similarity of two sketches: equal four-bit values, less those equal by chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, -1) for c in ("left", "right"))
            x = a ^ b
            same = ((x & 15) == 0).sum(1) + ((x >> 4) == 0).sum(1) if k_trees % 2 == 0 else (x == 0).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("center"), batch.column("node"), pa.array((same / k_trees - 1 / 16) / (15 / 16))], names=["center", "node", "alike"])

    return run


def _families(signed: DataFrame, forest: Forest) -> DataFrame:
    """Edges (a, b) that hold together all nodes which may be linked."""
    # Equal sets have equal signatures: copies become one node, in each task first, before their keys are dealt out.
    nodes = stored(signed.where("node is not null").groupBy("node").agg(F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "signatures")
    active = nodes.select("node", F.explode("keys").alias("key"))
    sketches = nodes.select("node", "sketch")
    edges = []
    for turn in range(forest.rounds + 1):
        buckets = active.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("other")).where("center != other").select("key", "center")
        members = stored(active.join(buckets, "key").where("node != center").select("key", "center", "node").distinct(), "members")
        if members.isEmpty():
            break
        pairs = members.select("center", "node").distinct()
        if turn == forest.rounds:
            edges.append(pairs.select(F.col("center").alias("a"), F.col("node").alias("b")))
            break
        met = pairs.join(sketches.withColumnRenamed("sketch", "right"), "node").join(sketches.select(F.col("node").alias("center"), F.col("sketch").alias("left")), "center")
        alike = stored(met.select("center", "node", "left", "right").mapInArrow(_likeness(forest.prefix * forest.trees), "center long, node long, alike double"), "alike")
        edges.append(alike.where(F.col("alike") >= forest.family).select(F.col("center").alias("a"), F.col("node").alias("b")))
        active = members.join(alike.where(F.col("alike") < forest.done), ["center", "node"]).select("node", "key")
    out = edges[0] if edges else signed.sparkSession.createDataFrame([], "a long, b long")
    for more in edges[1:]:
        out = out.unionByName(more)
    return out


def _chunk(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The nodes of one chunk in one row: ids, copies, and all shingles as places in the chunk's own sorted list."""
    node, one = np.unique(table.column("node").to_numpy(), return_index=True)
    sets = [unpack(table.column("shingles")[int(i)].as_py()) for i in one]
    size = np.array([len(x) for x in sets], "<i4")
    distinct, place = np.unique(np.concatenate(sets), return_inverse=True)
    copies = table.column("copies").to_numpy()[one]
    body = [node.astype("<i8"), copies.astype("<i8"), size, place.astype("<u2" if len(distinct) < 65536 else "<u4")]
    packed = pack(distinct)
    head = np.array([len(node), len(distinct), len(packed)], "<i8").tobytes()
    return pa.table({
        "family": pa.array([key[0].as_py()], pa.int64()), "chunk": pa.array([key[1].as_py()], pa.int64()), "chunks": pa.array([table.column("chunks")[0].as_py()], pa.int64()),
        "payload": pa.array([head + packed + b"".join(x.tobytes() for x in body)], pa.binary())})


class _Chunk:
    def __init__(self, raw: bytes):
        n, m, size = np.frombuffer(raw, "<i8", 3).tolist()
        at = 24 + size
        self.distinct = unpack(raw[24:at])
        self.node = np.frombuffer(raw, "<i8", n, at)
        self.copies = np.frombuffer(raw, "<i8", n, at + 8 * n)
        self.size = np.frombuffer(raw, "<i4", n, at + 16 * n).astype(np.int64)
        self.place = np.frombuffer(raw, "<u2" if m < 65536 else "<u4", int(self.size.sum()), at + 20 * n).astype(np.int64)
        self.owner = np.repeat(np.arange(n), self.size)

    def columns(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node, column) of the shingles in the sorted list `wanted`."""
        at = np.minimum(np.searchsorted(wanted, self.distinct), max(len(wanted) - 1, 0))
        known = wanted[at] == self.distinct if len(wanted) else np.zeros(len(self.distinct), bool)
        keep = known[self.place]
        return self.owner[keep], at[self.place[keep]]


def _shared(a: _Chunk, b: _Chunk, width: int = 8192) -> np.ndarray:
    """Numbers of common shingles of all nodes of two chunks, as products of 0/1 matrices, some columns at a time."""
    if a is b:
        count = np.bincount(a.place, minlength=len(a.distinct))
        wanted = a.distinct[count > 1]
    else:
        wanted = np.intersect1d(a.distinct, b.distinct, assume_unique=True)
    out = np.zeros((len(a.node), len(b.node)), np.float32)
    rows = [x.columns(wanted) for x in ((a,) if a is b else (a, b))]
    for start in range(0, len(wanted), width):
        dense = []
        for chunk, (owner, column) in zip((a, b), rows, strict=False):
            part = (column >= start) & (column < start + width)
            matrix = np.zeros((len(chunk.node), min(width, len(wanted) - start)), np.float32)
            matrix[owner[part], column[part] - start] = 1
            dense.append(matrix)
        out += dense[0] @ dense[-1].T
    return out.astype(np.int64)


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest connected row of each row of a symmetric 0/1 matrix."""
    root = np.arange(len(linked))
    while True:
        least = np.minimum(root, np.where(linked, root[None, :], len(root)).min(1, initial=len(root)))
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _meet(forest: Forest):
    """Two chunks (or one with itself): sums of links per node, and a root for each node with a link."""
    bound = Fraction(forest.threshold).limit_denominator(10_000)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks = {i: _Chunk(x) for i, x in zip(table.column("chunk").to_pylist(), table.column("payload").to_pylist(), strict=True)}
        a, b = chunks[key[1].as_py()], chunks[key[2].as_py()]
        shared = _shared(a, b)
        union = a.size[:, None] + b.size[None, :] - shared
        linked = bound.denominator * shared >= bound.numerator * union
        if a is b:
            np.fill_diagonal(linked, False)
            node, links, square = a.node, linked @ a.copies, linked
        else:
            node, links = np.concatenate([a.node, b.node]), np.concatenate([linked @ b.copies, linked.T @ a.copies])
            n = len(a.node)
            square = np.zeros((len(node), len(node)), bool)
            square[:n, n:], square[n:, :n] = linked, linked.T
        root = node[_roots(square)]
        some = links > 0
        return pa.table({"node": pa.array(node[some]), "links": pa.array(links[some].astype(np.int64)), "root": pa.array(root[some])})

    return run


def _verified(docs: DataFrame, members: DataFrame, edges: DataFrame, forest: Forest) -> DataFrame:
    """(node, links, root) rows of all exact links."""
    family = components(edges)
    family = family.unionByName(family.select(F.col("root").alias("node"), "root").distinct())
    known = stored(family.join(members, "node").select("node", F.col("root").alias("family"), "row_id", "copies", "n_shingles"), "family")
    parts = known.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("m")).select(
        "family", F.greatest(F.ceil(F.col("n") / forest.chunk_nodes), F.ceil(F.col("m") / forest.chunk_shingles)).cast("long").alias("chunks"))
    placed = known.join(parts, "family").select("node", "family", "chunks", F.expr("pmod(xxhash64(node), chunks)").alias("chunk"), "row_id", "copies")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                sets = shingle_sets(data, offsets, forest.size)
                # The text of a repeated id may be another node's; such rows go.
                right = _node(sets) == batch.column("node").slice(a, b - a).to_numpy()
                part = batch.slice(a, b - a)
                packed = pa.array([pack(np.unique(x >> np.uint64(16))) for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), packed], names=[*names, "shingles"]).filter(pa.array(right))

    names = ["node", "family", "chunk", "chunks", "copies"]
    # Both sides grow with the corpus, so this join is a merge at any size.
    texts = docs.select(row_id().alias("row_id"), "text").where("text is not null").join(placed.hint("merge"), "row_id").select(*names, "text")
    sets = texts.mapInArrow(shingles, "node long, family long, chunk long, chunks long, copies long, shingles binary")
    chunks = stored(sets.groupBy("family", "chunk").applyInArrow(_chunk, "family long, chunk long, chunks long, payload binary"), "chunks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    meetings = chunks.select("family", "chunk", "payload", other).select("family", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "payload")
    return stored(meetings.groupBy("family", "i", "j").applyInArrow(_meet(forest), "node long, links long, root long"), "links")


def node_classes(docs: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows of doc_id, row_id, node, n_shingles; nodes with class_node (one for the class), class_id and n_links."""
    signed = stored(_signed(docs, forest), "signed")
    members = signed.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("row_id").alias("row_id"), F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"))
    members = stored(members, "nodes")
    links = _verified(docs, members, _families(signed, forest), forest)
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    n_links = links.groupBy("node").agg(F.sum("links").alias("links"))
    told = members.join(n_links, "node", "left").join(roots, "node", "left").select(
        "node", "row_id", "first_id", F.coalesce("root", "node").alias("class_node"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = told.groupBy("class_node").agg(F.min("first_id").alias("class_id"), F.min(F.struct("row_id", "node")).alias("best"))
    nodes = told.join(named, "class_node").select("node", "class_node", "class_id", "n_links", F.col("best.node").alias("best"))
    return signed.select("doc_id", "row_id", "node", "n_shingles"), nodes


def joined(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """One row per document row: doc_id, class_id, n_links (other rows with a similarity of the threshold or more), n_shingles."""
    rows, nodes = node_classes(docs, forest or Forest())
    linked = rows.where("node is not null").join(nodes, "node").select("doc_id", "class_id", "n_links", "n_shingles")
    return linked.unionByName(rows.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "n_shingles"))


def deduplicated(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """The rows of `docs`, all columns as they are, with one row of each class: that with the smallest id. Rows without
    shingles stay."""
    forest = forest or Forest()
    _, nodes = node_classes(docs.select("doc_id", "text"), forest)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("row").field(at)):
                part = batch.slice(a, b - a)
                found = shingle_sets(data, offsets, forest.size)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("row_id"), pa.array(_node(found), mask=np.array([not len(x) for x in found], bool))], names=["row", "row_id", "node"])

    at = docs.columns.index("text")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_id().alias("row_id"))
    schema = T.StructType([*rows.schema, T.StructField("node", T.LongType())])
    found = rows.mapInArrow(sets, schema)
    ranked = found.where("node is not null").withColumn("place", F.expr("row_number() over (partition by node order by row_id)")).where("place = 1")
    kept = ranked.join(nodes.where("node = best").select("node"), "node", "left_semi").select("row.*")
    return kept.unionByName(found.where("node is null").select("row.*"))
