"""SentencePiece encoding and decoding on the tokenizers library: the model file is parsed and rebuilt, then checked for parity.

The protobuf is read field by field. The normaliser is rebuilt from its flags and character map, the metaspace marker
from the escape flag, the model from its type: unigram scores as they are, or for a BPE model the merges that its scores
imply (each piece's splits into two known pieces, by falling score). Byte fallback comes from the byte pieces.

No piece of such a model holds the marker behind another character, and a character that no piece holds stands alone;
so a text with an identity normaliser falls apart into words, each with the marks of the blanks before it, that can be
encoded one by one. Each slice of a batch encodes the distinct words that are new to its worker in one multithreaded batch, has
the SentencePiece library encode them too, and puts the ids together by array operations. Models for which this does not hold (character maps, user-defined pieces, inner markers) encode whole texts.

The model's path must be readable on every executor, or the bytes are sent: `Model.bytes` is what tasks get. Defined
results: a null text has null ids and counts; an empty text has no ids; repeated rows are encoded one by one.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.words import slices, words

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 1_000_000
#: Chunks that one call of the tokenizer gets.
BATCH = 8192
MARK = "▁"
#: Piece kinds and model types of the public protobuf definition.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at, value, shift = at + 1, value | (byte & 0x7F) << shift, shift + 7
        if byte < 0x80:
            return value, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        if key & 7 == 0:
            value, at = _varint(raw, at)
        else:
            if key & 7 == 2:
                size, at = _varint(raw, at)
            else:
                size = {1: 8, 5: 4}[key & 7]
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class Memo:
    """Ids of chunks that this worker has met, by 64-bit key; it is emptied when it holds `limit` chunks, so its size is bounded."""

    def __init__(self, limit: int = 700_000):
        self.limit = limit
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.same = np.zeros(0, np.int32), np.zeros(0, bool)

    def knows(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys) + len(keys) > self.limit:
            self.__init__(self.limit)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def learn(self, keys: np.ndarray, coded: list[list[int]], same: list[bool]) -> None:
        size = np.array([len(x) for x in coded], np.int64)
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(coded), np.int32, int(size.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.size = np.insert(self.keys, at, keys), np.insert(self.begin, at, begin), np.insert(self.size, at, size)
        self.same = np.insert(self.same, at, same)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, keys)

    def ids(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks, in a row, and where each chunk's end."""
        n = self.size[place]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.begin[place] - ends + n, n) + np.arange(int(n.sum()))], ends


class Model:
    """A SentencePiece model, parsed from the bytes of its file."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = {k: v for k, v in _fields(value) if k in (3, 24, 35)}
            elif number == 3:
                normaliser = dict(_fields(value))
        self.type = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.charsmap = normaliser.get(2, b"")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        self.escape = bool(normaliser.get(5, 1))
        if self.type not in (UNIGRAM, BPE) or trainer.get(24, 0):
            raise ValueError("only unigram and BPE models whose marker stands before words can be rebuilt")
        self.ids = {piece: i for i, piece in enumerate(self.pieces)}
        self.unknown = self.kinds.index(UNKNOWN)

    def merges(self) -> list[tuple[str, str]]:
        """The merges of a BPE model, by falling score, equal ones in the order of the pieces."""
        found = []
        for i, piece in enumerate(self.pieces):
            if self.kinds[i] == NORMAL:
                halves = ((piece[:k], piece[k:]) for k in range(1, len(piece)))
                found += [(-self.scores[i], i, self.ids[a], self.ids[b]) for a, b in halves if a in self.ids and b in self.ids]
        return [(self.pieces[a], self.pieces[b]) for _, _, a, b in sorted(found)]

    @cached_property
    def tokenizer(self):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        if self.type == BPE:
            model = models.BPE(vocab=self.ids, merges=self.merges(), unk_token=self.pieces[self.unknown], fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            model = models.Unigram(list(zip(self.pieces, self.scores, strict=True)), self.unknown, self.byte_fallback)
        made = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        made.normalizer = normalizers.Sequence(steps)
        made.add_tokens([AddedToken(p, normalized=False) for p, k in zip(self.pieces, self.kinds, strict=True) if k == USER_DEFINED])
        made.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        return made

    @cached_property
    def divisible(self) -> bool:
        """Whether words can be encoded one by one."""
        plain = [p for p, k in zip(self.pieces, self.kinds, strict=True) if k == NORMAL]
        return (not self.charsmap and not self.squeeze and self.escape and self.byte_fallback and USER_DEFINED not in self.kinds
                and not any(MARK in p.lstrip(MARK) or " " in p for p in plain))

    @cached_property
    def separators(self) -> np.ndarray:
        """The space, and other blanks that no longer piece holds."""
        out = np.zeros(256, bool)
        out[0x20] = True
        out[[ord(c) for c in "\t\n\v\f\r" if not any(c in p for p, k in zip(self.pieces, self.kinds, strict=True) if k == NORMAL and len(p) > 1)]] = True
        return out

    @cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces' bytes in a row, and where each begins and how long it is."""
        raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(MARK, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)]
        size = np.array([len(x) for x in raw], np.int64)
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts."""
        prefixed = [(" " + x if self.dummy_prefix and x else x) for x in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(prefixed, add_special_tokens=False)]

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray, verify: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts of a slice: all ids, where each text's ids begin, and whether the SentencePiece library gives the same."""
        n = len(offsets) - 1
        marked = np.zeros(n, bool)
        if self.divisible:
            # A marker that stands in the text itself may join with spaces around it: such texts are encoded whole.
            seen = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)
            marked[np.searchsorted(offsets, seen, "right") - 1] = True
        if self.divisible and not marked.any():
            return self._by_words(data, offsets, verify)
        raw = data.tobytes()
        texts = [raw[i:j].decode() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        lists = self.encode(texts)
        ok = [x == y for x, y in zip(self.processor.encode(texts, num_threads=1), lists, strict=True)] if verify else [True] * n
        at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return np.fromiter((i for x in lists for i in x), np.int32, int(at[-1])), at, np.array(ok, bool)

    def _by_words(self, data: np.ndarray, offsets: np.ndarray, verify: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A chunk is a run of spaces and the word behind it, or what blanks are left: spaces at a line's end, or one other blank."""
        found = words(data, offsets, self.separators)
        space, place = data == 0x20, np.arange(len(data))
        spaces = place - np.maximum.accumulate(np.where(space, -1, place))  # length of the run of spaces that ends at a byte
        origin = np.repeat(offsets[:-1], found.counts)
        lead = np.where(found.start > origin, np.minimum(spaces[found.start - 1], found.start - origin), 0)
        begin = found.start - lead
        marks = lead + ((begin == origin) & self.dummy_prefix)
        edge = np.zeros(len(data) + 1, np.int32)
        edge[begin] += 1
        np.subtract.at(edge, found.end, 1)
        idle = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        limit = np.zeros(len(data) + 1, bool)
        limit[offsets] = True
        joined = space[idle] & ~limit[idle]
        joined[1:] &= space[idle[:-1]] & (np.diff(idle) == 1)
        joined[:1] = False
        head = np.flatnonzero(~joined)
        run = np.diff(np.append(head, len(idle)))
        others = [
            (MARK if first and self.dummy_prefix else "") + (MARK * size if byte == 0x20 else chr(byte))
            for first, size, byte in zip(limit[idle[head]].tolist(), run.tolist(), data[idle[head]].tolist(), strict=True)]
        key = np.concatenate([
            found.hashes() ^ (marks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
            np.fromiter((hash(x) & 0x7FFFFFFFFFFFFFFF for x in others), np.uint64, len(others))])
        distinct, one, which = np.unique(key, return_index=True, return_inverse=True)
        raw = data.tobytes()

        def chunk(i: int) -> str:
            return MARK * int(marks[i]) + raw[found.start[i] : found.end[i]].decode() if i < len(found) else others[i - len(found)]

        memo = self.memo
        new = np.flatnonzero(~memo.knows(distinct))
        if len(new):
            coded, same = [], []
            for i in range(0, len(new), BATCH):  # an encoding holds far more than its ids
                chunks = [chunk(i) for i in one[new[i : i + BATCH]].tolist()]
                coded += [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
                same += self._same(chunks, coded[i:]) if verify else [True] * len(chunks)
            memo.learn(distinct[new], coded, same)
        at = np.concatenate([begin, idle[head]])
        order = np.argsort(at, kind="stable")
        at, chunk_at = at[order], memo.place(distinct)[which.ravel()[order]]
        ids, ends = memo.ids(chunk_at)
        bad = np.concatenate([[0], np.cumsum(~memo.same[chunk_at])])
        first = np.searchsorted(at, offsets)
        return ids, np.concatenate([[0], ends])[first], np.diff(bad[first]) == 0

    def _same(self, chunks: list[str], coded: list[list[int]]) -> list[bool]:
        """Whether the SentencePiece library gives a chunk the same ids. It puts a mark in front by itself: a chunk that begins
        with one is given without it; before another a line end is set, whose two ids are taken off."""
        given = [x.replace(MARK, " ") for x in chunks]
        if not self.dummy_prefix:
            return [x == y for x, y in zip(self.processor.encode(given, num_threads=1), coded, strict=True)]
        given = [x[1:] if c.startswith(MARK) else "\n" + x for x, c in zip(given, chunks, strict=True)]
        skip = [0 if c.startswith(MARK) else 2 for c in chunks]
        # A lone mark stands for the empty text with its prefix, which the library leaves out.
        lone = [self.ids[MARK]] if MARK in self.ids else []
        return [(x[k:] or lone) == y for x, k, y in zip(self.processor.encode(given, num_threads=1), skip, coded, strict=True)]

    @cached_property
    def memo(self) -> Memo:
        return Memo()

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of ids by the rebuilt decoder; the mark that encoding puts in front is taken off."""
        out = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [x[1:] if self.dummy_prefix and x.startswith(" ") else x for x in out]

    def decode_slice(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The bytes of each text's ids, by array operations."""
        table, begin, size = self._bytes
        n = size[ids]
        ends = np.cumsum(n)
        raw = table[np.repeat(begin[ids] - ends + n, n) + np.arange(int(n.sum()))].tobytes()
        stops = np.concatenate([[0], ends])[at].tolist()
        texts = [raw[i:j] for i, j in zip(stops[:-1], stops[1:], strict=True)]
        return [x[1:] if self.dummy_prefix and x.startswith(b" ") else x for x in texts]

    @cached_property
    def processor(self):
        """The SentencePiece library's own processor of the same model, for parity."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.raw)


_MODELS: dict[int, Model] = {}


def _model(raw: bytes) -> Model:
    """One rebuilt model per worker process and file."""
    key = hash(raw)
    if key not in _MODELS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        _MODELS[key] = Model(raw)
    return _MODELS[key]


def encoded(docs: DataFrame, model_path: str = MODEL, verify: bool = True) -> DataFrame:
    """One row per document row: doc_id, ids, n_tokens, parity (the SentencePiece library gives the same ids, for
    each distinct word or the whole text), round_trip (decoding gives the text back; not for a text with the marker itself); the last two are null where `verify` is off."""
    with open(model_path, "rb") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("parity", T.BooleanType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(held.value)
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text"), SLICE):
                null = batch.column("text").slice(a, b - a).is_null().to_numpy(zero_copy_only=False)
                ids, at, parity = model.encode_slice(data, offsets, verify)
                back = parity
                if verify:
                    texts = [data[i:j].tobytes() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                    back = np.array([x == y for x, y in zip(model.decode_slice(ids, at), texts, strict=True)], bool)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=pa.array(null)),
                    pa.array(np.diff(at), mask=null),
                    pa.array(parity, mask=null | (not verify)), pa.array(back, mask=null | (not verify)),
                ], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decoded(rows: DataFrame, model_path: str = MODEL) -> DataFrame:
    """Rows of doc_id and ids to rows of doc_id and text; null ids give a null text."""
    with open(model_path, "rb") as file:
        held = rows.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(held.value)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = iter(model.decode([x for x in ids if x is not None]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([None if x is None else next(texts) for x in ids], pa.string())], names=schema.names)

    return rows.select("doc_id", "ids").mapInArrow(run, schema)


def digest(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """`encoded` with the ids as lower-case hex SHA-256 of their comma-joined decimals."""
    return encoded(docs, model_path).select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "parity", "round_trip")
