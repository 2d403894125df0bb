"""Quality rules by line sequence labelling: a linear-chain conditional random field marks lines as content or boilerplate.

Base counts of a text: words (`[^\\x20\\x09-\\x0D]+`), their code points, symbols, repeated lines, words in repeated 3-word windows.
Every line with a word gets features (shares of symbols, capitals, digits and marks, length, final mark, repetition,
place); the best label sequence of a document is found by Viterbi decoding, for all documents of a slice side by side.
The share of words in content lines decides: a document passes if it is at least `least_share` and no base rule failed.

The field is trained on a bounded sample of labelled documents (`Training`), on all of their lines. Lines have no labels of their own, so they
are latent, and learned by expectation-maximisation: the expected labels are forward-backward sums, bent as
little as needed (one number for each document) so that content lines hold `share` of the words of a document of quality 1 at least, and the rest at
most of one of quality 0. Weak evidence about single lines pulls in every document: repeated lines and lines heavy with symbols lean to boilerplate.
The weights then follow the expected labels by gradient steps. So a document may hold both kinds of lines. Without
labels of both kinds the weights are zero but for the content label's, so every document that passes the base rules is kept.

Defined results: a null or empty text has no words, fails the base rules and is not kept; repeated rows are judged
one by one; lines without a word have no label; labels with nulls are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.words import BLANKS, mix, slices, words

LEAST_SHARE = 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _table(SYMBOLS.encode())
_LINE_END = _table(b"\n")
_UPPER, _LOWER, _DIGIT = _table(bytes(range(0x41, 0x5B))), _table(bytes(range(0x61, 0x7B))), _table(b"0123456789")
_MARK = _table(b"!?")
_STOP = _table(b".!?:;\"')")

FEATURES = ["one", "words", "word_length", "symbols", "bars", "capitals", "digits", "marks", "stop", "repeated_words", "repeated_line", "first", "last"]


@dataclass
class Training:
    """The bounds of the sample that the field is fitted on, and how."""

    documents: int = 500  # of each quality
    rounds: int = 6  # of expectation and maximisation
    steps: int = 30  # in each round
    rate: float = 0.15
    penalty: float = 1e-3
    share: float = 0.8  # of the words, in lines of the kind that the document's label names
    weak: float = 3.0  # log-odds of the weak evidence about a line
    segment: int = 64  # lines side by side; longer documents are cut into several sequences


@dataclass
class Field:
    """Weights of a linear-chain field over the labels boilerplate (0) and content (1)."""

    emission: np.ndarray
    transition: np.ndarray

    @staticmethod
    def untrained() -> Field:
        emission = np.zeros((len(FEATURES), 2))
        emission[0, 1] = 1.0
        return Field(emission, np.zeros((2, 2)))

    def viterbi(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best labels of sequences `first[i]:first[i + 1]`; of equal ones, content is taken."""
        score = features @ self.emission
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        begin, length = first[:-1][order], length[order]
        back = np.zeros((len(features), 2), np.int8)
        best = score[begin[: np.count_nonzero(length)]]
        for t in range(1, int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -t, "left"))
            at = begin[:live] + t
            step = best[:live, :, None] + self.transition[None]
            choice = (step[:, 1] >= step[:, 0]).astype(np.int8)  # from which label each label is reached
            back[at] = choice
            best[:live] = np.where(choice, step[:, 1], step[:, 0]) + score[at]
        label = np.zeros(len(features), np.int8)
        n = len(best)
        last = (best[:, 1] >= best[:, 0]).astype(np.int8)
        label[begin[:n] + length[:n] - 1] = last
        for t in range(int(length[0]) - 1 if len(length) else 0, 0, -1):
            live = int(np.searchsorted(-length, -t, "left"))
            at = begin[:live] + t
            label[at - 1] = back[at, label[at]]
        return label

    def marginals(self, score: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward-backward sums of padded sequences with the line scores `score` (sequences x lines x labels): log of the
        total of each sequence, probability of each line's label, and of each two neighbours' labels."""
        n, steps = mask.shape
        forward, backward = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
        forward[:, 0] = score[:, 0]
        for t in range(1, steps):
            now = np.logaddexp(forward[:, t - 1, None, 0] + self.transition[0], forward[:, t - 1, None, 1] + self.transition[1]).reshape(n, 2) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], now, forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            ahead = backward[:, t + 1] + score[:, t + 1]
            now = np.logaddexp(self.transition[:, 0] + ahead[:, :1], self.transition[:, 1] + ahead[:, 1:])
            backward[:, t] = np.where(mask[:, t + 1, None], now, 0.0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        one = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        pair = mask[:, 1:] & mask[:, :-1]
        two = np.exp(forward[:, :-1, :, None] + self.transition + (score + backward)[:, 1:, None, :] - total[:, None, None, None]) * pair[:, :, None, None]
        return total, one, two

    def likelihood(self, features: np.ndarray, one: np.ndarray, two: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Expected log-likelihood of padded sequences under label probabilities `one` of lines and `two` of neighbours (0 or 1 where
        labels are known), and its gradients for emission and transition."""
        score = features @ self.emission
        total, share, joint = self.marginals(score, mask)
        value = float((one * score).sum() + (two * self.transition).sum() - total.sum())
        return value, np.einsum("ntf,ntl->fl", features, one - share), (two - joint).sum((0, 1))


class Sequences:
    """Documents cut into padded sequences of at most `segment` lines."""

    def __init__(self, features: list[np.ndarray], labels: list[int], training: Training):
        parts = [(d, x[i : i + training.segment]) for d, x in enumerate(features) for i in range(0, len(x), training.segment)]
        steps = max(len(x) for _, x in parts)
        self.document = np.array([d for d, _ in parts])
        self.features = np.zeros((len(parts), steps, len(FEATURES)))
        self.mask = np.zeros((len(parts), steps), bool)
        for i, (_, x) in enumerate(parts):
            self.features[i, : len(x)], self.mask[i, : len(x)] = x, True
        self.labels = np.array(labels)
        words = np.expm1(5 * self.features[:, :, FEATURES.index("words")]) * self.mask
        total = np.bincount(self.document, words.sum(1), minlength=len(labels))
        self.weight = words / np.maximum(total, 1)[self.document][:, None]  # each line's share of its document's words
        repeated = self.features[:, :, FEATURES.index("repeated_line")] > 0
        heavy = np.maximum(self.features[:, :, FEATURES.index("symbols")], self.features[:, :, FEATURES.index("bars")]) > 0.5
        self.evidence = -training.weak * ((repeated | heavy) & self.mask)

    def expected(self, field: Field, training: Training) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of lines and of neighbours, bent to the documents' labels."""
        score = self.features @ field.emission
        score[:, :, 1] += self.evidence
        # How far each line moves with its document: long lines more, so that few of them can carry the share.
        lean = self.weight * np.bincount(self.document, self.mask.sum(1), minlength=len(self.labels))[self.document][:, None]

        def content(bend: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            bent = score.copy()
            bent[:, :, 1] += lean * bend[self.document][:, None]
            _, one, two = field.marginals(bent, self.mask)
            return np.bincount(self.document, (one[:, :, 1] * self.weight).sum(1), minlength=len(self.labels)), one, two

        good = self.labels == 1
        share, one, two = content(np.zeros(len(self.labels)))
        short = np.where(good, share < training.share, share > 1 - training.share)
        low, high = np.where(good, 0.0, -30.0), np.where(good, 30.0, 0.0)
        for _ in range(12):
            middle = (low + high) / 2
            share, one, two = content(np.where(short, middle, 0.0))
            over = share > np.where(good, training.share, 1 - training.share)
            low, high = np.where(over, low, middle), np.where(over, middle, high)
        return one, two


def fit(features: list[np.ndarray], labels: list[int], training: Training) -> Field:
    """Rounds of expected line labels and of gradient steps (with running means of the gradients and their squares)."""
    rows = Sequences(features, labels, training)
    weights = np.zeros(len(FEATURES) * 2 + 4)
    field = Field(weights[:-4].reshape(-1, 2), weights[-4:].reshape(2, 2))
    count = rows.mask.sum()
    for _ in range(training.rounds):
        one, two = rows.expected(field, training)
        mean, square = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, training.steps + 1):
            _, emission, transition = field.likelihood(rows.features, one, two, rows.mask)
            gradient = np.concatenate([emission.ravel(), transition.ravel()]) / count - training.penalty * weights
            mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
            weights = weights + training.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            field = Field(weights[:-4].reshape(-1, 2), weights[-4:].reshape(2, 2))
    return field


class Measured:
    """Base counts and line features of the texts of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        found, lines = words(data, offsets, BLANKS), words(data, offsets, _LINE_END)
        before = lambda table: np.concatenate([[0], np.cumsum(table, dtype=np.int64)])
        chars = before((data & 0xC0) != 0x80)
        self.n_words = found.counts.astype(np.int64)
        letters = before(((data & 0xC0) != 0x80) & ~BLANKS[data])
        self.word_chars = letters[offsets[1:]] - letters[offsets[:-1]]
        symbols = before(_SYMBOL[data])
        self.n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]
        repeated = self._repeated(found)
        inside = before(repeated)
        self.n_repeat_words = inside[found.first[1:]] - inside[found.first[:-1]]
        # Lines with a word, in order; a line repeats if an earlier one of its text is equal.
        a, b = np.searchsorted(found.start, lines.start), np.searchsorted(found.start, lines.end)
        real = np.flatnonzero(b > a)
        text = lines.text_of(real)
        twice = np.zeros(len(real), bool)
        key = mix(lines.hashes()[real] + mix(text.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        twice[order[1:]] = key[order[1:]] == key[order[:-1]]
        self.n_dup_lines = np.bincount(text[twice], minlength=n).astype(np.int64)
        start, end, a, b = lines.start[real], lines.end[real], a[real], b[real]
        self.line_words, self.first = b - a, np.searchsorted(text, np.arange(n + 1))
        size = (chars[end] - chars[start]).astype(float)

        def share(table: np.ndarray) -> np.ndarray:
            total = before(table[data])
            return (total[end] - total[start]) / size

        upper, lower = share(_UPPER), share(_LOWER)
        n_words = np.maximum(self.line_words, 1)
        bar = _table(b"|")
        place = np.arange(len(real))
        self.features = np.stack([
            np.ones(len(real)), np.log1p(n_words) / 5, (letters[end] - letters[start]) / n_words / 10,
            np.minimum(1, 5 * share(_SYMBOL & ~bar)), np.minimum(1, 10 * share(bar)), upper / np.maximum(upper + lower, 1e-9), share(_DIGIT),
            np.minimum(1, 10 * share(_MARK)), _STOP[data[end - 1]] if len(real) else np.zeros(0), (inside[b] - inside[a]) / n_words, twice,
            place == self.first[text], place == self.first[text + 1] - 1], 1).astype(float)

    @staticmethod
    def _repeated(found) -> np.ndarray:
        """Words in 3-word windows that their text holds twice or more."""
        start, key = found.windows(found.hashes(), 3)
        key = mix(key + mix(found.text_of(start).astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        several = np.zeros(len(start), bool)
        several[order[1:][same]] = several[order[:-1][same]] = True
        return found.covered(start[several], 3)

    @property
    def base_failed(self) -> np.ndarray:
        return (self.n_words < LEAST_WORDS) | (100 * self.n_repeat_words > MOST_REPEATED * self.n_words)

    def content_share(self, field: Field) -> np.ndarray:
        """The share of words in lines that are labelled content; 0 without words."""
        content = np.concatenate([[0], np.cumsum(self.line_words * field.viterbi(self.features, self.first))])
        return (content[self.first[1:]] - content[self.first[:-1]]) / np.maximum(self.n_words, 1)


def trained(docs: DataFrame, labels: DataFrame, training: Training | None = None) -> Field:
    """Fit the field on `training.documents` documents of each quality: those whose ids hash lowest, whatever the order of rows."""
    training = training or Training()
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    picked = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(training.documents) for q in (0, 1)]
    # At most 2 * training.documents rows of two numbers: bounded by the parameter.
    sample = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                m = Measured(data, offsets)
                lists = [m.features[i:j].ravel() for i, j in zip(m.first[:-1].tolist(), m.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("doc_id", "quality")), pa.array(lists, pa.list_(pa.float64()))], names=["doc_id", "quality", "features"])

    rows = sample.mapInArrow(measure, "doc_id long, quality int, features array<double>").where("size(features) > 0").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["features"]))
    if len({r["quality"] for r in rows}) < 2:
        return Field.untrained()
    return fit([np.array(r["features"]).reshape(-1, len(FEATURES)) for r in rows], [r["quality"] for r in rows], training)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(docs: DataFrame, field: Field, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per document row: doc_id, the base counts, base_failed, kept, content_share."""
    schema = T.StructType([
        docs.schema["doc_id"], *(T.StructField(x, T.LongType()) for x in _COUNTS), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
        T.StructField("content_share", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                m = Measured(data, offsets)
                share = m.content_share(field)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), *(pa.array(getattr(m, x)) for x in _COUNTS), pa.array(m.base_failed),
                    pa.array(~m.base_failed & (share >= least_share)), pa.array(share)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def retained(docs: DataFrame, field: Field, least_share: float = LEAST_SHARE) -> DataFrame:
    """The rows of `docs` that are kept, all columns as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(at)):
                m = Measured(data, offsets)
                yield batch.slice(a, b - a).filter(pa.array(~m.base_failed & (m.content_share(field) >= least_share)))

    return docs.mapInArrow(run, docs.schema)
