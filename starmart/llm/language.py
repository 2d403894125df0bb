"""Language ID by mixture inference: expectation-maximisation over n-gram likelihoods, with a penalised choice of the language set.

Grams are three consecutive bytes of the text, with A-Z lower-cased and every byte that is no letter taken as a blank (bytes
from 0x80 are letters), runs of blanks as one, and a blank at both ends; each gram falls into one of 2**16 cells. The model is the smoothed
share of each cell in the learned texts of each language, counted over all of them. A document is a mixture: its
proportions maximise the likelihood of its grams, found by expectation-maximisation. The set of languages is chosen by the
likelihood less `penalty` * log(grams) for each language: from all of them down to two the smallest share is dropped, and the best value of any
size is compared with the best single language. Turns end within `tolerance` nats of the maximum (the slope of the likelihood bounds
what is left to gain), and a text leaves early only where that bound says that no set of two or more can win any more.

Learned from are texts with a language whose crc32(doc_id as text) mod 4 is not 2; predictions see the text alone. Defined results:
`und` with score 0 for a null text, a text without a letter, or without any learned language; ties go to the language
that sorts first; a null doc_id counts as not held out; repeated rows count and are predicted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.words import slices

CELLS = 1 << 16
UNKNOWN = "und"

#: The byte that stands for each byte: lower-case letters, 0 for a blank, bytes of other scripts as they are.
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells of all grams, where each text's begin)."""
    n = len(offsets) - 1
    folded = np.zeros(len(data) + 2 * n, np.uint8)  # a blank before and behind each text
    folded[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, np.diff(offsets))] = _FOLD[data]
    begin = offsets + 2 * np.arange(n + 1)
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0) | (folded[:-1] != 0)
    keep[begin[:-1]] = True
    at = np.concatenate([[0], np.cumsum(keep)])[begin]
    short = folded[keep].astype(np.uint32)
    if len(short) < 3:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    cell = ((short[:-2] * np.uint32(0x9E3779B1) ^ short[1:-1] * np.uint32(0x85EBCA6B) ^ short[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    inside = np.ones(len(cell), bool)
    for back in (1, 2):
        edge = at[1:-1] - back
        inside[edge[(edge >= 0) & (edge < len(cell))]] = False
    return cell[inside], np.concatenate([[0], np.cumsum(inside)])[np.minimum(at, len(cell))]


@dataclass
class Mixture:
    """Log shares of cells by language (languages x cells), float32, and the names in sorted order."""

    names: list[str]
    logs: np.ndarray
    penalty: float = 1.0
    tolerance: float = 0.1
    turns: int = 500

    def proportions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(proportions of each text, whether it has a gram)."""
        cell, at = grams(data, offsets)
        n, k = len(offsets) - 1, len(self.names)
        total = np.diff(at)
        key = np.repeat(np.arange(n, dtype=np.uint64) << np.uint64(16), total) | cell.astype(np.uint64)
        key.sort()
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(edge, len(key))).astype(np.float32)
        cell, text = (key[edge] & np.uint64(CELLS - 1)).astype(np.int64), (key[edge] >> np.uint64(16)).astype(np.int64)
        out = np.zeros((n, k))
        some = np.flatnonzero(total > 0)
        if not len(some):
            return out, total > 0
        logs = self.logs.T[cell]
        first = np.searchsorted(text, some)
        single = np.add.reduceat(logs * count[:, None], first, axis=0, dtype=np.float64)
        best = single.argmax(1)
        out[some, best] = 1.0
        if k == 1:
            return out, total > 0
        size = np.log(np.maximum(total[some], 2)) * self.penalty
        share = np.exp(logs)
        row = np.repeat(np.arange(len(some)), np.diff(np.append(first, len(text))))
        out[some] = self._chosen(out[some], single.max(1) - size, share, count, row, size)
        return out, total > 0

    def _chosen(self, found, value, share, count, row, size) -> np.ndarray:
        """Backward steps from all languages to two: the proportions of the best set, or `found`, where none is above `value`."""
        live = np.arange(len(found))
        active = np.ones(found.shape, bool)
        weight = np.full(found.shape, 1.0 / found.shape[1])
        for left in range(found.shape[1], 1, -1):
            weight, likelihood, bound = self._maximised(weight, active, share, count, row, value[live] + 2 * size[live])
            score = likelihood - left * size[live]
            better = score > value[live]
            found[live[better]], value[live[better]] = weight[better], score[better]
            on = bound > value[live] + 2 * size[live]
            if left == 2 or not on.any():
                break
            inside = on[row]
            share, count, row = share[inside], count[inside], (np.cumsum(on) - 1)[row[inside]]
            live, active, weight = live[on], active[on], weight[on]
            smallest = np.where(active, weight, np.inf).argmin(1)
            active[np.arange(len(live)), smallest] = False
            # Shares that came to nothing get a start again.
            weight = np.where(active, np.maximum(weight, 1e-6), 0)
            weight /= weight.sum(1, keepdims=True)
        return found

    def _maximised(self, weight, active, share, count, row, floor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expectation-maximisation of each text's weights: (weights, log-likelihood, bound of what the active languages can reach).
        Texts whose bound is not above `floor` end at once."""
        weight, value, bound = weight.copy(), np.zeros(len(weight)), np.zeros(len(weight))
        live = np.arange(len(weight))
        for _ in range(self.turns):
            first = np.searchsorted(row, np.arange(len(live)))
            now = weight[live]
            norm = np.maximum((share * now.astype(np.float32)[row]).sum(1), 1e-30)
            value[live] = np.add.reduceat(np.log(norm) * count, first, dtype=np.float64)
            slope = np.add.reduceat(share * (count / norm)[:, None], first, axis=0, dtype=np.float64)
            left = np.where(active[live], slope, 0).max(1) - np.add.reduceat(count, first, dtype=np.float64)
            bound[live] = value[live] + np.maximum(left, 0)
            on = (left > self.tolerance) & (bound[live] > floor[live])
            if not on.any():
                break
            turned = now[on] * slope[on]
            weight[live[on]] = turned / turned.sum(1, keepdims=True)
            if not on.all():
                inside = on[row]
                share, count, row, live = share[inside], count[inside], (np.cumsum(on) - 1)[row[inside]], live[on]
        return weight, value, bound


def learned(docs: DataFrame, smoothing: float = 0.1, penalty: float = 1.0) -> Mixture:
    """Count all grams of the texts that may be learned from, by language; the counts are sums over tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = batch.column("lang")
            for a, b, data, offsets in slices(batch.column("text")):
                cell, at = grams(data, offsets)
                names, which = np.unique(np.array(lang.slice(a, b - a).to_pylist(), object).astype(str), return_inverse=True)
                owner = np.repeat(which, np.diff(at))
                sums = np.bincount(owner * CELLS + cell, minlength=len(names) * CELLS).reshape(len(names), CELLS)
                for name, row in zip(names.tolist(), sums, strict=True):
                    total[name] = total[name] + row if name in total else row
        for name, row in total.items():
            at = np.flatnonzero(row)
            for i in range(0, max(len(at), 1), 10_000):
                part = at[i : i + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(part.astype(np.int32)), pa.array(row[part].astype(np.int64))], names=["lang", "cell", "n"])

    seen = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("lang", "text")
    # Languages x cells numbers at most, whatever the size of the corpus.
    rows = seen.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    table = np.full((len(names), CELLS), smoothing)
    if names:
        np.add.at(table, (np.searchsorted(names, rows.column("lang").to_pylist()), rows.column("cell").to_numpy()), rows.column("n").to_numpy())
    return Mixture(names, np.log(table / table.sum(1, keepdims=True)).astype(np.float32), penalty)


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; a text without one of A-Z is decoded to see."""
    ascii_letter = np.concatenate([[0], np.cumsum((_FOLD[data] != 0) & (data < 0x80))])
    out = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predicted(docs: DataFrame, model: Mixture) -> DataFrame:
    """One row per document row: doc_id, held_out, lang_pred, score (its proportion), proportions (by language)."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # languages x cells
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("proportions", T.MapType(T.StringType(), T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = held.value
        names = np.array([*mixture.names, UNKNOWN], object)
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                if mixture.names:
                    share, known = mixture.proportions(data, offsets)
                    known &= _letters(data, offsets)
                    best = np.where(known, share.argmax(1), len(names) - 1)
                    score = np.where(known, share.max(1), 0.0)
                else:
                    known, share = np.zeros(b - a, bool), np.zeros((b - a, 0))
                    best, score = np.zeros(b - a, np.int64), np.zeros(b - a)
                maps = [[(mixture.names[j], float(share[i, j])) for j in np.flatnonzero(share[i] > 0)] if known[i] else [] for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(names[best], pa.string()), pa.array(np.minimum(score, 1.0)),
                    pa.array(maps, pa.map_(pa.string(), pa.float64()))], names=schema.names)

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, schema)
