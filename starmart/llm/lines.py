"""Line dedup: lines that many documents share stay in one document only.

Every text is cut at its line ends and exploded to (document, position, key). The key of a line is the line without `[\\x20\\x09-\\x0D]`
at both ends and with A-Z in lower case, held as two 64-bit hashes. Keys of `min_chars` code points or more that `min_docs` documents
or more hold lose all their lines, except in the largest doc_id that holds them. The other lines are put together again by position.

How the work is dealt: lines travel as hashes, never as text. Documents per key are counted in two steps, first one row for each
document and key, then one for each key with partial counts on the map side, so a line that a third of all documents
hold costs each map task one row. The keys over the threshold are written down; lines meet them in a join that deals hot keys to
several tasks. Texts move once, to meet the positions that they lose.

Defined results: a null or empty text is one empty line; a null text whose line stays is given back as null; rows with equal doc_id
are one document for the counts and are cut each by itself; documents with a null doc_id are left whole and count nowhere; lines that are repeated
inside the last document stay there; an empty table gives an empty result. Columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.spread import spread_join
from starmart.llm.storage import stored

MIN_CHARS, MIN_DOCS = 40, 5
#: The characters that are stripped from a line.
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """`line` stripped, with A-Z in lower case and all other letters as they are."""
    bare = F.btrim(line, F.lit(_BLANKS))
    # Texts of ASCII alone take the fast way.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _exploded(docs: DataFrame, min_chars: int) -> DataFrame:
    """id, hash of the text, place and the two hashes (a, b) of each line whose key is long enough to count."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    lines = texts.select("id", F.xxhash64("text").alias("of"), F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    keys = lines.select("id", "of", "place", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select("id", "of", "place", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), F.col("key")).alias("b"))


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The keys that `min_docs` documents or more hold: a, b, last (the largest doc_id with the key), n_docs and n_rows (lines in all)."""
    by_doc = _exploded(docs, min_chars).groupBy("a", "b", "id").agg(F.count(F.lit(1)).alias("n"))
    by_key = by_doc.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last"), F.sum("n").alias("n_rows"))
    return by_key.where(F.col("n_docs") >= min_docs)


def _without(text: str | None, gone: list[int] | None) -> tuple[str | None, int, int]:
    """`text` without the lines at the places `gone`, its number of lines before that, and how many went."""
    lines = (text or "").split("\n")
    if not gone:
        return text, len(lines), 0
    out = set(gone)
    return "\n".join(line for i, line in enumerate(lines) if i not in out), len(lines), len(out)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [_without(t.as_py(), g.as_py()) for t, g in zip(batch.column("text"), batch.column("gone"), strict=True)]
        texts, before, lost = zip(*made, strict=True) if made else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(lost, pa.int64())], names=["row", "text", "n_lines", "n_dropped"])


def without_shared_lines(docs: DataFrame, carry: list[str], min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document row: row (a struct of the `carry` columns), text (what is left), n_lines (before), n_dropped."""
    shared = stored(shared_lines(docs, min_chars, min_docs).select("a", "b", "last", "n_rows"), "lines")
    met = spread_join(_exploded(docs, min_chars), shared, ["a", "b"], "n_rows", "id").where("id < last")
    gone = met.groupBy("id", "of").agg(F.collect_set("place").alias("gone"))
    of = F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("of")  # rows with equal doc_id differ by it
    whole = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs["doc_id"].alias("id"), of, docs["text"])
    row = whole.schema["row"]
    schema = T.StructType([row, T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return whole.join(gone, ["id", "of"], "left").select("row", "text", "gone").mapInArrow(_cut, schema)


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of `docs` with shared lines cut out of `text`; all other columns stay as they are."""
    cut = without_shared_lines(docs, docs.columns, min_chars, min_docs)
    return cut.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (of what is left, a null text as an empty one) per document row."""
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return without_shared_lines(docs, ["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", kept)
