from __future__ import annotations

import pytest

from starmart.llm.storage import importable

#: Texts with nothing, blanks only, one word, ties, copies, other scripts, and one very long text without a line end.
LONG = " ".join(f"w{i % 977}x{i % 89}" for i in range(60_000))
TEXTS = [None, "", " \n\t ", "word", "word", "é ü 日本語\n😀", "a b c d e f g h i j k l", LONG]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """A table of documents from texts or (doc_id, text) pairs, with columns whose names operators use inside."""
    importable(spark)

    def make(texts, clash=True):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        rows = [(i, t, None, None, None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCS)
        if clash:
            df = df.selectExpr("*", *[f"'own' as `{c}`" for c in ("row", "hits", "spans", "node", "slice", "bucket", "key", "kept", "n_words", "row_id", "items", "clean", "place")])
        return df.repartition(3)

    return make


@pytest.fixture
def edge(frame):
    """Null, empty, long, tied and repeated rows, and a null id."""
    pairs = [*enumerate(TEXTS), (3, "word"), (None, "word"), (None, None)]
    return frame(pairs), pairs
