"""Secret scans with column functions only: three fixed patterns, and sliding-window Shannon entropy over candidate strings.

Candidates are maximal runs of `[A-Za-z0-9+/_=-]` of `window` characters or more with a digit and a letter. A run of hexadecimal
digits is judged in class hex, any other in class base64. A window of `window` characters moves over the run; its
character counts and the sum of c * log2(c) are updated by the entering and the leaving character alone, and the
entropy is log2(window) - sum / window. The span of a candidate reaches from its first window at or above the class's
threshold to its last. Candidates on the allow-list, and spans that lie in a span of the fixed patterns, add nothing.

A name, a sign or a path joined to a value could hide it that way, so the parts of a run are candidates too: its pieces between `=` (signs at
the end of the run stay, as padding) and between path components that are placeholder words, and the maximal stretches of hexadecimal digits
in the pieces. Anchored patterns of the allow-list are matched against a part, the others against its hot stretch alone. Parts add the
spans that lie in no other span, so they take nothing away from what whole runs give.

Positions are code points, the end exclusive. Defined results: a null text counts as empty; an empty text
has no spans; repeated rows are scanned one by one; other columns are carried as they are or not looked at.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, and the stated patterns.
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = "[A-Za-z0-9+/_=-]"
WINDOW = 20
#: Bits per character from which a window counts, by class. No window of 20 characters has exactly these values.
THRESHOLDS = {"entropy_hex": 2.95, "entropy_base64": 3.85}
#: Candidates that are no secrets: UUIDs, dates and times, placeholders, sums of public packages, paths of words.
ALLOWED = [
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9-]*)?$",
    r"(?i)example|placeholder|changeme|dummy|sample|your[-_]",
    r"^(sha1|sha224|sha256|sha384|sha512)-",
    r"^/?([A-Za-z]+/)+[A-Za-z0-9_-]{1,19}$",
]
#: Path components that are placeholder words, and the pieces of a run between them and between signs.
_WORD = r"(?<![A-Za-z0-9+_-])(?i:(?:[a-z]+[_-])*(?:example|placeholder|changeme|dummy|sample|your[_-])[a-z_-]*)(?![A-Za-z0-9+_-])"
_PIECE = rf"{_WORD}|(?:(?!{_WORD})[A-Za-z0-9+/_-])+(?:=+$)?"
_DIGITS = "[0-9a-fA-F]+"


def _located(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None, extra: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, match); `keep` judges (match, extra)."""
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), match.alias("match"), (match if extra is None else extra).alias("extra"))
    kind = "array<struct<start:int,end:int,match:string>>"
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["gap"])
        b = a + F.coalesce(F.length(x["match"]), F.lit(0))
        found = F.array(F.struct(a.alias("start"), b.alias("end"), x["match"].alias("match")))
        wanted = x["match"].isNotNull() if keep is None else x["match"].isNotNull() & keep(x)
        return F.struct(b.alias("at"), F.when(wanted, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def _marked(spans: Column, kind: Column | str) -> Column:
    """Spans as (start, rank of the kind, end, kind), which sorts as the digests want it."""
    name = F.lit(kind) if isinstance(kind, str) else kind
    rank = F.array_position(F.array(*map(F.lit, KINDS)), name).cast("int")
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), name.alias("kind")))


def _hot(codes: Column, window: int, least: Column) -> Column:
    """(first, last) end positions of windows with at least `least` bits, from incremental counts; nulls without one."""
    weights = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    weight = lambda c: F.element_at(weights, c + 1)
    zero = F.array_repeat(F.lit(0), len(ALPHABET) + 1)
    start = F.struct(zero.alias("counts"), F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def step(acc: Column, i: Column) -> Column:
        entering = F.element_at(codes, i)
        leaving = F.when(i > window, F.element_at(codes, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(-1))
        had = F.element_at(acc["counts"], entering + 1)
        same = entering == leaving
        had_left = F.when(leaving >= 0, F.element_at(acc["counts"], F.greatest(leaving, F.lit(0)) + 1)).otherwise(F.lit(0))
        gained = weight(had + 1) - weight(had)
        lost = F.when(leaving >= 0, weight(had_left) - weight(F.greatest(had_left - 1, F.lit(0)))).otherwise(F.lit(0.0))
        total = F.when(same, acc["sum"]).otherwise(acc["sum"] + gained - lost)
        counts = F.when(same, acc["counts"]).otherwise(
            F.transform(acc["counts"], lambda c, k: c + (k == entering).cast("int") - (k == leaving).cast("int")))
        hot = (i >= window) & (F.lit(math.log2(window)) - total / window >= least)
        return F.struct(
            counts.alias("counts"), total.alias("sum"),
            F.when(hot & acc["first"].isNull(), i).otherwise(acc["first"]).alias("first"),
            F.when(hot, i).otherwise(acc["last"]).alias("last"))

    return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _entropy_spans(candidates: Column, window: int, thresholds: dict[str, float], allowed: list[str]) -> Column:
    """Hot stretches of the candidates that no allow-list pattern knows, as marked spans."""
    fit = F.filter(candidates, lambda c: c["match"].rlike("[0-9]") & c["match"].rlike("[A-Za-z]"))
    if allowed:
        fit = F.filter(fit, lambda c: ~functools.reduce(operator.or_, [c["match"].rlike(pattern) for pattern in allowed]))

    def judged(c: Column) -> Column:
        codes = F.transform(F.split(c["match"], ""), lambda x: F.instr(F.lit(ALPHABET), x))
        kind = F.when(c["match"].rlike("^[0-9a-fA-F]+$"), F.lit("entropy_hex")).otherwise(F.lit("entropy_base64"))
        least = F.when(kind == "entropy_hex", F.lit(thresholds["entropy_hex"])).otherwise(F.lit(thresholds["entropy_base64"]))
        rank = F.when(kind == "entropy_hex", F.lit(KINDS.index("entropy_hex") + 1)).otherwise(F.lit(KINDS.index("entropy_base64") + 1))
        hot = F.transform(F.array(codes), lambda x: _hot(x, window, least))[0]
        return F.transform(F.array(hot), lambda h: F.struct(
            (c["start"] + h["first"] - window).alias("start"), rank.alias("rank"), (c["start"] + h["last"]).alias("end"), kind.alias("kind")))[0]

    return F.filter(F.transform(fit, judged), lambda s: s["start"].isNotNull())


def _unlisted(candidates: Column, anchored: list[str]) -> Column:
    return F.filter(candidates, lambda c: ~functools.reduce(operator.or_, [c["match"].rlike(pattern) for pattern in anchored])) if anchored else candidates


def _parts(candidates: Column, window: int, anchored: list[str]) -> Column:
    """The pieces of runs, and shorter stretches of hexadecimal digits in them, of `window` characters or more."""

    def inner(whole: Column, pattern: str, keep: Callable[[Column, Column], Column]) -> Column:
        def placed(c: Column) -> Column:
            found = _located(c["match"], pattern, lambda x: (F.length(x["match"]) >= window) & keep(x["match"], c["match"]))
            return F.transform(found, lambda x: F.struct((c["start"] + x["start"]).alias("start"), (c["start"] + x["end"]).alias("end"), x["match"].alias("match")))

        return F.flatten(F.transform(whole, placed))

    pieces = _unlisted(inner(candidates, _PIECE, lambda x, whole: F.lit(True)), anchored)
    return F.concat(pieces, inner(pieces, _DIGITS, lambda x, whole: x != whole))


def _part_spans(candidates: Column, text: Column, window: int, thresholds: dict[str, float], allowed: list[str]) -> Column:
    """Hot stretches of parts that no anchored pattern knows, less those that another pattern finds something in."""
    anchored = [x for x in allowed if x.startswith("^")]
    spans = _entropy_spans(_parts(candidates, window, anchored), window, thresholds, anchored)
    loose = [x for x in allowed if not x.startswith("^")]
    if loose:
        hot = lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"])
        spans = F.filter(spans, lambda s: ~functools.reduce(operator.or_, [hot(s).rlike(pattern) for pattern in loose]))
    return F.array_distinct(spans)


def _outermost(spans: Column) -> Column:
    """Spans that lie in no other; of spans with equal ends, the first kind."""
    inside = lambda s, o: (o["start"] <= s["start"]) & (o["end"] >= s["end"]) & ((o["start"] < s["start"]) | (o["end"] > s["end"]) | (o["rank"] < s["rank"]))
    return F.filter(spans, lambda s: ~F.exists(spans, lambda o: inside(s, o)))


def with_spans(docs: DataFrame, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS, allowed: list[str] = ALLOWED) -> DataFrame:
    """Rows (row: a struct of all columns, text: never null, base, spans); base and spans are sorted arrays of
    (start, rank, end, kind)."""
    text = F.col("text")
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    long_run = rf"(?<!{_RUN}){_RUN}{{{window},}}+"
    entropy_run = rf"(?<!{_RUN})(?=[A-Za-z+/_=-]*+[0-9]){_RUN}{{{window}}}"

    def if_any(pattern: str, found: Column) -> Column:
        return F.when(text.rlike(pattern), found).otherwise(none)

    assign = _located(text, ASSIGN, lambda x: F.length(x["extra"]) >= LEAST["assign"], F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    access = _located(text, ACCESS, lambda x: F.length(x["match"]) >= LEAST["access"])
    # Runs are maximal, so shorter ones may be left out by the pattern itself.
    hexes = _located(text, f"[0-9a-f]{{{LEAST['hex']},}}")
    candidates = _located(text, long_run)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.select(
        "row", "text",
        if_any(ASSIGN, _marked(assign, "assign")).alias("assign"),
        F.when(F.instr(text, "AKIA") > 0, _marked(access, "access")).otherwise(none).alias("access"),
        if_any(f"[0-9a-f]{{{LEAST['hex']}}}", _marked(hexes, "hex")).alias("hex"),
        if_any(entropy_run, _entropy_spans(candidates, window, thresholds, allowed)).alias("entropy"),
        if_any(entropy_run, _part_spans(candidates, text, window, thresholds, allowed)).alias("parts"))
    rows = rows.select("row", "text", F.array_sort(F.concat("assign", "access", "hex")).alias("base"), "entropy", "parts")
    loose = F.filter("parts", lambda p: ~F.exists("entropy", lambda e: (e["start"] <= p["start"]) & (e["end"] >= p["end"])))
    rows = rows.select("row", "text", "base", F.when(F.size("parts") > 0, F.concat("entropy", _outermost(loose))).otherwise(F.col("entropy")).alias("entropy"))
    more = F.filter("entropy", lambda e: ~F.exists("base", lambda b: (b["start"] <= e["start"]) & (b["end"] >= e["end"])))
    return rows.select("row", "text", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def _digest(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans (kind:start:end, comma-joined)."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return with_spans(docs.select("doc_id", "text")).select(
        "row.doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        (F.size("spans") - F.size("base")).cast("long").alias("n_entropy"), F.sha2(_digest("base"), 256).alias("base_sha256"), _digest("spans").alias("spans"))


def redacted(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """The rows of `docs` with each stretch of overlapping or touching spans replaced by `mark`. Only `text` changes, and
    `n_chars` (code points) where there is such a column; rows without a span stay as they are."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        new = (s["start"] > acc["at"]) | (F.length(acc["out"]) == 0)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    rows = with_spans(docs).select("row", F.when(F.size("spans") > 0, clean).alias("clean"))
    names = docs.columns
    made = {"text": F.coalesce("clean", F.col("row")["text"]), "n_chars": F.when(F.col("clean").isNull(), F.col("row")["n_chars"]).otherwise(F.length("clean"))}
    if "n_chars" not in names:
        del made["n_chars"]
    return rows.select(*[made[c].cast(docs.schema[c].dataType).alias(c) if c in made else F.col("row")[c].alias(c) for c in names])
