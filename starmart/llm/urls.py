"""URL filters by a bit-parallel wildcard automaton: glob rules packed into multiword Shift-And masks.

A glob is text with `*` (any run, also none) and `?` (any one character). Every character of every glob is one bit of a
state row of 64-bit words; one step of the automaton shifts the whole row, adds the first bits, masks with the next
character's positions and keeps the bits before a `*`. All globs run at once over each URL, and all URLs of a batch
run side by side. Work is (longest URL) x (words of the state row) array operations per batch.

Rules name a host and a path. They are run over the canonical form `.host` + NUL + `path`: the dot makes a host
match itself and its subdomains only, NUL (which stands for the end of the host) cannot be crossed by chance because
NUL characters in a URL are first replaced. Of the rules that fit, the longest decides; a URL that no rule fits gets
the verdict of the method's own globs.

Defined results: a null URL or one without `://` has an empty host and path, fits no rule and is allowed; repeated
rows are judged one by one; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.words import slices

#: The stated rules, (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: The method's own globs over the canonical form (\0 between host and path), for URLs that no rule fits.
BLOCKED = [
    ".ads.*", ".ads-*", ".ad.*", ".ad-*", ".adserver.*", ".track.*", ".tracker.*", ".tracking.*", ".doubleclick.*", ".adult-*", ".free-bets.*", "*.casino.*", "*.xxx\0*", "*.porn.*",
    "*\0*/ads/*", "*\0*/adserver/*", "*\0*/banner?/*", "*\0*/banners/*", "*\0*/tracking/*", "*\0*/casino/*", "*\0*/wp-admin/*", "*\0*/cgi-bin/*",
    "*\0*.exe", "*\0*.apk", "*\0*.zip", "*\0*.torrent",
]


@dataclass
class Automaton:
    """Masks of all globs, in `words` 64-bit words. Bytes stand for characters: `?` takes one whole UTF-8 character."""

    globs: list[str]

    def __post_init__(self) -> None:
        chars: list[tuple[int, object, bool, bool]] = []  # (glob, byte or kind, first, star after)
        self.anywhere = [g for g, glob in enumerate(self.globs) if glob and not glob.strip("*")]
        self.only_empty = [g for g, glob in enumerate(self.globs) if not glob]
        anchored, floating, last = [], [], {}
        for g, glob in enumerate(self.globs):
            if not glob.strip("*"):
                continue
            parts: list[tuple[object, bool]] = []
            for c in glob:
                if c == "*":
                    if parts:
                        parts[-1] = parts[-1][0], True
                elif c == "?":
                    parts.append((None, False))
                else:
                    parts += [(b, False) for b in c.encode()]
            (floating if glob[0] == "*" else anchored).append(len(chars))
            chars += [(g, c, k == 0, star) for k, (c, star) in enumerate(parts)]
            last[g] = len(chars) - 1
        self.last, n = last, len(chars)
        self.words = max(1, -(-n // 64))

        def mask(bits) -> np.ndarray:
            row = np.zeros(self.words, np.uint64)
            for b in bits:
                row[b // 64] |= np.uint64(1) << np.uint64(b % 64)
            return row

        tail = range(0x80, 0xC0)  # bytes after the first of a character
        self.step = np.stack([mask(k for k, (_, c, _, _) in enumerate(chars) if c == byte or c is None and byte not in tail) for byte in range(256)])
        wild = mask(k for k, (_, c, _, _) in enumerate(chars) if c is None)
        star = mask(k for k, (_, _, _, s) in enumerate(chars) if s)
        # A bit stays set on a star; on the later bytes of a character that `?` has taken, it waits there.
        self.stay = np.stack([star | wild if byte in tail else star for byte in range(256)])
        self.inner = ~mask(k for k, (_, _, first, _) in enumerate(chars) if first)
        self.always, self.once = mask(floating), mask(anchored)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text of the slice and each glob, whether the glob fits the whole text."""
        n = np.diff(offsets)
        order = np.argsort(-n, kind="stable")
        begin, n = offsets[:-1][order], n[order]
        state = np.zeros((len(n), self.words), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        for i in range(int(n[0]) if len(n) else 0):
            live = int(np.searchsorted(-n, -i, "left"))  # texts longer than i
            now, byte = state[:live], data[begin[:live] + i]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved = (moved & self.inner) | self.always | (self.once if i == 0 else np.uint64(0))
            state[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        found = np.zeros((len(n), len(self.globs)), bool)
        for g, bit in self.last.items():
            found[order, g] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one == one
        found[:, self.anywhere] = True
        found[np.ix_(order[n == 0], self.only_empty)] = True
        return found


def host_and_path(url: str):
    """Host (A-Z lower-cased) and path of the URL column named `url`; both empty for null and for a URL without `://`."""
    rest = F.expr(f"case when instr(`{url}`, '://') > 0 then substring(`{url}`, instr(`{url}`, '://') + 3) else '' end")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_glob(host: str, path: str) -> str:
    return f"*.{host}\0{path}*"


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, blocked: list[str] = BLOCKED) -> DataFrame:
    """One row per page row: page_id, host, path, rule (host + path of the deciding rule, else null), verdict."""
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    automaton = Automaton([rule_glob(host, path) for _, host, path in longest_first] + blocked)
    names = [host + path for _, host, path in longest_first]
    said = [verdict for verdict, _, _ in longest_first]
    canonical = F.concat(F.lit("."), F.translate("host", "\0", "�"), F.lit("\0"), F.translate("path", "\0", "�"))
    host, path = host_and_path("url")
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path")).withColumn("canonical", canonical)
    schema = T.StructType([pages.schema["page_id"], *(T.StructField(x, T.StringType()) for x in ("host", "path", "rule", "verdict"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("canonical")):
                found = automaton.matches(data, offsets)
                ruled, bad = found[:, : len(names)], found[:, len(names) :].any(axis=1)
                first = np.where(ruled.any(axis=1), ruled.argmax(axis=1), -1).tolist()
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(x).slice(a, b - a) for x in ("page_id", "host", "path")),
                    pa.array([names[k] if k >= 0 else None for k in first], pa.string()),
                    pa.array([said[k] if k >= 0 else "block" if x else "allow" for k, x in zip(first, bad.tolist(), strict=True)], pa.string()),
                ], names=schema.names)

    return rows.mapInArrow(run, schema)
