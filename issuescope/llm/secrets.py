"""Secrets in texts: three fixed patterns, and windows of high entropy.

Candidate strings are runs of ``CANDIDATE_BYTES``.  Within a candidate every maximal run of a character class is walked
by a window of the class's width, whose Shannon entropy follows from counts that change by one byte in and one byte
out.  Windows at or above the class's threshold that mix letters and digits are joined into spans.  Candidates that
match an allow-list pattern are suppressed, and spans inside one of the fixed patterns' spans add nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import quoted
from .common import map_batches

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ASSIGN_LEAST = 12
#: A text without any of these, in lower case, has no match of ``ASSIGN``.
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
# A run is taken whole, so asking for its least length here finds what dropping short matches afterwards leaves.
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX_LEAST = 16

CANDIDATE_LEAST = 20


@dataclass(frozen=True)
class CharClass:
    """Characters, the width of the window over their runs, and the entropy in bits from which a window counts."""

    name: str
    chars: bytes
    width: int
    bits: float
    letters: int = 3
    digits: int = 3


_DIGITS = b"0123456789"
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_ALNUM = _DIGITS + _LOWER + _LOWER.upper()
CLASSES = (
    CharClass("hex", _DIGITS + b"abcdefABCDEF", 20, 3.0),
    CharClass("alnum", _ALNUM, 20, 3.7),
    CharClass("base64", _ALNUM + b"+/_=-", 24, 4.0),
)
CANDIDATE_BYTES = CLASSES[-1].chars

#: Candidates that are no secrets though their entropy is high; each must match a whole candidate.
ALLOW = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUIDs
    r"[-+/_=]*([A-Za-z]+|[0-9]+)([-+/_=]+([A-Za-z]+|[0-9]+))*[-+/_=]*",  # paths and names of whole words and numbers
    r"[A-Za-z]+[0-9]{1,4}",  # a word with a number or a year behind it
    r"(0123456789|[aA]bcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ|[+/_=-])+",  # alphabets
)

# The entropy of w characters with counts c is log2(w) - sum(c * log2(c)) / w.  The terms are scaled to whole numbers,
# so that adding and subtracting them leaves no rounding behind.
_SCALE = 1 << 40
_MOST_WIDTH = 256
_TERM = [0, *(round(c * log2(c) * _SCALE) for c in range(1, _MOST_WIDTH + 1))]


def _lut(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


_CANDIDATE, _HEX, _DIGIT = _lut(CANDIDATE_BYTES), _lut(_DIGITS + b"abcdef"), _lut(_DIGITS)


def entropy_windows(run: bytes, kind: CharClass) -> list[tuple[int, int]]:
    """The joined (start, end) of the windows of a run of class characters that count."""
    width = kind.width
    if len(run) < width:
        return []
    limit = round(width * (log2(width) - kind.bits) * _SCALE)
    counts = [0] * 256
    total = letters = digits = 0
    spans: list[tuple[int, int]] = []
    for i, new in enumerate(run):
        n = counts[new] = counts[new] + 1
        total += _TERM[n] - _TERM[n - 1]
        digits += _DIGIT_OF[new]
        letters += _LETTER_OF[new]
        if i >= width:
            old = run[i - width]
            n = counts[old] = counts[old] - 1
            total += _TERM[n] - _TERM[n + 1]
            digits -= _DIGIT_OF[old]
            letters -= _LETTER_OF[old]
        if i >= width - 1 and total <= limit and letters >= kind.letters and digits >= kind.digits:
            start = i - width + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


_DIGIT_OF = [int(chr(b) in "0123456789") for b in range(256)]
_LETTER_OF = [int(b < 128 and chr(b).isalpha()) for b in range(256)]


def joined(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _runs(mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of set places that are long enough."""
    edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def _boundary_free(text: bytes, data: np.ndarray, allow: re.Pattern | None, classes: Sequence[CharClass]):
    """The entropy spans of a text, in bytes."""
    spans: list[tuple[int, int]] = []
    for start, end in _runs(_CANDIDATE[data], CANDIDATE_LEAST):
        if np.count_nonzero(_DIGIT[data[start:end]]) < min(c.digits for c in classes):
            continue
        candidate = text[start:end]
        if allow is not None and allow.fullmatch(candidate):
            continue
        for kind in classes:
            for a, b in _runs(_lut(kind.chars)[data[start:end]], kind.width):
                found = entropy_windows(candidate[a:b], kind)
                spans += [(start + a + s, start + a + e) for s, e in found]
    return joined(spans)


def secret_spans(
    text: bytes, allow: re.Pattern | None, classes: Sequence[CharClass] = CLASSES
) -> list[tuple[str, int, int]]:
    """(kind, start, end) of one UTF-8 text, in code points, by start and then kind."""
    lowered = text.lower()
    found: list[tuple[int, int, int]] = []
    if any(hint in lowered for hint in ASSIGN_HINTS):
        found += [
            (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST
        ]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    data = np.frombuffer(text, np.uint8)
    found += [(start, 2, end) for start, end in _runs(_HEX[data], HEX_LEAST)]
    base = [(start, end) for start, _, end in found]
    found += [
        (start, 3, end)
        for start, end in _boundary_free(text, data, allow, classes)
        if not any(s <= start and end <= e for s, e in base)
    ]
    if not found:
        return []
    found.sort()
    # Bytes that go on with a code point do not begin one.
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    places = np.searchsorted(begins, np.array([(start, end) for start, _, end in found])).tolist()
    return [(KINDS[kind], *place) for (_, kind, _), place in zip(found, places, strict=True)]


def _allow_pattern(allow: Sequence[str]) -> re.Pattern | None:
    return re.compile("|".join(f"(?:{p})" for p in allow).encode(), re.ASCII) if allow else None


def scan_secrets(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    allow: Sequence[str] = ALLOW,
    classes: Sequence[CharClass] = CLASSES,
) -> DataFrame:
    """The ``keep`` columns of every row and ``spans``: array<struct<kind, start, end>> by start, then kind.

    Kinds ``assign``, ``access`` and ``hex`` are the matches of the fixed patterns, leftmost and without overlap per
    kind; ``entropy`` is what the windows add.  Places are code points, the end is exclusive.  A null or empty
    text has no spans; texts of any length are read whole.  Repeated rows and ids give a row each, other
    columns, whatever their names, are not read, and an empty table gives an empty one.  Needs no shuffle.
    """
    if any(kind.width > _MOST_WIDTH for kind in classes):
        raise ValueError(f"windows hold at most {_MOST_WIDTH} characters")
    named = [f"kept_{i}" for i in range(len(keep))]
    source = df.select(
        *[quoted(c).alias(n) for c, n in zip(keep, named, strict=True)], quoted(text).cast("binary").alias("body")
    )
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    patterns = list(allow)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _allow_pattern(patterns)
        for batch in batches:
            found = []
            for body in batch.column("body"):
                raw = body.as_py()
                rows = secret_spans(raw, pattern, classes) if raw else []
                found.append([{"kind": k, "start": s, "end": e} for k, s, e in rows])
            columns = [batch.column(n) for n in named]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, spans)], names=[*named, "spans"])

    kept = "".join(f"{n} {source.schema[n].dataType.simpleString()}, " for n in named)
    scanned = map_batches(source, scan, kept + "spans array<struct<kind: string, start: int, end: int>>")
    return scanned.select(*[F.col(n).alias(c) for c, n in zip(keep, named, strict=True)], "spans")


def span_list(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    """kind:start:end of the spans of these kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
