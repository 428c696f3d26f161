"""Secret scan: pattern secrets plus sliding-window entropy over candidate strings.

Texts are scanned as UTF-8 bytes; every character that a pattern names is
ASCII, so byte matches are character matches, and offsets are turned into code
points only for texts with hits.  Runs of one character class are found with
numpy instead of a regular expression: a translate table marks the class, and
the gaps between unmarked bytes are the run lengths.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import map_rows, need_columns, struct_of

ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
#: Order of the kinds in span lists.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_lower", "entropy_upper")
BASE_KINDS = KINDS[:3]

HEX_LOWER = b"0123456789abcdef"
#: class -> (characters, window, bits of entropy that a window must reach, characters a run must mix)
CLASSES: dict[str, tuple[bytes, int, float, tuple[bytes, ...]]] = {
    "entropy_hex": (b"0123456789abcdefABCDEF", 20, 3.0, (b"0123456789", b"abcdefABCDEF")),
    "entropy_base64": (
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 20, 3.7,
        (b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ),
    # keys of one case (base32 and the like); what is hex alone is left to its own class
    "entropy_lower": (b"abcdefghijklmnopqrstuvwxyz0123456789", 20, 3.5, (b"0123456789", b"ghijklmnopqrstuvwxyz")),
    "entropy_upper": (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20, 3.5, (b"0123456789", b"GHIJKLMNOPQRSTUVWXYZ")),
}
#: Strings of high entropy that are no secrets: alphabets (as far as they go), digit runs, documentation keys, UUIDs.
#: Only windows that overlap one are spared, not all of the run around it.
ALLOWED = tuple(re.compile(p, re.IGNORECASE) for p in (
    rb"abcdefghijklmnop(?:qrstuvwxyz)?(?:0123456789)?|0123456789abcdef(?:ghijklmnopqrstuvwxyz)?|qwertyuiop|1234567890",
    rb"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
    rb"example|placeholder|changeme|lorem",
    rb"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
))


def _marks(chars: bytes) -> bytes:
    return bytes(1 if c in chars else 0 for c in range(256))


_HEX_MARKS = _marks(HEX_LOWER)
_CLASS_MARKS = {kind: _marks(spec[0]) for kind, spec in CLASSES.items()}


def runs(raw: bytes, marks: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of marked bytes that are at least ``least`` long."""
    other = np.flatnonzero(np.frombuffer(raw.translate(marks), np.uint8) == 0)
    ends = np.append(other, len(raw))
    starts = np.concatenate(([0], other + 1))
    for k in np.flatnonzero(ends - starts >= least):
        yield int(starts[k]), int(ends[k])


def entropy_spans(value: bytes, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged windows of ``value`` whose Shannon entropy is at least ``bits``.

    H = log2(w) - sum(c log2 c) / w; a step changes two counts, so the sum is
    kept up to date instead of being computed again.  A value that is shorter
    than the window has none.
    """
    if len(value) < window:
        return []
    plogp = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]  # a step adds before it removes
    counts = [0] * 256
    total = 0.0
    limit = (math.log2(window) - bits) * window + 1e-9
    spans: list[tuple[int, int]] = []
    for i, c in enumerate(value):
        total += plogp[counts[c] + 1] - plogp[counts[c]]
        counts[c] += 1
        if i >= window:
            old = value[i - window]
            total += plogp[counts[old] - 1] - plogp[counts[old]]
            counts[old] -= 1
        if i >= window - 1 and total <= limit:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(raw: bytes) -> list[tuple[str, int, int]]:
    found = []
    folded = raw.lower()
    if any(w in folded for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(raw) if len(m[2]) >= ASSIGN_MIN]
    if b"AKIA" in raw:
        found += [("access", *m.span()) for m in ACCESS.finditer(raw) if len(m[0]) >= ACCESS_MIN]
    found += [("hex", a, b) for a, b in runs(raw, _HEX_MARKS, HEX_MIN)]
    return found


def not_allowed(value: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of the parts of ``value`` between its allowed strings."""
    at = 0
    for start, end in sorted(m.span() for p in ALLOWED for m in p.finditer(value)):
        if start > at:
            yield at, start
        at = max(at, end)
    if at < len(value):
        yield at, len(value)


def high_entropy(raw: bytes) -> list[tuple[str, int, int]]:
    found = []
    for kind, (_, window, bits, mixed) in CLASSES.items():
        for a, b in runs(raw, _CLASS_MARKS[kind], window):
            value = raw[a:b]
            if any(len(value.translate(None, chars)) == len(value) for chars in mixed):
                continue
            for start, end in not_allowed(value):
                spans = entropy_spans(value[start:end], window, bits)
                found += [(kind, a + start + s, a + start + e) for s, e in spans]
    return found


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end) in code points, by start, then kind as in ``KINDS``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = base_spans(raw) + high_entropy(raw)
    if found and len(raw) != len(text):
        lead = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80
        at = np.concatenate(([0], np.cumsum(lead)))
        found = [(k, int(at[a]), int(at[b])) for k, a, b in found]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``spans`` (kind, start, end), their digest and joined form.

    A null or empty text has no spans.  Repeated rows and null ids get a row
    each; an empty table gives an empty one; other columns are ignored.
    Overlapping spans of different kinds are all reported.
    """
    need_columns(docs, id_col, text_col)

    def scanned(texts: list[str | None]) -> list[tuple]:
        rows = []
        for text in texts:
            spans = scan(text)
            base = joined([s for s in spans if s[0] in BASE_KINDS])
            rows.append((
                [{"kind": k, "start": a, "end": b} for k, a, b in spans],
                hashlib.sha256(base.encode()).hexdigest(), joined(spans),
            ))
        return rows

    span = struct_of(kind=pa.string(), start=pa.int32(), end=pa.int32())
    fields = {"spans": pa.list_(span), "base_sha256": pa.string(), "joined": pa.string()}
    return map_rows(docs, {"doc_id": F.col(id_col)}, [F.col(text_col)], fields, scanned)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span of its text replaced by ``mark`` (null stays null)."""
    need_columns(docs, text_col)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            spans, end = scan(text), 0
            if spans:
                parts = []
                for _, a, b in spans:
                    if b <= end:
                        continue
                    if a >= end:
                        parts += [text[end:a], mark]
                    end = b
                text = "".join(parts) + text[end:]
            out.append(text)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, cleaned(F.col(text_col)))
