"""Secrets in texts: three fixed patterns, and strings of high entropy.

``find_secrets`` scans whole texts in one pass of Arrow batches, without a shuffle.
Strings of at least ``WINDOW`` key characters are candidates. Over each candidate a
window slides; the counts of its characters are changed by one entering and one leaving
character, so the window's Shannon entropy costs the same at every place. Windows above
the threshold of their character class join to spans of kind ``entropy``. Windows that
overlap a match of the allow-list or a span of a fixed pattern do not count; the windows
beside it do.

A NULL text counts as empty: no span. Repeated rows give repeated results. Positions
are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import batch, map_batches

ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
    r"(?P<value>[A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")

#: Character classes of windows, narrowest first: members and bits per character needed.
CLASSES = (
    ("digits", re.compile(r"[0-9]"), math.inf),
    ("hex", re.compile(r"[0-9a-fA-F]"), 3.0),
    ("base32", re.compile(r"[A-Z2-7=]"), 3.5),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]"), 3.75),
)
#: Digits that a window of a class other than digits must hold: prose has none.
LEAST_DIGITS = 2

#: Strings that look random and are known to be harmless.
ALLOWED = (
    re.compile(r"(?i)\b[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\b"),
    re.compile(r"(?i)example|sample|placeholder|changeme|redacted"),
    re.compile(r"(?i)abcdefgh|01234567|12345678"),
    re.compile(r"//|/(?:[A-Za-z]+/){2,}"),
)

SCHEMA = (
    "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, "
    "spans array<struct<kind:string,start:int,end:int>>"
)


def _class_table() -> tuple[list[int], list[float]]:
    """For each ASCII code the classes it belongs to, as bits; the classes' thresholds."""
    bits = [
        sum(1 << k for k, (_, members, _) in enumerate(CLASSES) if members.match(chr(code)))
        for code in range(128)
    ]
    return bits, [threshold for _, _, threshold in CLASSES]


_BITS, _THRESHOLDS = _class_table()
#: n log n, also for the moment at which the window holds one character more.
_NLOGN = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 2)]


def entropy_windows(candidate: str) -> list[tuple[int, int]]:
    """Joined windows of ``candidate`` whose entropy passes their class's threshold."""
    counts = [0] * 128
    outside = [0] * len(CLASSES)
    digits, weighted = 0, 0.0
    spans: list[tuple[int, int]] = []
    codes = [ord(c) for c in candidate]
    for i, code in enumerate(codes):
        n = counts[code]
        weighted += _NLOGN[n + 1] - _NLOGN[n]
        counts[code] = n + 1
        digits += 48 <= code <= 57
        for k in range(len(CLASSES)):
            outside[k] += not _BITS[code] >> k & 1
        if i >= WINDOW:
            old = codes[i - WINDOW]
            n = counts[old]
            weighted += _NLOGN[n - 1] - _NLOGN[n]
            counts[old] = n - 1
            digits -= 48 <= old <= 57
            for k in range(len(CLASSES)):
                outside[k] -= not _BITS[old] >> k & 1
        if i >= WINDOW - 1 and digits >= LEAST_DIGITS:
            kind = outside.index(0)
            if math.log2(WINDOW) - weighted / WINDOW >= _THRESHOLDS[kind]:
                start = i - WINDOW + 1
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((start, i + 1))
    return spans


def between(start: int, end: int, cuts: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Parts of a range outside of all cuts in which a window has room."""
    for low, high in sorted(cuts):
        if low - start >= WINDOW:
            yield start, low
        start = max(start, high)
    if end - start >= WINDOW:
        yield start, end


def scan(text: str) -> list[tuple[int, int, int]]:
    """Spans of one text as (start, index of the kind, end), in order."""
    found: list[tuple[int, int, int]] = []
    if ":" in text or "=" in text:
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end("value") - m.start("value") >= 6
        ]
    candidates = list(CANDIDATE.finditer(text))
    # Keys and hexadecimal runs of these lengths lie inside candidates.
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        for c in candidates:
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text, c.start(), c.end())]
    base = sorted((start, end) for start, _, end in found)
    at = 0
    for c in candidates:
        while at < len(base) and base[at][1] <= c.start():
            at += 1
        cuts = [m.span() for pattern in ALLOWED for m in pattern.finditer(c.group())]
        cuts = [(a + c.start(), b + c.start()) for a, b in cuts]
        here = at
        while here < len(base) and base[here][0] < c.end():
            cuts.append(base[here])
            here += 1
        for low, high in between(c.start(), c.end(), cuts):
            found += [(a + low, 3, b + low) for a, b in entropy_windows(text[low:high])]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of each kind, the digest of the fixed patterns' spans, and all spans."""
    kind = frame.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            columns: dict[str, list] = {f"n_{name}": [] for name in KINDS}
            columns |= {"base_sha256": [], "spans": []}
            for value in rows.column(1):
                spans = scan(value.as_py() or "")
                for k, name in enumerate(KINDS):
                    columns[f"n_{name}"].append(sum(s[1] == k for s in spans))
                base = joined([s for s in spans if s[1] < 3])
                columns["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                columns["spans"].append(
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
                )
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *batch(columns, _arrow_schema()).columns],
                names=[key, *_arrow_schema().names],
            )

    return map_batches(frame.select(key, text), run, f"`{key}` {kind}, {SCHEMA}")


def _arrow_schema() -> pa.Schema:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.schema(
        [(f"n_{name}", pa.int64()) for name in KINDS]
        + [("base_sha256", pa.string()), ("spans", pa.list_(span))]
    )


def redact(frame: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """Every row with its spans replaced by ``[kind]``; the length follows the text.

    Rows without a span are passed through as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, lengths = [], []
            at = rows.schema.names
            for value, n in zip(
                rows.column(at.index(text)).to_pylist(),
                rows.column(at.index(length)).to_pylist(),
                strict=True,
            ):
                changed = redacted(value) if value else value
                texts.append(changed)
                lengths.append(n if changed == value else len(changed))
            out = list(rows.columns)
            out[at.index(text)] = pa.array(texts, pa.string())
            out[at.index(length)] = pa.array(lengths, rows.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(out, names=at)

    return map_batches(frame, run, frame.schema)


def redacted(text: str) -> str:
    parts, at = [], 0
    for start, kind, end in scan(text):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def spans_text(spans: str = "spans"):
    """The spans as ``kind:start:end`` joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
