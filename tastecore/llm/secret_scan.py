"""Secret scan: fixed patterns, and windows of high Shannon entropy over candidate strings.

Kinds, in this order: `assign` (a value given to a name such as password or token), `access`
(access key ids), `hex` (long lower-case hex strings), and `entropy`: a candidate is a run of token
characters; over each of its runs of one character class a window slides whose character counts
are updated by one step in and one step out, and windows at or above the class's entropy are
joined into spans. The allow list silences what it names and nothing beside it: whole candidates such as UUIDs, and parts
of others, such as a host name or a file's ending; pattern spans always stay.

Edge cases: a null text is an empty one and has no spans; each repeated row is answered; texts are
scanned whole, whatever their length; null ids are passed on. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from tastecore.llm.batches import map_arrow, map_slices, slices, small_batches, text_of

# The three patterns and their least lengths.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is the same as a run, dropped if shorter
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
ASSIGN_HINTS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{20,}")
#: Character class, window length, least bits per character, and a sign that has to make up some of a window, but not all.
CLASSES = (
    (re.compile(r"[0-9a-fA-F]{20,}"), 20, 2.9, str.isdigit, 2),
    (re.compile(r"[A-Za-z0-9]{20,}"), 20, 3.6, str.isdigit, 2),
    (re.compile(r"[A-Za-z0-9+/_=-]{24,}"), 24, 3.9, str.isdigit, 2),
    (re.compile(r"[A-Za-z]{32,}"), 32, 4.2, str.isupper, 9),
)
#: Whole candidates that are no secrets: UUIDs, dates and versions.
ALLOWED = (re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"), re.compile(r"[0-9.+/_=-]+"))
#: Parts of candidates that are no secrets: host names, endings of files, rulers, fillers and counters.
ALLOWED_PART = re.compile(
    r"(?i:(?<![a-z0-9-])(?:[a-z0-9-]{1,30}\.)+(?:com|org|net)(?![a-z0-9])|\.(?:html?|txt|pdf|png|jpe?g|py|js|json)(?![a-z0-9])"
    r"|(?:https?|www)[./]|example|placeholder|changeme|x{4,}|abcdefghij[a-z]*|0123456789|a1b2c3[a-z0-9]*)"
)

Span = tuple[int, int, int]  # start, kind, end


def _windows(text: str, width: int, least: float, sign=str.isdigit, some: int = 2) -> Iterator[tuple[int, int]]:
    """Joined windows of `text` whose entropy is at least `least`, with `some` characters or more that are a `sign`, and that aren't."""
    counts: Counter[str] = Counter()
    weight = signs = 0
    begin = end = -1
    log = [0.0] + [n * math.log2(n) for n in range(1, width + 1)]
    total = 0.0  # sum of n * log2(n) over the character counts
    for place, new in enumerate(text):
        total += log[counts[new] + 1] - log[counts[new]] if counts[new] < width else 0.0
        counts[new] += 1
        signs += sign(new)
        weight += 1
        if weight > width:
            old = text[place - width]
            total -= log[counts[old]] - log[counts[old] - 1] if counts[old] <= width else 0.0
            counts[old] -= 1
            signs -= sign(old)
            weight -= 1
        if weight == width and some <= signs <= width - some and math.log2(width) - total / width >= least:
            start = place - width + 1
            if begin >= 0 and start > end:
                yield begin, end
                begin = -1
            begin, end = (start if begin < 0 else begin), place + 1
    if begin >= 0:
        yield begin, end


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    lowered = text.lower()
    if any(h in lowered for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def entropy_spans(text: str, taken: Sequence[Span] = ()) -> list[Span]:
    """Spans of high entropy that no span in `taken` covers."""
    found: list[tuple[int, int]] = []
    for candidate in CANDIDATE.finditer(text):
        string = candidate[0]
        if any(p.fullmatch(string) for p in ALLOWED):
            continue
        string = ALLOWED_PART.sub(lambda m: "." * len(m[0]), string)
        for runs, width, least, sign, some in CLASSES:
            for run in runs.finditer(string):
                shift = candidate.start() + run.start()
                found += [(shift + a, shift + b) for a, b in _windows(run[0], width, least, sign, some)]
    joined: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return [(a, 3, b) for a, b in joined if not any(s <= a and b <= e for s, _, e in taken)]


def spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Pattern spans, and all spans; both by start, then kind."""
    base = base_spans(text or "")
    return base, sorted(base + entropy_spans(text or "", base))


def _written(found: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts per pattern, sha256 of the pattern spans, all spans, number of entropy spans."""

    def run(ids: list, texts: list) -> dict[str, object]:
        both = [spans(t) for t in texts]
        count = lambda kind: [sum(k == kind for _, k, _ in every) for _, every in both]
        return {
            "doc_id": ids,
            **{f"n_{name}": count(kind) for kind, name in enumerate(KINDS)},
            "base_sha256": [hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in both],
            "spans": [_written(every) for _, every in both],
        }

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"
    return map_slices(text_of(docs), ["doc_id", "text"], run, schema)


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones as one, replaced by the mark."""
    if text is None:
        return None
    parts: list[str] = []
    at = 0
    for start, _, end in spans(text)[1]:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows of `docs` with secrets replaced in `text`; n_chars, if there, follows the new text."""
    small_batches(docs)
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            columns = dict(zip(names, part.columns))
            texts = [redacted(t) for t in columns["text"].to_pylist()]
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                old = columns["n_chars"]
                lengths = [n if t is None else len(t) for t, n in zip(texts, old.to_pylist())]
                columns["n_chars"] = pa.array(lengths, old.type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

    return map_arrow(docs, run, schema)
