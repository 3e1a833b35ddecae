"""Search for secrets in whole texts: fixed patterns, and windows of high entropy in candidate strings.

Candidates are runs of at least ``MIN_RUN`` letters, digits and ``+ / = _ -``. In each, the longest stretches of every class of characters (hex
digits, letters and digits, base64) are looked at, so that a key glued to a name or path is held to its own class. A window slides over a stretch and
keeps the counts of its characters, of which one goes up and one goes down a step, so that the sum behind the entropy changes by two terms. A
stretch shorter than its class's window is one window. Windows at or above the class's threshold are joined to spans; a span within one of a
narrower class is left out. An allow list suppresses what is known to be harmless, in whole runs and in stretches: words without digits, UUIDs,
dashed words with short numbers, runs of one alphabet in order.

A null or empty text has no spans. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

# The base patterns, with the length that a match (or its second group) must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_MIN, ACCESS_MIN = 8, 16
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")

# Window and bits per character by class: a fair draw from 16, 62 and 64 symbols gives about 3.3, 4.1 and 4.1 over 20 to 24.
WINDOW = {"hex": 24, "alnum": 20, "base64": 20}
THRESHOLD = {"hex": 3.0, "alnum": 3.7, "base64": 3.8}
MIN_RUN = min(WINDOW.values())
RUN = re.compile(r"[A-Za-z0-9+/=_-]{%d,}" % MIN_RUN)
# Stretches of the narrower classes within a run, the narrowest first.
WITHIN = {"hex": re.compile(r"[0-9a-fA-F]{%d,}" % MIN_RUN), "alnum": re.compile(r"[A-Za-z0-9]{%d,}" % MIN_RUN)}
# A word (small, capital, camel case) with at most four digits behind it, or a number.
_WORD = r"(?:(?:[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]+)[0-9]{0,4}|[0-9]+)"
ALLOWED = [
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"[^0-9]*"),
    re.compile(r"[0-9+/=_-]*"),
    re.compile(rf"[A-Za-z]+([-_/](?=[A-Za-z0-9]{{1,12}}(?![A-Za-z0-9])){_WORD})+"),
    re.compile(r"(.{1,4})\1+.{0,3}"),
]
ORDERED = ("0123456789abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")


def _terms(window: int) -> list[float]:
    return [0.0, *(c * math.log2(c) for c in range(1, window + 2))]


TERMS = {w: _terms(w) for w in range(MIN_RUN, max(WINDOW.values()) + 1)}


def char_class(run: str) -> str:
    if all(c in "0123456789abcdefABCDEF" for c in run):
        return "hex"
    return "alnum" if run.isalnum() else "base64"


def allowed(run: str) -> bool:
    return any(p.fullmatch(run) for p in ALLOWED) or any(run in order for order in ORDERED)


def entropy_spans(run: str, window: int, threshold: float) -> list[tuple[int, int]]:
    """Unions of the windows whose Shannon entropy reaches ``threshold``, by incremental counts."""
    terms, counts, total, spans = TERMS[window], {}, 0.0, []
    full = math.log2(window)
    for at, letter in enumerate(run):
        count = counts.get(letter, 0)
        total += terms[count + 1] - terms[count]
        counts[letter] = count + 1
        if at >= window:
            gone = run[at - window]
            count = counts[gone]
            total += terms[count - 1] - terms[count]
            counts[gone] = count - 1
        if at >= window - 1 and full - total / window >= threshold - 1e-9:
            start = at - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((start, at + 1))
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    found += [("hex", *m.span()) for m in HEX.finditer(text)] if len(text) >= 32 else []
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def method_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    if len(text) < MIN_RUN:
        return found
    for match in RUN.finditer(text):
        run = match[0]
        if not allowed(run):
            found += [(f"entropy_{kind}", match.start() + a, match.start() + b) for kind, a, b in run_spans(run)]
    return found


def run_spans(run: str) -> list[tuple[str, int, int]]:
    """Class, start and end of what windows mark in a run, the narrowest class first."""
    found, whole = [], char_class(run)
    narrower = list(WITHIN)[: KINDS.index(f"entropy_{whole}") - KINDS.index("entropy_hex")]
    parts = [(kind, m.start(), m[0]) for kind in narrower for m in WITHIN[kind].finditer(run)]
    for kind, start, part in [*parts, (whole, 0, run)]:
        # A stretch that is all of a narrower class has been looked at as such.
        if part is not run and (char_class(part) != kind or allowed(part)):
            continue
        for a, b in entropy_spans(part, min(WINDOW[kind], len(part)), THRESHOLD[kind]):
            if not any(low <= start + a and start + b <= high for _, low, high in found):
                found.append((kind, start + a, start + b))
    return found


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_secrets(documents: DataFrame) -> DataFrame:
    """``doc_id, base_spans, spans``: spans as ``kind:start:end`` by start, then kind, comma-joined, for every row."""
    kind = dict(documents.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> dict:
        base, every = [], []
        for text in batch.column(1).to_pylist():
            own = base_spans(text or "")
            base.append(_joined(own))
            every.append(_joined(sorted(own + method_spans(text or ""), key=lambda s: (s[1], KINDS.index(s[0])))))
        return {"doc_id": batch.column(0), "base_spans": pa.array(base, pa.string()), "spans": pa.array(every, pa.string())}

    return map_batches(documents.select("doc_id", "text"), run, f"doc_id {kind}, base_spans string, spans string")


def redact(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``documents`` with every span replaced by ``mark``; a null text stays null."""
    at = documents.columns.index("text")

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                if text:
                    parts, last = [], 0
                    for _, start, end in sorted(base_spans(text) + method_spans(text), key=lambda s: (s[1], -s[2])):
                        if start >= last:
                            parts += [text[last:start], mark]
                        last = max(last, end)
                    text = "".join([*parts, text[last:]])
                out.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return documents.mapInArrow(run, documents.schema)


def span_counts(found: DataFrame) -> DataFrame:
    """``found`` with the number of base spans of each kind."""
    parts = F.when(F.col("base_spans") == "", F.array().cast("array<string>")).otherwise(F.split("base_spans", ","))
    counts = [F.size(F.filter(parts, _starts(f"{k}:"))).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, "base_spans", "spans")


def _starts(text: str):
    return lambda span: span.startswith(text)
