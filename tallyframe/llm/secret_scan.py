"""Secret scans with multipart credential linking.

Strong patterns are reported wherever they stand. Weak parts - identifiers, secrets without a name, endpoints - say little alone: the
parts of a document are joined by interval (the scope: at most ``reach`` code points between two parts, no blank line between them),
and a weak part is reported only if its scope holds a part that complements it: an identifier or an endpoint for a secret, a secret
for an identifier or an endpoint. The join sweeps over the parts in order of their place, so it is linear in their number.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm.shared import over_batches, picked

# The strong patterns. Letters of the names in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("passw", "secret", "token", "apikey", "api_key")

# Weak parts, of any length; a host name has at most 253 characters.
IDENTIFIER = re.compile(r"""(?<![A-Za-z0-9])(?:A(?:SIA|IDA|ROA|GPA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?:client_id|access_key_id|username|login)["']?\x20{0,8}[:=]\x20{0,8}["']?[A-Za-z0-9_.@-]{3,})""", re.A)
SECRET = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])", re.A)
ENDPOINT = re.compile(r"(?<![A-Za-z0-9])(?:(?:https?|jdbc:[a-z]+|mongodb|postgres(?:ql)?|mysql|redis|amqp)://[^\s\"'<>]{4,}|[a-z0-9.-]{1,239}\.amazonaws\.com)", re.A)
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
# Which parts complement a weak part. Of the strong ones an access id is an identifier, an assignment and a hexadecimal key are secrets.
COMPLEMENTS = {"identifier": {"assign", "hex", "secret"}, "secret": {"access", "identifier", "endpoint"}, "endpoint": {"assign", "hex", "secret"}}
Span = tuple[str, int, int]


def strong(text: str) -> list[Span]:
    """The leftmost, non-overlapping matches of each strong kind that are long enough."""
    found: list[Span] = []
    if any(name in (low := text.lower()) for name in NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def mixed(word: str) -> bool:
    """Upper case, lower case and digits in a word, as in a random key."""
    return any(c.isdigit() for c in word) and any(c.isupper() for c in word) and any(c.islower() for c in word)


def weak(text: str, taken: list[Span]) -> list[Span]:
    """Candidates that don't overlap a strong match."""
    found = [("secret", *m.span()) for m in SECRET.finditer(text) if mixed(m[0])]
    if "id" in text or "login" in text or "username" in text or "A" in text:
        found += [("identifier", *m.span()) for m in IDENTIFIER.finditer(text)]
    if "://" in text or ".amazonaws.com" in text:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    starts, ends = sorted(s for _, s, _ in taken), sorted(e for _, _, e in taken)
    return [(k, s, e) for k, s, e in found if bisect_left(starts, e) == bisect_right(ends, s)]


def linked(text: str, base: list[Span], candidates: list[Span], reach: int) -> list[Span]:
    """The candidates with a complement in scope: interval join by two sweeps, from the left and from the right."""
    if not candidates or len(base) + len(candidates) < 2:
        return []
    breaks = [m.start() for m in BLANK_LINE.finditer(text)]
    parts, kept = sorted({*base, *candidates}, key=lambda p: (p[1], p[2], p[0])), set()
    for backwards in (False, True):
        last: dict[str, tuple[int, int]] = {}
        for kind, start, end in reversed(parts) if backwards else parts:
            for other in COMPLEMENTS.get(kind, ()):
                if other in last:
                    a, b = last[other]
                    low, high = (end, a) if backwards else (b, start)
                    if high - low <= reach and bisect_left(breaks, low) == bisect_left(breaks, max(low, high)):
                        kept.add((kind, start, end))
            if kind not in last or not backwards and end > last[kind][1] or backwards and start < last[kind][0]:
                last[kind] = (start, end)
    return [c for c in candidates if c in kept]


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda p: (p[1], KINDS.index(p[0]), p[2])))


def secret_scan(docs: DataFrame, reach: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in every text, by place.

    Result: doc_id, n_assign, n_access, n_hex, base_sha256 (of the strong matches' spans), spans (all spans as kind:start:end by start,
    then kind; code points, end exclusive). Null and empty texts have none; repeated rows are scanned each; an empty table gives an
    empty result; other columns are ignored.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            base = strong(text or "")
            more = linked(text, base, weak(text, base), reach) if text else []
            kinds = [k for k, _, _ in base]
            rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(base + more)))
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in columns[:3]], *[pa.array(c, pa.string()) for c in columns[3:]]], names=names)

    return over_batches(picked(docs, doc_id=id_col, text=text_col), work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
