"""Secrets in text: fixed patterns, and parts of credentials that only mean something together."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of the contract: the base patterns, and the order of kinds.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
BASE_KINDS = ("assign", "access", "hex")

# The method's own parts.
KINDS = (*BASE_KINDS, "identifier", "key", "endpoint")
IDENTIFIER = re.compile(
    r"""(?ai)(?<![a-z0-9_])(access_?key_?id|client_?id|tenant_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?([a-z0-9_.@+-]{3,})"""
)
IDENTIFIER_WORDS = (b"key_id", b"keyid", b"client", b"tenant", b"user", b"login", b"account")
ENDPOINT = re.compile(r"""(?ai:https?|wss?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\s"'<>|]+""")
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
KEY_BITS = 3.5
# Parts belong together within this many code points, unless an empty line lies between them.
SCOPE = 300
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
# What completes what: an identifier or an endpoint needs a secret, a weak key needs one of them.
ROLES = {"assign": "secret", "hex": "secret", "key": "secret", "access": "owner", "identifier": "owner", "endpoint": "place"}
COMPLEMENTS = {"secret": ("owner", "place"), "owner": ("secret",), "place": ("secret",)}


class Span(NamedTuple):
    start: int
    kind: int
    end: int

    def __str__(self) -> str:
        return f"{KINDS[self.kind]}:{self.start}:{self.end}"


def _kind(name: str) -> int:
    return KINDS.index(name)


def base_spans(text: str, lower: bytes) -> list[Span]:
    """Matches of the fixed patterns; `lower` is the text in UTF-8 with A-Z in lower case."""
    spans = []
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [Span(m.start(), _kind("assign"), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [Span(m.start(), _kind("access"), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [Span(m.start(), _kind("hex"), m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _random(value: str) -> bool:
    """Letters of both cases and digits, spread as in a random string."""
    if not (re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value)):
        return False
    size = len(value)
    return -sum(n / size * math.log2(n / size) for n in Counter(value).values()) >= KEY_BITS


def linked_spans(text: str, lower: bytes, base: list[Span]) -> list[Span]:
    """Weak parts that a complementary part, weak or strong, joins within its scope.

    An interval join on sorted starts: a part's interval reaches `SCOPE` code points past both its ends, clipped to
    the paragraph; a match is any complementary part that overlaps it. Only whether one exists is kept, so many parts in
    one scope give no pairs. Weak parts inside other spans don't count.
    """
    weak = []
    if any(word in lower for word in IDENTIFIER_WORDS):
        weak += [Span(m.start(), _kind("identifier"), m.end()) for m in IDENTIFIER.finditer(text)]
    if b"://" in lower:
        weak += [Span(m.start(), _kind("endpoint"), m.end()) for m in ENDPOINT.finditer(text)]
    # A weak key is worth looking for only beside an owner or a place.
    if weak or any(ROLES[KINDS[s.kind]] == "owner" for s in base):
        weak += [Span(m.start(), _kind("key"), m.end()) for m in KEY.finditer(text) if _random(m[0])]
    if not weak:
        return []
    taken = _Cover(base)
    weak = [s for s in sorted(weak) if not taken.meets(s.start, s.end)]
    places = _Cover([s for s in weak if KINDS[s.kind] == "endpoint"])
    weak = [s for s in weak if KINDS[s.kind] == "endpoint" or not places.meets(s.start, s.end)]
    roles = {role: _Cover([s for s in (*base, *weak) if ROLES[KINDS[s.kind]] == role]) for role in COMPLEMENTS}
    breaks = [0, *(m.start() for m in SCOPE_END.finditer(text)), len(text)]
    found = []
    for span in weak:
        low = max(span.start - SCOPE, breaks[bisect_right(breaks, span.start) - 1])
        high = min(span.end + SCOPE, breaks[min(bisect_left(breaks, span.end), len(breaks) - 1)])
        if any(roles[other].meets(low, high) for other in COMPLEMENTS[ROLES[KINDS[span.kind]]]):
            found.append(span)
    return found


class _Cover:
    """Spans of a text, for the question whether any overlaps an interval."""

    def __init__(self, spans: list[Span]) -> None:
        self.starts, self.ends, most = [], [], 0
        for span in sorted(spans):
            most = max(most, span.end)
            self.starts.append(span.start)
            self.ends.append(most)

    def meets(self, low: int, high: int) -> bool:
        before = bisect_left(self.starts, high)
        return before > 0 and self.ends[before - 1] > low


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by start and kind; in code points, the end exclusive."""
    lower = text.encode("utf-8", "surrogatepass").lower()
    base = base_spans(text, lower)
    return base, sorted([*base, *linked_spans(text, lower, base)])


def redact(text: str, mask: str = "[SECRET]") -> str:
    """The text with every span masked; spans that overlap or touch become one mask."""
    merged: list[list[int]] = []
    for span in scan(text)[1]:
        if merged and span.start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], span.end)
        else:
            merged.append([span.start, span.end])
    parts, at = [], 0
    for start, end in merged:
        parts += [text[at:start], mask]
        at = end
    return "".join([*parts, text[at:]]) if merged else text


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"


def find_secrets(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`SCHEMA` per row of `documents`, in one pass without a shuffle: a scope never leaves its text.

    A null text is empty and has no spans; a null id stays null; repeated rows come out repeated; other
    columns are ignored; an empty table gives no rows. Matches of different kinds may overlap, and all are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, spans = scan(text.as_py() or "")
                kinds = Counter(s.kind for s in base)
                digest = hashlib.sha256(",".join(map(str, base)).encode()).hexdigest()
                rows.append((*(kinds[k] for k in range(3)), digest, ",".join(map(str, spans)), len(spans) - len(base)))
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(values, t) for values, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def redact_documents(documents: DataFrame) -> DataFrame:
    """`documents` with the spans of `text` masked and `n_chars`, where there is one, counted anew; nulls stay null."""
    masked = F.pandas_udf(lambda texts: texts.map(redact, na_action="ignore"), "string")
    out = documents.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in documents.columns else out
