"""Secret scan with multipart credential linking.

Three base patterns are always reported: assignments (``password = ...``), access
identifiers (``AKIA...``) and long hexadecimal runs. Weaker candidates are common in clean
text, so one is reported only where the parts that would complete a credential stand near:

* ``id``, a key identifier of capitals and digits: with a secret in its scope;
* ``blob``, a long mixed-case token: with an access identifier or ``id`` in its scope;
* ``endpoint``, a URL, host:port or e-mail address: with an identifier and a secret in its scope.

A scope is the interval within ``REACH`` characters of a candidate, cut to its document. The
interval join is a sweep over the sorted parts of one document (binary search, no pairs are
made). Documents are independent, so one pass without a shuffle does it all.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

KINDS = ("assign", "access", "hex", "id", "blob", "endpoint")
REACH = 300

# Fixed patterns of the base kinds, and the least lengths of what they hold.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

_NAMES = (b"passw", b"secret", b"token", b"api")
_ID = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,32}(?![A-Za-z0-9+/_=-])")
_BLOB = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
# An endpoint is the leftmost match of one of these, the earlier kind where two start together:
# a URL, a host with a port, an e-mail address, an IPv4 address.
_URL = re.compile(r"https?://[^\s\"'<>]+")
_HOST, _HOST_END, _PORT = re.compile(r"[A-Za-z0-9.-]+"), re.compile(r"\.[a-z]{2,}"), re.compile(r":[0-9]{2,5}")
_USER, _DOMAIN = re.compile(r"[A-Za-z0-9._-]+"), re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ADDRESS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{2,5})?")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds, in code points; each pattern's matches do not overlap."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    found = []
    if any(name in raw for name in _NAMES):
        found += [Span(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [Span(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


class _Parts:
    """Spans of one role, for the questions whether one lies within reach and whether one overlaps."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans)
        self.starts = [s.start for s in self.spans]
        self.ends = sorted(s.end for s in self.spans)
        self.furthest = list(accumulate((s.end for s in self.spans), max))

    def near(self, span: Span) -> bool:
        """Whether a part beside the span starts or ends within REACH of it."""
        after = bisect_left(self.starts, span.end)
        if after < len(self.starts) and self.starts[after] <= span.end + REACH:
            return True
        before = bisect_right(self.ends, span.start) - 1
        return before >= 0 and self.ends[before] >= span.start - REACH

    def overlaps(self, span: Span) -> bool:
        before = bisect_left(self.starts, span.end) - 1
        return before >= 0 and self.furthest[before] > span.start


def _tails(text: str) -> list[list[tuple[int, int, int]]]:
    """(first start, last start, end) of hosts with a port and of e-mail addresses.

    Both begin anywhere in a run of their signs and are decided by what ends the run, so each
    run is looked at once, however long it is.
    """
    hosts, users = [], []
    if ":" in text:
        for run in _HOST.finditer(text):
            port = _PORT.match(text, run.end())
            dot = port and text.rfind(".", run.start() + 1, run.end())
            if port and dot > 0 and _HOST_END.fullmatch(text, dot, run.end()):
                hosts.append((run.start(), dot - 1, port.end()))
    if "@" in text:
        for run in _USER.finditer(text):
            domain = _DOMAIN.match(text, run.end())
            if domain:
                users.append((run.start(), run.end() - 1, domain.end()))
    return [hosts, users]


def endpoints(text: str) -> Iterator[Span]:
    """Endpoints from the left, none within another, in time linear in the text."""
    tails = _tails(text)
    used = [0, 0]
    at = 0
    url, address = _URL.search(text), _ADDRESS.search(text)
    while True:
        if url and url.start() < at:
            url = _URL.search(text, at)
        if address and address.start() < at:
            address = _ADDRESS.search(text, at)
        options = [(url.start(), 0, url.end())] if url else []
        for n, tail in enumerate(tails):
            while used[n] < len(tail) and tail[used[n]][1] < at:
                used[n] += 1
            if used[n] < len(tail):
                first, _, end = tail[used[n]]
                options.append((max(first, at), n + 1, end))
        if address:
            options.append((address.start(), 3, address.end()))
        if not options:
            return
        start, _, at = min(options)
        yield Span(start, 5, at)


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates outside the base spans whose complementary parts stand near."""
    ids = [Span(m.start(), 3, m.end()) for m in _ID.finditer(text)]
    access = [s for s in base if s.kind == 1]
    if not (ids or access):
        return []
    taken = _Parts(base)

    def free(span: Span) -> bool:
        return not taken.overlaps(span)

    blobs = [Span(m.start(), 4, m.end()) for m in _BLOB.finditer(text) if _mixed(m[0])]
    ids, blobs = list(filter(free, ids)), list(filter(free, blobs))
    identifiers = _Parts(access + ids)
    secrets = _Parts([s for s in base if s.kind != 1] + blobs)
    found = [s for s in ids if secrets.near(s)] + [s for s in blobs if identifiers.near(s)]
    if identifiers.spans and secrets.spans:
        found += [s for s in endpoints(text) if free(s) and identifiers.near(s) and secrets.near(s)]
    return sorted(found)


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans by start and then kind); none in a null text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + linked_spans(text, base))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span, overlaps joined, replaced by ``[kind]``."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out.append(text[at : s.start] + f"[{KINDS[s.kind]}]")
        at = max(at, s.end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans, n_assign, n_access, n_hex, base_sha256) of every row.

    ``spans`` is an array of (kind, first, last), code points, the last exclusive. A null or
    empty text has no span. Repeated rows and ids are scanned row by row.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches):
        for batch in blocks.cut(batches, "t"):
            lists, counts, digests = [], [], []
            for text in batch.column("t").to_pylist():
                base, spans = scan(text)
                lists.append([{"kind": KINDS[s.kind], "first": s.start, "last": s.end} for s in spans])
                counts.append([sum(s.kind == k for s in base) for k in range(3)])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            parts = pa.array(lists, pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("k"), parts, *columns, pa.array(digests)], ["k", "spans", "n_assign", "n_access", "n_hex", "base_sha256"])

    schema = f"k {kind}, spans array<struct<kind: string, first: bigint, last: bigint>>, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string"
    found = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).mapInArrow(work, schema)
    return found.withColumnRenamed("k", doc_id)


def spans_text(spans: str = "spans"):
    """An array of spans as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with the secrets of each text replaced by their kinds; null stays null.

    ``length`` names a column that holds the number of characters, to be kept right.
    """
    names = docs.columns
    whole = docs.schema

    def work(batches):
        for batch in blocks.cut(batches, text):
            texts = [t if t is None else redacted(t, scan(t)[1]) for t in batch.column(text).to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns[text] = pa.array(texts, pa.string())
            if length is not None:
                old = columns[length]
                counted = [o if t is None else len(t) for t, o in zip(texts, old.to_pylist(), strict=True)]
                columns[length] = pa.array(counted, old.type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return docs.mapInArrow(work, whole)
