"""Secrets in texts, and credentials whose parts stand near each other.

Assignments, access identifiers and long hexadecimal runs are reported wherever they stand. Weaker
candidates (names of accounts, mixed keys, endpoints) are common in clean texts, so they are only
reported where they complete a credential: an identifier and a secret in one paragraph with at most ``REACH``
code points between them; endpoints near such an identifier are added. The parts of a text are rows of a table, and
an interval join on (text, paragraph, cell) finds which belong together. A cell is ``REACH`` code
points wide and holds few parts, so the pairs of a cell are bounded however long a text is.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import stage, staged_map

#: Code points between two parts of one credential.
REACH = 300
#: Kinds in the order in which they are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
#: The base patterns with their least sizes. Assignments are sought in lower-cased bytes.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: Patterns of weak candidates; names and hosts are sought in lower-cased bytes.
IDENTIFIER = re.compile(rb"""(?<![a-z0-9])(?:user(?:_?name|_?id)?|login|account|client_?id|key_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[a-z0-9@._+-]{3,}""")
HOST = re.compile(rb"""(?<![a-z0-9])(?:host(?:_?name)?|server|endpoint)["']?\x20*[:=]\x20*["']?[a-z0-9][a-z0-9.-]+(?::[0-9]+)?""")
URL = re.compile(rb"""(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{1,11}://[^\x00-\x20"'<>\x7f-\xff]{3,}""")
SHORT = re.compile(rb"""(?<![a-z0-9])(?:pass|pwd|auth|credential|private_?key)["']?\x20*[:=]\x20*["']?[a-z0-9+/_.=-]{4,}""")
MIXED = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Different characters that a mixed key has at least.
DIFFERENT = 10
#: Each pattern can only match in a lower-cased text that holds one of these.
HINTS = {
    ASSIGN: (b"passw", b"secret", b"token", b"key"), IDENTIFIER: (b"user", b"login", b"account", b"client", b"key"), HOST: (b"host", b"server", b"endpoint"),
    URL: (b"://",), SHORT: (b"pass", b"pwd", b"auth", b"credential", b"key"),
}
_BLANK_LINE = re.compile(rb"\n[ \t\r]*\n")
_MIX = (re.compile(rb"[a-z]").search, re.compile(rb"[A-Z]").search, re.compile(rb"[0-9]").search)

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def _found(pattern, low: bytes):
    return pattern.finditer(low) if any(h in low for h in HINTS[pattern]) else ()


def base_spans(raw: bytes, low: bytes) -> tuple[list[Span], list[Span]]:
    """Base spans in bytes, and assignments of values that are too short for one."""
    spans, short = [], []
    for m in _found(ASSIGN, low):
        (spans if m.end(2) - m.start(2) >= LEAST_VALUE else short).append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(raw)]
    return sorted(spans), short


def weak_spans(raw: bytes, low: bytes, taken: list[Span], short: list[Span]) -> list[Span]:
    """Weak candidates in bytes that overlap neither a base span nor each other; endpoints go first, then identifiers.

    Of two candidates of one kind that overlap, the one that starts first stays, at a tie the longer one.
    """
    offered = [
        [(m.start(), 5, m.end()) for p in (URL, HOST) for m in _found(p, low)],
        [(m.start(), 3, m.end()) for m in _found(IDENTIFIER, low)],
        [(a, 4, z) for a, _, z in short] + [(m.start(), 4, m.end()) for m in _found(SHORT, low)],
        [(m.start(), 4, m.end()) for m in MIXED.finditer(raw) if all(f(m[0]) for f in _MIX) and len(set(m[0])) >= DIFFERENT],
    ]
    out: list[Span] = []
    for some in offered:
        if not some:
            continue
        # Spans that are taken do not overlap in what matters here: merged, they are sorted by start and by end.
        merged: list[list[int]] = []
        for a, _, z in sorted(taken + out):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(z, merged[-1][1])
            else:
                merged.append([a, z])
        begins, last = [a for a, _ in merged], 0
        for a, kind, z in sorted(some, key=lambda s: (s[0], -s[2])):
            i = bisect_right(begins, a) - 1
            if a < last or (i >= 0 and merged[i][1] > a) or (i + 1 < len(merged) and merged[i + 1][0] < z):
                continue
            out.append((a, kind, z))
            last = z
    return sorted(out)


def _points(raw: bytes, spans: list[Span]) -> list[Span]:
    """The same spans in code points."""
    if raw.isascii() or not spans:
        return spans
    inner = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80)
    at = np.array([(a, z) for a, _, z in spans])
    moved = (at - np.searchsorted(inner, at)).tolist()
    return [(a, k, z) for (a, z), (_, k, _) in zip(moved, spans)]


SPANS = "array<struct<start: long, kind: int, end: long>>"
PARTS = "array<struct<start: long, kind: int, end: long, scope: int>>"
_SPAN = [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]


def scan(raw: bytes) -> tuple[list[Span], list[tuple]]:
    """Base spans, and all parts with their paragraphs if an identifier and a secret are among them."""
    low = raw.lower()
    base, short = base_spans(raw, low)
    weak = weak_spans(raw, low, base, short)
    kinds = {k for _, k, _ in base} | {k for _, k, _ in weak}
    if not kinds & {1, 3} or not kinds & {0, 2, 4}:
        return _points(raw, base), []
    breaks = [m.start() for m in _BLANK_LINE.finditer(raw)]
    every = sorted(base + weak)
    scopes = [bisect_right(breaks, a) for a, _, _ in every]
    return _points(raw, base), [(*s, p) for s, p in zip(_points(raw, every), scopes)]


def scanned_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``base`` (spans), ``parts``, ``key`` (of the text, where it has parts), ``salt``."""
    ship_package(docs.sparkSession)
    span, part = pa.list_(pa.struct(_SPAN)), pa.list_(pa.struct([*_SPAN, ("scope", pa.int32())]))

    def run(batches):
        import hashlib

        count = 0
        for rows in batches:
            if not rows.num_rows:
                continue
            base, parts, keys = [], [], []
            for raw in rows.column("text").to_pylist():
                b, p = scan(raw)
                base.append([dict(zip(("start", "kind", "end"), s)) for s in b])
                parts.append([dict(zip(("start", "kind", "end", "scope"), s)) for s in p])
                keys.append(hashlib.sha256(raw).digest() if p else None)
            salts = [(count + i) % SALTS for i in range(rows.num_rows)]
            count += rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(base, span), pa.array(parts, part), pa.array(keys, pa.binary()), pa.array(salts, pa.int32())],
                names=["doc_id", "base", "parts", "key", "salt"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return staged_map(rows, run, f"doc_id long, base {SPANS}, parts {PARTS}, key binary, salt int", rows=1024)


#: Ways in which the rows of one repeated text are dealt when their spans are joined to them.
SALTS = 16


def _near(anchors: DataFrame, others: DataFrame, reach: int) -> DataFrame:
    """Pairs (key, a, b) of spans of one paragraph with at most ``reach`` code points between them.

    Anchors enter every cell that they can reach into, the others the cells of their two ends.
    """
    cells = F.sequence(F.floor((F.col("span.start") - reach) / reach), F.floor((F.col("span.end") + reach) / reach))
    ends = F.array_distinct(F.array(F.floor(F.col("span.start") / reach), F.floor(F.col("span.end") / reach)))
    a = anchors.select("key", "scope", F.col("span").alias("a"), F.explode(cells).alias("cell"))
    b = others.select("key", "scope", F.col("span").alias("b"), F.explode(ends).alias("cell"))
    close = (F.col("b.start") - F.col("a.end") <= reach) & (F.col("a.start") - F.col("b.end") <= reach)
    return a.join(b, ["key", "scope", "cell"]).filter(close).select("key", "scope", "a", "b").distinct()


def linked_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Credentials among ``parts`` (``key``, ``scope``, ``span``): rows (``key``, ``identifier``, ``part``).

    ``part`` is a secret or an endpoint. Every pair within reach is a row: a cell holds few parts, so there is no cap.
    """
    kind = F.col("span.kind")
    names, secrets, ends = (parts.filter(kind.isin(*k)) for k in ([1, 3], [0, 2, 4], [5]))
    pairs = _near(names, secrets, reach)
    whole = pairs.select("key", "scope", F.col("a").alias("span")).distinct()
    return pairs.union(_near(whole, ends, reach)).select("key", F.col("a").alias("identifier"), F.col("b").alias("part"))


def find_secrets(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """A row for each row of ``docs`` with its spans.

    ``n_assign``, ``n_access``, ``n_hex``: base spans of each kind; ``base_sha256``: digest of their list; ``spans``: the list of all
    spans, those that complete a credential too, as kind:start:end, sorted by start and kind, joined by commas; ``n_linked``: how many
    are not of the base. Null and empty texts have no spans. Repeated rows stay; ``doc_id`` may be null; other
    columns are not read. Equal texts are linked once.
    """
    scanned = scanned_texts(docs, text)
    once = scanned.filter(F.col("key").isNotNull()).groupBy("key").agg(F.first("parts").alias("parts"))
    parts = stage(once.select("key", F.explode("parts").alias("p")).select("key", "p.scope", F.struct("p.start", "p.kind", "p.end").alias("span")))
    links = linked_parts(parts, reach)
    spans = links.select("key", F.explode(F.array("identifier", "part")).alias("span")).filter(F.col("span.kind") >= 3).distinct()
    weak = spans.groupBy("key").agg(F.collect_list("span").alias("weak"))
    salted = weak.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = scanned.filter(F.col("key").isNotNull()).drop("parts").join(stage(salted), ["key", "salt"], "left")
    none = F.array().cast(SPANS)
    every = named.select("doc_id", "base", F.coalesce("weak", none).alias("weak")).union(
        scanned.filter(F.col("key").isNull()).select("doc_id", "base", none.alias("weak"))
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        return F.array_join(
            F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def counted(i):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return every.select(
        "doc_id", *map(counted, range(3)), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.concat("base", "weak")).alias("spans"),
        F.size("weak").cast("long").alias("n_linked"),
    )
