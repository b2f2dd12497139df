"""How filters on texts interact: counts for every order in which they may be applied.

One pass of a finite-state transducer over the UTF-8 bytes of a batch gives words, capitals, code
points and symbols of each text. It is a table: for the class of the byte before and the class of
a byte it says what is emitted. Spans of words go into one hash table for a batch, with open
addressing; a span only counts as known when its bytes have been compared with those of the slot's owner.
What each text fails is then counted by part and set of failed filters, and all orders follow from these counts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import Spans, staged_map

#: The filters, and the limits of the first four.
FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_SHARE, CAPITAL_SHARE = 50, 65, 5
SPACES, SYMBOLS = b"\x20\x09\x0a\x0b\x0c\x0d", b"#$%&*|"

# Classes of bytes, and what a byte emits: bits of an 8-bit word.
SPACE, REST, CAPITAL, SYMBOL, INNER = range(5)
POINT, IS_CAPITAL, IS_SYMBOL, STARTS_WORD, ENDS_WORD = 1, 2, 4, 8, 16


@lru_cache(maxsize=1)
def transducer() -> tuple[np.ndarray, np.ndarray]:
    """(class of each byte value, emission of each pair 8 * class before + class)."""
    kind = np.full(256, REST, np.uint8)
    kind[list(SPACES)] = SPACE
    kind[ord("A") : ord("Z") + 1] = CAPITAL
    kind[list(SYMBOLS)] = SYMBOL
    kind[0x80:0xC0] = INNER  # inside a character
    emits = np.zeros(64, np.uint8)
    for before in range(5):
        for now in range(5):
            out = POINT if now != INNER else 0
            out |= IS_CAPITAL if now == CAPITAL else 0
            out |= IS_SYMBOL if now == SYMBOL else 0
            out |= STARTS_WORD if before == SPACE and now != SPACE else 0
            out |= ENDS_WORD if before != SPACE and now == SPACE else 0
            emits[8 * before + now] = out
    return kind, emits


def _sums(flags: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the flagged bytes lie in each [begin, end)."""
    at = np.flatnonzero(flags)
    return np.searchsorted(at, ends) - np.searchsorted(at, begins)


def distinct_words(spans: Spans, owner: np.ndarray, texts: int, hashes: np.ndarray | None = None) -> np.ndarray:
    """Different words of each text: all spans are inserted into one table, keyed by (text, bytes).

    In a round every open span looks at its slot. Empty slots are taken by one of the spans that look at them;
    a span that is its slot's owner, or has the text and the bytes of the owner, is done, and the others go on
    to the next slot. Equal hashes of different words so cost rounds, never a wrong count.
    """
    hashes = spans.hashes(owner) if hashes is None else hashes
    n = len(owner)
    size = 1 << max(4, (2 * n - 1).bit_length())
    mask = np.uint64(size - 1)
    table = np.full(size, -1, np.int64)
    counts = np.zeros(texts, np.int64)
    open_, step = np.arange(n), 0
    while len(open_):
        slot = ((hashes[open_] + np.uint64(step)) & mask).astype(np.int64)
        empty = table[slot] < 0
        table[slot[empty]] = open_[empty]
        held = table[slot]
        mine = held == open_
        counts += np.bincount(owner[open_[mine]], minlength=texts)
        rest = np.flatnonzero(~mine)
        a, b = open_[rest], held[rest]
        known = (owner[a] == owner[b]) & (hashes[a] == hashes[b])
        at = np.flatnonzero(known)
        known[at] = spans.same(a[at], spans, b[at])
        open_ = a[~known]
        step += 1
    return counts


def measures(buffer: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for texts that lie one after the other in ``buffer``; ``ends`` are their ends.

    ``points``, ``capitals``, ``symbols``, ``words`` and ``different`` (words).
    """
    kind, emits = transducer()
    begins = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
    now = kind[buffer]
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[begins[begins < len(buffer)]] = SPACE  # the state at the begin of a text
    emitted = emits[before * np.uint8(8) + now]
    capitals, symbols = (_sums(emitted & bit, begins, ends) for bit in (IS_CAPITAL, IS_SYMBOL))
    points = ends - begins - _sums(emitted & POINT == 0, begins, ends)
    start = np.flatnonzero(emitted & STARTS_WORD)
    # A word ends at the next space, or where its text ends.
    owner = np.searchsorted(ends, start, side="right")
    stops = np.append(np.flatnonzero(emitted & ENDS_WORD), len(buffer))
    stop = np.minimum(stops[np.searchsorted(stops, start)], ends[owner]) if len(start) else start
    spans = Spans(buffer, start, stop - start)
    return {
        "points": points, "capitals": capitals, "symbols": symbols, "words": np.bincount(owner, minlength=len(ends)),
        "different": distinct_words(spans, owner, len(ends)),
    }


KINDS = {"words": "long", "different": "long", "capitals": "long", "symbols": "long", "points": "long"}


def text_measures(docs: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``part``, ``digest`` (sha256 of the text) and the counts.

    ``words`` (maximal runs without space, tab, line end, vertical tab or form feed), ``different`` words,
    ``capitals``, ``symbols`` and ``points`` (code points). Null texts count as empty and null parts as an
    empty string; ``doc_id`` may be null or repeated; other columns are not read. Written once to the shared folder.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            texts = rows.column("text")
            if texts.type != pa.large_binary():
                texts = texts.cast(pa.large_binary())
            bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, offset=8 * texts.offset)
            raw = texts.buffers()[2]
            buffer = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
            found = measures(buffer, bounds[1:] - bounds[0])
            digest = [hashlib.sha256(memoryview(buffer[a:b])).digest() for a, b in zip((bounds[:-1] - bounds[0]).tolist(), (bounds[1:] - bounds[0]).tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("part"), pa.array(digest, pa.binary()), *(pa.array(found[c], pa.int64()) for c in KINDS)],
                names=["doc_id", "part", "digest", *KINDS],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    schema = "doc_id long, part string, digest binary, " + ", ".join(f"{c} {t}" for c, t in KINDS.items())
    return staged_map(rows, run, schema, rows=1024)


def failures(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows counted by (``part``, ``mask``): ``n``, ``good``, ``toxic``; bit i of the mask is filter i.

    A text is a copy if a smaller ``doc_id`` has the same text anywhere in the table; a null ``doc_id`` is neither
    smaller nor larger than others. Of several labels for a document the largest counts; a label without an id belongs to none. Rows are
    first folded by document, then by text, part and label, so neither copies nor parts gather in one task.
    """
    bits = (
        (F.col("words") < LEAST_WORDS, 1),
        (100 * F.col("different") < DISTINCT_SHARE * F.col("words"), 2),
        (100 * F.col("capitals") > CAPITAL_SHARE * F.col("points"), 4),
        (F.col("symbols") > 0, 8),
    )
    mask = sum(F.when(test, bit).otherwise(0) for test, bit in bits)
    marks = labels.groupBy("doc_id").agg((F.max("quality") == 1).alias("is_good"), (F.max("toxic") == 1).alias("is_toxic"))
    rows = measured.groupBy("doc_id", "part", "digest", mask.alias("mask")).agg(F.count(F.lit(1)).alias("n")).join(marks, "doc_id", "left")
    rows = rows.select(
        "doc_id", "part", "digest", "mask", "n", F.coalesce("is_good", F.lit(False)).alias("is_good"), F.coalesce("is_toxic", F.lit(False)).alias("is_toxic"),
    )
    # The smallest document of each (text, part, label), with its rows; the least over a text is the original.
    by_text = rows.groupBy("digest", "part", "mask", "is_good", "is_toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    by_text = by_text.withColumn("originals", F.col("unnamed") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0))
    split = F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("originals").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
    ))
    return (
        by_text.select("part", "is_good", "is_toxic", split)
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the five filters and step; see the module.

    ``kept`` (after this step), ``removed`` (here), ``redundant`` (fail this filter, removed before), ``unique_fails``
    (fail this filter only), ``good_lost`` and ``toxic_lost`` (removed here, with that label) and ``shapley``: what the step's
    filter removes, summed over all orders. An empty table has no parts and gives no rows.
    """
    counted = failures(text_measures(docs), labels)
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append((f"{''.join(FILTERS[i] for i in order)}", step, before, 1 << f))
            before |= 1 << f
    # 600 rows, the same for every table, beside at most 32 rows of each part.
    table = F.from_json(
        F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"b":{b},"f":{f}}}' for o, s, b, f in steps) + "]"),
        "array<struct<o string, s int, b int, f int>>",
    )
    cells = counted.select("*", F.inline(table))
    fails, was_removed = F.col("mask").bitwiseAND(F.col("f")) > 0, F.col("mask").bitwiseAND(F.col("b")) > 0

    def total(test, column="n"):
        return F.sum(F.when(test, F.col(column)).otherwise(F.lit(0).cast("long")))

    out = cells.groupBy("part", "o", "s", "f").agg(
        total(~fails & ~was_removed).alias("kept"), total(fails & ~was_removed).alias("removed"), total(fails & was_removed).alias("redundant"),
        total(F.col("mask") == F.col("f")).alias("unique_fails"), total(fails & ~was_removed, "good").alias("good_lost"),
        total(fails & ~was_removed, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "f"))
    return out.select(
        "part", F.col("o").alias("filter_order"), F.col("s").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        shapley.alias("shapley"),
    )
