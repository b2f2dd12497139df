"""Repeated byte strings: a sparse enhanced suffix array and its common-prefix intervals.

Every string of ``LEAST`` (200) bytes has an anchor: the place in it where the hash of the next
``GRAM`` bytes is smallest. Copies of a string have their anchors at the same place, so
only suffixes that start at anchors (about one byte in 90) need sorting, and of these
only those whose first ``GRAM`` bytes come twice. Such a suffix carries its next 200 bytes and
the bytes before it. Suffixes with one ``GRAM`` are sorted, a stack scan over the common
prefixes of neighbours gives the tree of intervals, and in every interval the bytes
to the left are compared: members that agree over enough of them are a repeat of 200
bytes or more, and all of them are its occurrences.

The filter on the first bytes is exact: it drops what cannot repeat. Where a ``GRAM`` comes
very often (``LARGE``), its suffixes are not gathered in a task; windows of 200 bytes around
them are counted instead, which gives the same spans.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scale import scratch
from ..session import ship_package
from .common import group_bounds, small_batches, stage, staged_map, trimmed, whole_groups

LEAST, GRAM = 200, 24
#: Suffixes with one beginning above which they are not gathered in one task.
LARGE = 20_000
#: Offsets that share a core string, where windows are counted.
STEP = 25
_SEGMENT = (1 << 20) - 1024
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each place on, never 0."""
    h = data.astype(np.uint64)
    h += np.uint64(1)
    wide = {}
    for k, odd in zip((1, 2, 4, 8), _ODD):
        h = h[:-k] * odd + h[k:]
        wide[2 * k] = h
    h = wide[16][: len(data) - GRAM + 1] * _ODD[4] + wide[8][16 : 16 + len(data) - GRAM + 1]
    h ^= h >> np.uint64(31)
    h *= _ODD[1]
    h ^= h >> np.uint64(33)
    return h | np.uint64(1)


def _sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` (minimum or maximum) over each ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = f(x[:-done], x[done:])
        done *= 2
    return f(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def anchors(data: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Places in joined texts, and their hashes, such that every ``least`` bytes of one text have one.

    It is the first of the smallest hashes; a hash is compared by its upper 44 bits, then by its place.
    """
    width = least - GRAM + 1
    places, hashes = [], []
    n = len(data)
    ends = np.asarray(offsets[1:])
    for start in range(0, max(0, n - least + 1), _SEGMENT):
        stop = min(n - least + 1, start + _SEGMENT)  # windows that begin in [start, stop)
        h = _gram_hashes(data[start : stop + least - 1])
        ranked = (h >> np.uint64(20) << np.uint64(20)) | np.arange(1, len(h) + 1, dtype=np.uint64)
        low = _sliding(np.minimum, ranked, width)
        # A window that reaches over a text's end counts for nothing.
        over = np.zeros(len(low) + 1, np.int32)
        for e in ends[np.searchsorted(ends, start, "right") : np.searchsorted(ends, stop + least, "left") + 1].tolist():
            a, b = max(0, e - least + 1 - start), min(len(low), e - start)
            if b > a:
                over[a] += 1
                over[b] -= 1
        low = low[np.cumsum(over[:-1]) == 0]
        if len(low):
            first = np.ones(len(low), bool)
            first[1:] = low[1:] != low[:-1]  # a place is smallest for neighbouring windows
            at = (low[first] & np.uint64((1 << 20) - 1)).astype(np.int64) - 1
            places.append(at + start)
            hashes.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    places, keep = np.unique(places, return_index=True)  # segments overlap
    return places, hashes[keep]


def periodic(data: np.ndarray, at: np.ndarray, h: np.ndarray, least: int = LEAST) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Runs of one text that repeat themselves, and which of its anchors are still needed.

    In a run [a, z) with a short period p and ``least`` + p bytes or more, every string of ``least`` bytes
    comes again p bytes on or back, so the run is a span. The strings that start in its first period are all it has, so
    anchors for these, and for strings that reach over its ends, are enough.
    """
    needed = np.ones(len(at), bool)
    gap = np.diff(at)
    runs = []
    for p in np.unique(gap[(h[1:] == h[:-1]) & (gap < least)]).tolist():
        edge = np.diff(np.concatenate(([0], (data[p:] == data[:-p]).view(np.int8), [0])))
        for a, z in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if z - a >= least:
                runs.append((a, z + p))
                needed[(at >= a + 2 * p) & (at < z + p - least + 1)] = False
    return runs, needed


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def _matrix(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    flat = b"".join(r.ljust(width, b"\0") for r in rows)
    return np.frombuffer(flat, np.uint8).reshape(-1, width), np.fromiter(map(len, rows), np.int64, len(rows))


def _neighbours(m: np.ndarray, size: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefixes of rows that follow each other in ``order``."""
    differ = m[order[1:]] != m[order[:-1]]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return np.minimum(first, np.minimum(size[order[1:]], size[order[:-1]]))


def _sorted(m: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.lexsort((size, np.ascontiguousarray(m).view(f"S{m.shape[1]}").ravel()))


def intervals(prefix: np.ndarray) -> list[tuple[int, int, int]]:
    """The common-prefix intervals (depth, first, last) of neighbours' prefixes, by a stack scan."""
    out, stack = [], []
    for i, depth in enumerate([*prefix.tolist(), -1]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            out.append((top, first, i))
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return out


def reaches(rights: list[bytes], lefts: list[bytes], least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """How far to the left and right of each suffix repeats of ``least`` bytes or more go; 0 for none.

    ``lefts`` are the bytes before each suffix, the nearest first.
    """
    n = len(rights)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n == 2:
        r, l = _common(*rights), _common(*lefts)
        if r + l >= least:
            left[:], right[:] = l, r
        return left, right
    m, size = _matrix(rights, max(1, max(map(len, rights))))
    order = _sorted(m, size)
    prefix = _neighbours(m, size, order)
    m, size = _matrix(lefts, max(1, max(map(len, lefts))))
    by_left = _sorted(m, size)
    rank = np.empty(n, np.int64)
    rank[by_left] = np.arange(n)
    rows = [_neighbours(m, size, by_left)]  # minima over 1, 2, 4, ... neighbours
    while 2 ** len(rows) <= n - 1:
        k = 2 ** (len(rows) - 1)
        rows.append(np.minimum(rows[-1][:-k], rows[-1][k:]))
    for depth, first, last in intervals(prefix):
        members = order[first : last + 1]
        if last - first == 1:
            a, b = members
            l = _common(lefts[a], lefts[b])
            if l + depth >= least:
                left[members] = np.maximum(left[members], l)
                right[members] = np.maximum(right[members], depth)
            continue
        ranks = rank[members]
        turn = np.argsort(ranks)
        members, ranks = members[turn], ranks[turn]
        level = np.frexp((ranks[1:] - ranks[:-1]).astype(float))[1] - 1
        shared = np.empty(len(ranks) - 1, np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            shared[at] = np.minimum(rows[k][ranks[at]], rows[k][ranks[at + 1] - 2**k])
        # Members whose left sides agree far enough are one repeat; where they differ it ends.
        best = np.maximum(np.concatenate(([0], shared)), np.concatenate((shared, [0])))
        hit = best + depth >= least
        at = members[hit]
        left[at] = np.maximum(left[at], best[hit])
        right[at] = np.maximum(right[at], depth)
    return left, right


def _scan(batches, least: int):
    """For each text its digest and anchors; ``twice`` marks a beginning that comes again in the text."""
    for b in batches:
        text = b.column("text").cast(pa.large_binary())
        names = b.column("doc_id")
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        at, h = anchors(data, offsets, least)
        of = np.searchsorted(offsets, at, "right") - 1
        starts = np.searchsorted(of, np.arange(len(text) + 1))
        again = np.zeros(len(h), bool)
        needed = np.ones(len(h), bool)
        runs: list[list[dict]] = []
        for i in range(len(text)):
            a, z = starts[i], starts[i + 1]
            own = h[a:z]
            order = np.argsort(own, kind="stable")
            same = own[order[1:]] == own[order[:-1]]
            runs.append([])
            if same.any():
                again[a + order[1:]] |= same
                again[a + order[:-1]] |= same
                found, needed[a:z] = periodic(data[offsets[i] : offsets[i + 1]], at[a:z] - offsets[i], own, least)
                runs[-1] = [{"begin": x, "end": y} for x, y in found]
        kept = np.flatnonzero(needed)
        starts = np.searchsorted(of[kept], np.arange(len(text) + 1))
        listed = pa.StructArray.from_arrays(
            [pa.array(h[kept].view("<i8")), pa.array((at - offsets[of])[kept].astype(np.int32)), pa.array(again[kept])], names=["h", "pos", "twice"]
        )
        raw = memoryview(data)
        sums = [hashlib.sha256(raw[a:z]) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                names, pa.array([s.digest() for s in sums], pa.binary()), pa.array(np.diff(offsets)), pa.array([s.hexdigest() for s in sums], pa.string()),
                pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), listed), pa.array(runs, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
            ],
            names=["doc_id", "digest", "n_bytes", "sha", "anchors", "runs"],
        )


def _contexts(least: int):
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for digest, text, places in zip(b.column("digest").to_pylist(), b.column("text").to_pylist(), b.column("places").to_pylist()):
                for x in places:
                    p = x["pos"]
                    left, right = text[max(0, p - least + GRAM) : p][::-1], text[p : p + least]
                    if len(right) < GRAM or len(left) + len(right) < least:
                        continue
                    for c, v in zip(out, (xxhash.xxh3_64_intdigest(right[:GRAM]) - (1 << 63), left, right, digest, p, x["large"])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.bool_()))],
                names=["h", "left", "right", "digest", "pos", "large"],
            )

    return run


def _spans(least: int):
    """Sorted suffixes to spans ``[begin, end)`` of their texts."""

    def run(batches):
        for t in whole_groups(batches, ["h"], 4000):
            lefts, rights = t.column("left").to_pylist(), t.column("right").to_pylist()
            h, pos = t.column("h").to_numpy(), t.column("pos").to_numpy()
            bounds = group_bounds(h)
            left, right = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
            for a, z in zip(bounds[:-1], bounds[1:]):
                if z - a > 1:
                    left[a:z], right[a:z] = reaches(rights[a:z], lefts[a:z], least)
            hit = np.flatnonzero(right)
            yield pa.RecordBatch.from_arrays(
                [t.column("digest").take(pa.array(hit)).combine_chunks(), pa.array((pos - left)[hit].astype(np.int32)), pa.array((pos + right)[hit].astype(np.int32))],
                names=["digest", "begin", "end"],
            )

    return run


def _counted_spans(suffixes: DataFrame, least: int) -> DataFrame:
    """The spans of suffixes with a very frequent beginning, from counts of windows.

    Each window of ``least`` bytes around a suffix is counted by its md5. To count
    fewer, offsets are taken in steps: windows of one step share a core string, and only cores
    that come twice go on. Partial counts are formed before any shuffle.
    """
    core = F.expr(f"md5(concat(substring(right, 1, a), substring(left, 1, {least - STEP + 1} - a)))")
    cut = suffixes.withColumn("a", F.explode(F.expr(f"sequence({GRAM}, {least}, {STEP})"))).filter(
        F.expr(f"length(right) >= a and length(left) >= {least - STEP + 1} - a")
    )
    cores = cut.withColumn("core", core)
    shared = cores.groupBy("h", "a", "core").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    windows = (
        cores.join(shared, ["h", "a", "core"])
        .withColumn("r", F.explode(F.expr(f"sequence(a, least(a + {STEP - 1}, {least}))")))
        .filter(F.expr(f"length(right) >= r and length(left) >= {least} - r"))
        .select("h", "digest", "pos", "r", F.expr(f"md5(concat(substring(right, 1, r), substring(left, 1, {least} - r)))").alias("window"))
    )
    repeated = windows.groupBy("h", "r", "window").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return windows.join(repeated, ["h", "r", "window"]).groupBy("digest", "pos").agg(
        (F.col("pos") - least + F.min("r")).cast("int").alias("begin"), (F.col("pos") + F.max("r")).cast("int").alias("end")
    ).drop("pos")


def _cut(batches):
    """Texts without their spans; ``kept_text`` leaves out characters of which a byte is gone."""
    for b in batches:
        out: list[list] = [[] for _ in range(5)]
        for digest, text, spans in zip(b.column("digest").to_pylist(), b.column("text").to_pylist(), b.column("spans").to_pylist()):
            at, runs, kept = -1, 0, []
            done = 0
            for s, e in sorted((x["begin"], x["end"]) for x in spans):
                if s > at:
                    runs += 1
                    kept.append(text[done:s])
                at = max(at, e)
                done = at
            kept.append(text[done:])
            whole = b"".join(kept)
            for c, v in zip(out, (digest, len(text) - len(whole), runs, hashlib.sha256(whole).hexdigest(), "".join(k.decode("utf-8", "ignore") for k in kept))):
                c.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
            names=["digest", "n_removed", "n_spans", "kept_sha256", "kept_text"],
        )


def remove_repeats(docs: DataFrame, least: int = LEAST, large: int = LARGE, text: str = "text") -> DataFrame:
    """Counts what goes if every byte of a ``least``-byte string that also starts anywhere else is removed.

    Returns a row for each row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept_sha256``. Texts are UTF-8 bytes, a null text is empty, matches stay inside texts, and all
    strings are judged on the input. A text that comes twice, or a repeated row, loses everything if it has ``least``
    bytes; shorter texts lose nothing. ``doc_id`` may be null or repeated; other columns are not read.
    """
    scanned, cut = _removals(docs, least, large, text)
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= least)
    nothing = hashlib.sha256(b"").hexdigest()
    return scanned.select("doc_id", "digest", "n_bytes", "sha").join(cut, "digest").select(
        "doc_id", "n_bytes", F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, nothing).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, least: int = LEAST, large: int = LARGE) -> DataFrame:
    """``docs`` with ``text`` as ``remove_repeats`` leaves it, and its ``n_chars`` if there is such a column.

    A character goes if one of its bytes does. All rows and other columns stay; a text may become empty.
    """
    _, cut = _removals(docs, least, large, "text")
    copied = (F.col("__cut.copies") > 1) & (F.octet_length("text") >= least)
    keyed = docs.withColumn("__digest", F.unhex(F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256)))
    named = cut.select(F.col("digest").alias("__digest"), F.struct("copies", "kept_text").alias("__cut"))
    out = keyed.join(named, "__digest").withColumn("__text", F.when(copied, "").otherwise(F.coalesce("__cut.kept_text", "text")))
    fresh = {"text": F.col("__text"), "n_chars": F.length("__text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    changed = F.col("__text") != F.col("text")
    return out.select(*[F.when(changed, fresh[c]).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in docs.columns])


def _removals(docs: DataFrame, least: int, large: int, text: str) -> tuple[DataFrame, DataFrame]:
    """The scanned rows, and for each different text how often it comes and what is left of it (null: all)."""
    if least < 2 * GRAM:
        raise ValueError(f"least must be {2 * GRAM} or more")
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    with scratch(spark) as last:
        kind = "doc_id long, digest binary, n_bytes long, sha string, anchors array<struct<h:long,pos:int,twice:boolean>>, runs array<struct<begin:int,end:int>>"
        with small_batches(spark, 512, 2 << 20):
            scanned = stage(rows.mapInArrow(trimmed(lambda batches: _scan(batches, least)), kind))
        found, spans = _spans_of_texts(rows, scanned, least, large)
        by_text = spans.groupBy("digest").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
        kind = "digest binary, n_removed long, n_spans long, kept_sha256 string, kept_text string"
        cut = staged_map(found.select("digest", "text").join(by_text, "digest"), _cut, kind, write=last)
        scanned = last(scanned.select("doc_id", "digest", "n_bytes", "sha"))
    return scanned, scanned.groupBy("digest").agg(F.count("*").alias("copies")).join(cut, "digest", "left")


def _spans_of_texts(rows: DataFrame, scanned: DataFrame, least: int, large: int) -> tuple[DataFrame, DataFrame]:
    """Different texts with a repeat, and the spans to remove."""
    spark = rows.sparkSession
    # Beginnings that come in two texts, or twice in one. Eight bytes of a digest
    # name a text here: if two texts shared them, some places would be looked at in vain.
    name = F.expr("xxhash64(digest)").alias("d")
    places = scanned.select(name, F.inline("anchors"))
    repeated = (
        places.groupBy("h")
        .agg(F.min("d").alias("d0"), F.max("d").alias("d1"), F.max("twice").alias("twice"), F.count("*").alias("n"))
        .filter("d0 != d1 or twice")
        .select("h", (F.col("n") > large).alias("large"))
    )
    wanted = places.select("h", "d", "pos").join(repeated, "h").groupBy("d").agg(F.collect_set(F.struct("pos", "large")).alias("places"))
    own = scanned.filter(F.size("runs") > 0).select(name, "digest", "runs").dropDuplicates(["digest"])
    wanted = wanted.join(own.select("d").distinct(), "d", "full").withColumn("places", F.coalesce("places", F.expr("cast(array() as array<struct<pos:int,large:boolean>>)")))
    wanted = scanned.select(name, "digest").distinct().join(wanted, "d").drop("d")
    texts = rows.select(F.encode("text", "utf-8").alias("text")).filter(F.length("text") >= least).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # Copies are folded before and after the exchange, so a text with very many costs no more than another.
    found = stage(texts.dropDuplicates(["digest"]).join(wanted, "digest"))
    with small_batches(spark, 256, 4 << 20):
        kind = "h long, left binary, right binary, digest binary, pos int, large boolean"
        suffixes = found.mapInArrow(trimmed(_contexts(least)), kind)
        near = (
            suffixes.filter("not large").drop("large").repartition("h").sortWithinPartitions("h")
            .mapInArrow(trimmed(_spans(least)), "digest binary, begin int, end int")
        )
        often = found.filter(F.exists("places", lambda x: x["large"])).mapInArrow(_contexts(least), kind).filter("large")
        return found, stage(near.union(_counted_spans(stage(often), least)).union(own.select("digest", F.inline("runs"))))
