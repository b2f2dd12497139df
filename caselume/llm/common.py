"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scale import stage

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    return F.translate(col, CAPITALS, SMALL)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256, size: int = 8 << 20):
    """Arrow batches bounded in rows and bytes, so that long texts don't fill a Python worker."""
    keys = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(size),
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def give_back() -> None:
    """Return free memory to the system: an idle Python worker stays beside the JVM of its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no GNU library
        pass


def trimmed(function):
    """A task of ``mapInArrow`` that gives its memory back at its end."""

    def run(batches):
        yield from function(batches)
        give_back()

    return run


def staged_map(df: DataFrame, function, schema, rows: int = 256, compression: str | None = None, write=stage) -> DataFrame:
    """``mapInArrow`` in small batches, run once and written to the shared folder by ``write``."""
    spark, key = df.sparkSession, "spark.sql.parquet.compression.codec"
    before = spark.conf.get(key)
    with small_batches(spark, rows):
        spark.conf.set(key, compression or before)
        try:
            return write(df.mapInArrow(trimmed(function), schema))
        finally:
            spark.conf.set(key, before)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that hold whole groups only; the input is sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        now = pa.Table.from_batches(held)
        last = [now.column(k)[count - 1].as_py() for k in keys]
        cut = count - 1
        while cut and [now.column(k)[cut - 1].as_py() for k in keys] == last:
            cut -= 1
        if cut:
            yield now.slice(0, cut).combine_chunks()
            rest = now.slice(cut).combine_chunks()
            held, count = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_bounds(*columns) -> list[int]:
    """Starts of runs of equal values in sorted numpy columns, and the end."""
    n = len(columns[0])
    if not n:
        return [0]
    new = np.ones(n, bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return [*np.flatnonzero(new).tolist(), n]


#: Longer spans are hashed and compared as a whole.
LONG_SPAN = 256


class Spans:
    """Byte strings in a buffer, read eight bytes at a time; a ``padded`` buffer has eight bytes more than are used."""

    def __init__(self, buffer: np.ndarray, start: np.ndarray, size: np.ndarray, padded: bool = False):
        held = buffer if padded else np.concatenate([buffer, np.zeros(8, np.uint8)])
        self.eights = np.lib.stride_tricks.as_strided(held, (len(held) - 7, 8), (1, 1))
        self.buffer, self.start, self.size = buffer, start, size
        self.masks = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], "<u8")

    def eight(self, which: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 7 of the spans, zeros after a span's end."""
        raw = self.eights[self.start[which] + 8 * k].view("<u8").ravel()
        return raw & self.masks[np.minimum(self.size[which] - 8 * k, 8)]

    def whole(self, i: int) -> bytes:
        return self.buffer[self.start[i] : self.start[i] + self.size[i]].tobytes()

    def hashes(self, seed: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span, its length and ``seed``."""
        spread = np.uint64(0x9E3779B97F4A7C15)
        out = (seed.astype(np.uint64) * spread) ^ self.size.astype(np.uint64)
        left = np.flatnonzero(self.size <= LONG_SPAN)
        k = 0
        while len(left):
            x = (out[left] ^ self.eight(left, k)) * spread
            out[left] = x ^ (x >> np.uint64(29))
            k += 1
            left = left[self.size[left] > 8 * k]
        for i in np.flatnonzero(self.size > LONG_SPAN).tolist():
            out[i] ^= np.uint64(int.from_bytes(hashlib.blake2b(self.whole(i), digest_size=8).digest(), "little"))
        return out ^ (out >> np.uint64(32))

    def same(self, a: np.ndarray, other: Spans, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` have the same bytes as spans ``b`` of ``other``."""
        equal = self.size[a] == other.size[b]
        left, k = np.flatnonzero(equal & (self.size[a] <= LONG_SPAN)), 0
        while len(left):
            alike = self.eight(a[left], k) == other.eight(b[left], k)
            equal[left[~alike]] = False
            k += 1
            left = left[alike & (self.size[a[left]] > 8 * k)]
        for i in np.flatnonzero(equal & (self.size[a] > LONG_SPAN)).tolist():
            equal[i] = self.whole(a[i]) == other.whole(b[i])
        return equal


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``edges`` as rows (node, root); the root is the smallest node.

    Alternates the large-star and small-star steps: every step halves the distance
    to the root at least, keeps at most one edge for each node pair, and is written
    to the shared folder, so a lost executor costs one step at most. No node or edge
    goes to the driver, only a count and a sum of hashes.
    """
    now = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    now, seen = stage(now), None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = mark
        both = now.union(now.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.union(lower.select("u", "m").toDF("u", "v")).distinct())
