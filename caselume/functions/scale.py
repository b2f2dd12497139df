"""Primitives that keep global order work distributed.

A window without a partition key, or with a key that holds a large share of the
rows, runs in one task. The functions here give the same answers from range
slices or hash buckets plus a small table of offsets.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .random import seeded_uniform


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, the folder given to ``setCheckpointDir``. Where there is
    neither, a session on one machine gets a temporary folder, and a cluster an error: its
    executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="caselume-"))
        named = context.getCheckpointDir()
    return named


def stage(df: DataFrame) -> DataFrame:
    """Write once and read back: cuts lineage, survives executor loss, gives sizes.

    Unlike ``checkpoint`` the plan runs once, later readers prune columns, and the
    optimizer sees the real size when it chooses a join.
    """
    path = f"{staging_dir(df.sparkSession)}/caselume/{uuid.uuid4().hex}"
    if scopes := getattr(_open, "scopes", None):
        scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_open = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Folders that ``stage`` writes inside are dropped at the end of the block.

    The block is given a function that stages what is to stay: its result belongs to the scope around, and
    its plan reads nothing that is dropped. After an error the folders are dropped as well.
    """
    scopes = _open.__dict__.setdefault("scopes", [])
    own: list[str] = []
    scopes.append(own)

    def last(df: DataFrame) -> DataFrame:
        at = scopes.index(own)
        inner, scopes[at:] = scopes[at:], []
        try:
            return stage(df)
        finally:
            scopes.extend(inner)

    try:
        yield last
    finally:
        scopes.remove(own)
        drop_folders(spark, own)


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    """Removes folders in whatever store holds them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def running_totals(df: DataFrame, by: list[str], order: list, sums: list[str]) -> DataFrame:
    """Adds ``cum_<s>`` (inclusive) and ``total_<s>`` per group, in the given order.

    ``df`` must already be aggregated to one row per (group, order key), so equal
    keys cannot pile up. Rows are range-partitioned, so a group of any size is
    spread over slices; per-slice sums (at most slices + groups rows) link them.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = stage(
        df.repartitionByRange(*[F.col(b) for b in by], *order_cols).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    per_slice = ranged.groupBy("_slice", *by).agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        F.col("_slice").alias("_s"),
        *[F.col(b).alias(f"_by_{b}") for b in by],
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(group).alias(f"total_{s}") for s in sums],
    )
    inside = (
        Window.partitionBy("_slice", *by)
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    match = F.col("_slice") == F.col("_s")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    out = ranged
    for s in sums:
        out = out.withColumn(f"_in_{s}", F.sum(s).over(inside))
    return out.join(offsets, match, "inner").select(
        *df.columns,
        *[(F.col(f"_before_{s}") + F.col(f"_in_{s}")).alias(f"cum_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums],
    )


def seeded_rank(
    df: DataFrame,
    by: list[str],
    ident: str,
    seed: int,
    buckets: int = 4096,
    keep: int | Column | None = None,
) -> DataFrame:
    """Adds ``rank`` (1..n in a random but reproducible order) and ``group_rows``.

    ``ident`` identifies a row. Its hash is uniform, so bucket ``floor(u * buckets)``
    holds an equal share of every group, however large the group is; only rows of
    one bucket are sorted together. With ``keep``, buckets that start after the
    wanted number of rows are dropped before the sort.
    """
    drawn = df.withColumn("_u", seeded_uniform(seed, ident)).withColumn(
        "_bucket", F.floor(F.col("_u") * buckets).cast("int")
    )
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    offsets = (
        drawn.groupBy(*by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(b).alias(f"_by_{b}") for b in by],
            F.col("_bucket").alias("_b"),
            F.coalesce(
                F.sum("_n").over(
                    group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_before"),
            F.sum("_n").over(group).alias("group_rows"),
        )
    )
    match = F.col("_bucket") == F.col("_b")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    joined = drawn.join(offsets, match, "inner")
    if keep is not None:
        joined = joined.filter(F.col("_before") < keep)
    inside = Window.partitionBy(*by, "_bucket").orderBy("_u", ident)
    ranked = joined.withColumn("rank", F.col("_before") + F.row_number().over(inside))
    if keep is not None:
        ranked = ranked.filter(F.col("rank") <= keep)
    return ranked.select(*df.columns, "rank", "group_rows")


def unpivot(df: DataFrame, by: list[str], cols: list[str], as_type: str) -> DataFrame:
    """One row per (row, column): ``column``, ``value``."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast(as_type).alias("value")) for c in cols]
    )
    return df.select(*by, F.explode(cells).alias("_cell")).select(*by, "_cell.column", "_cell.value")


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None
) -> DataFrame:
    """Exact interpolated quantiles: one row per (group, ``column``) with array ``q``.

    The built-in ``percentile`` keeps every distinct value of a group in one task;
    here distinct values are counted, ranged and cumulated in slices. Nulls are
    ignored. All columns share the same passes.
    """
    by = by or []
    values = (
        unpivot(df, by, cols, "double")
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cum = running_totals(values, [*by, "column"], ["value"], ["n"])
    first = F.col("cum_n") - F.col("n")

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("cum_n") > index) & (first <= index), F.col("value")))

    picks = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("total_n") - 1)
        picks += [
            at(F.floor(pos)).alias(f"_lo{i}"),
            at(F.ceil(pos)).alias(f"_hi{i}"),
            F.max(pos - F.floor(pos)).alias(f"_w{i}"),
        ]
    picked = cum.groupBy(*by, "column").agg(F.max("total_n").alias("n"), *picks)
    q = F.array(
        *[
            F.col(f"_lo{i}") + F.col(f"_w{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
            for i in range(len(probs))
        ]
    )
    return picked.select(*by, "column", "n", q.alias("q"))
