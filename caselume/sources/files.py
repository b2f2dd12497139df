"""Delimited text, JSON lines, Parquet and CSV."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules

_BAD = "_bad_line"
#: A character that no text holds.
_NO_SEPARATOR = "\u0001"


def _column_names(line: str, sep: str) -> tuple[str, ...]:
    """Names of a header line, stripped and lower-cased; an empty or repeated one takes its place as a name or suffix."""
    names = [n.strip().lower() or f"_c{i}" for i, n in enumerate(line.split(sep))]
    return tuple(f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names))


def _first_row(batches):
    for rows in batches:
        if len(rows):
            yield rows.iloc[:1]
            return  # the rest of the partition is not read


def headers_of(spark: SparkSession, path: str, sep: str = rules.SEPARATOR, encoding: str = rules.ENCODING) -> dict[tuple[str, ...], list[str]]:
    """The files of a path or glob by their header, in order of the file names; a file without a line has none.

    One job, however many files there are: every file begins a partition of its own, and one line of it is read.
    """
    size = "spark.sql.files.maxPartitionBytes"
    settings = {"spark.sql.files.openCostInBytes": spark.conf.get(size), size: spark.conf.get(size), "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        reader = spark.read.option("encoding", encoding).option("quote", "").option("sep", _NO_SEPARATOR)
        lines = reader.schema("line string").csv(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "line")
        firsts = lines.mapInPandas(_first_row, "file string, start long, line string").filter("start = 0").collect()  # a row for each file
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out: dict[tuple[str, ...], list[str]] = {}
    for file, _, line in sorted(firsts):
        out.setdefault(_column_names(line, sep), []).append(file)
    return out


def _fields(spark: SparkSession, paths: list[str], sep: str, encoding: str) -> DataFrame:
    """Lines as ``line`` and ``f``, their fields. Whole lines come first (no text holds
    the separator used for that), so that a line can be judged by its number of fields."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("quote", "").option("sep", _NO_SEPARATOR)
    return reader.schema("line string").csv(paths).withColumn("f", F.split("line", f"[{sep}]"))


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    limit: int | None = None,
    order_by: str | None = None,
    sep: str = rules.SEPARATOR,
    encoding: str = rules.ENCODING,
    tolerant: bool = False,
    lost: list[Observation] | None = None,
) -> DataFrame:
    """A delimited table as text columns with normalised names.

    Every file is read by its own header, and columns meet by name: one that a file lacks is
    null there. Nothing is inferred, and an empty field is null; short lines are filled with nulls. A
    line with too many fields is an error, or with ``tolerant`` left out; ``bad_lines`` lists those, and observations
    added to ``lost`` count them (``n``) in the scan of the first action on the result.
    ``limit`` with ``order_by`` takes the first rows in key order.
    """
    df = None
    for names, paths in headers_of(spark, path, sep, encoding).items():
        lines = _fields(spark, paths, sep, encoding)
        if tolerant:
            if lost is not None:
                lost.append(Observation(f"bad_lines_{uuid.uuid4().hex}"))
                lines = lines.observe(lost[-1], F.count(F.when(F.size("f") > len(names), 1)).alias("n"))
            lines = lines.filter(F.size("f") <= len(names))
        else:
            told = F.concat(F.lit("line with too many fields: "), F.col("line"))
            lines = lines.filter(F.assert_true(F.size("f") <= len(names), told).isNull())
        part = lines.select(*[F.nullif(F.get("f", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])
        df = part if df is None else df.unionByName(part, allowMissingColumns=True)
    if df is None:
        raise FileNotFoundError(path)
    if columns:
        df = df.select(*[c for c in df.columns if c in set(columns)])
    if limit is not None:
        df = (df.orderBy(order_by) if order_by else df).limit(limit)
    return df


def bad_lines(spark: SparkSession, path: str, sep: str = rules.SEPARATOR, encoding: str = rules.ENCODING) -> DataFrame:
    """The lines that ``tolerant`` leaves out: ``file``, ``line``."""
    out = spark.createDataFrame([], "file string, line string")
    for names, paths in headers_of(spark, path, sep, encoding).items():
        lines = _fields(spark, paths, sep, encoding).filter(F.size("f") > len(names))
        out = out.union(lines.select(F.input_file_name(), "line"))
    return out


def write_delimited(df: DataFrame, path: str, sep: str = rules.SEPARATOR, encoding: str = rules.ENCODING) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", "")
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_json_lines(df: DataFrame, path: str, source: str | None = None) -> None:
    """JSON lines, with the name of the source table when one is given."""
    out = df.withColumn("table", F.lit(source)) if source else df
    out.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines of a file or folder; lines that do not parse are dropped.

    Files whose name starts with ``_`` or ``.`` are skipped by Spark itself.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*wanted.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = spark.read.text(path).select(F.from_json("value", full, options).alias("r")).select("r.*")
    return parsed.filter(F.col(_BAD).isNull()).drop(_BAD)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """A written signal table, as the lookup side of ``attach_signals``."""
    raw = spark.read.option("header", True).csv(path)
    numbers = [c for c in raw.columns if c not in ("drugname", "pt")]
    return raw.select("drugname", "pt", *[F.col(c).try_cast("double").alias(c) for c in numbers])


def write_json(df: DataFrame, path: str) -> None:
    """A small result as JSON documents, one per row."""
    df.write.mode("overwrite").json(path)
