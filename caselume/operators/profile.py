"""Descriptive profiles: tables, columns, frequencies, series, pivots, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import exact_quantiles, unpivot
from ..functions.text import from_table, month_key
from .clean import split_by_type


def _share(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), digits)


def table_profile(df: DataFrame, key: str, table: str) -> DataFrame:
    """One row: rows, columns, null cells, duplicate rows, distinct keys and shares.

    Copies are folded into (row, count) first, so equal rows meet after the
    map-side count and every figure comes from that one pass.
    """
    cols = df.columns
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in cols), F.lit(0))
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    per_key = rows.groupBy(key).agg(
        F.sum("_n").alias("_rows"),
        F.count(F.lit(1)).alias("_distinct_rows"),
        F.sum(nulls * F.col("_n")).alias("_nulls"),
    )
    wide = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("null_cells"),
        (F.sum("_rows") - F.sum("_distinct_rows")).alias("duplicate_rows"),
        F.count(key).alias("distinct_keys"),
    )
    return wide.select(
        F.lit(table).alias("table"),
        "rows",
        F.lit(len(cols)).cast("bigint").alias("columns"),
        "null_cells",
        _share(F.col("null_cells"), F.col("rows") * len(cols)).alias("pct_null"),
        "duplicate_rows",
        _share(F.col("duplicate_rows"), F.col("rows")).alias("pct_duplicate"),
        "distinct_keys",
    )


def column_profile(df: DataFrame, key: str, table: str, approximate: bool = False) -> DataFrame:
    """One row per column: type, nulls, null share, distinct values, whether it is the key.

    Exact distinct counts fold equal values before they are shuffled. The
    approximate form is one aggregate without any shuffle of values.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    if approximate:
        cells = []
        wide = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(c).alias(f"_n_{c}") for c in df.columns],
            *[F.approx_count_distinct(c).alias(f"_d_{c}") for c in df.columns],
        )
        for c in df.columns:
            cells.append(
                F.struct(
                    F.lit(c).alias("column"),
                    (F.col("_rows") - F.col(f"_n_{c}")).alias("nulls"),
                    F.col(f"_d_{c}").alias("distinct_values"),
                    F.col("_rows").alias("rows"),
                )
            )
        per = wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    else:
        counted = (
            unpivot(df, [], df.columns, "string")
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        per = counted.groupBy("column").agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
            F.sum("n").alias("rows"),
        )
    return per.select(
        F.lit(table).alias("table"),
        "column",
        from_table("column", types).alias("type"),
        "nulls",
        _share(F.col("nulls"), F.col("rows")).alias("pct_null"),
        "distinct_values",
        (F.col("column") == key).alias("is_key"),
    )


def value_share(
    df: DataFrame, col: str, null_label: str, labels: dict | None = None, default: str | None = None
) -> DataFrame:
    """Frequency and share of every value, nulls under their own label."""
    counts = df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit(null_label)).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counts.agg(F.sum("n").alias("t")).scalar()
    out = counts.withColumn("pct", _share(F.col("n"), total))
    if labels:
        out = out.withColumn("label", from_table("value", labels, default))
    return out.orderBy(F.desc("n"), "value")


def top_n(df: DataFrame, col: str, n: int) -> DataFrame:
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.orderBy(F.desc("n"), "value").limit(n)


_QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per group.

    Moments come from per-value counts, so a group of any size is reduced before
    it is shuffled.
    """
    by = by or []
    clean = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    basic = clean.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    quart = exact_quantiles(clean, ["_v"], _QUARTILES, by).select(
        *by,
        F.element_at("q", 1).alias("q25"),
        F.element_at("q", 2).alias("median"),
        F.element_at("q", 3).alias("q75"),
    )
    names = [*by, "n", "mean", "std", "min", "q25", "median", "q75", "max"]
    if by:
        return basic.join(quart, by).select(*names)
    three = quart.select(F.struct("q25", "median", "q75")).scalar()
    return basic.withColumn("_q", three).select("*", "_q.*").select(*names)


def per_case_describe(df: DataFrame, case: str) -> DataFrame:
    """Distribution of the number of rows per case."""
    per_case = df.groupBy(case).agg(F.count(F.lit(1)).alias("rows_per_case"))
    return describe(per_case, "rows_per_case")


def histogram(df: DataFrame, value: str, bins: int, low=None, high=None, clip_high=None) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins included."""
    v = F.col(value).cast("double")
    if clip_high is not None:
        v = F.least(v, F.lit(float(clip_high)))
    clean = df.select(v.alias("_v")).filter(F.col("_v").isNotNull())
    ends = clean.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    least = F.lit(float(low)) if low is not None else ends.getField("lo")
    most = F.lit(float(high)) if high is not None else ends.getField("hi")
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), least.alias("_lo"), most.alias("_hi")
    ).select(
        "bin",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins).alias("bin_low"),
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins).alias("bin_high"),
    )
    bounded = clean.select("_v", least.alias("_lo"), most.alias("_hi")).filter(
        (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    )
    width = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    spot = F.coalesce(F.floor((F.col("_v") - F.col("_lo")) / width * bins), F.lit(0))
    counts = bounded.groupBy(F.least(spot, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return edges.join(counts, "bin", "left").select(
        "bin", "bin_low", "bin_high", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def monthly_series(df: DataFrame, day: str) -> DataFrame:
    """Rows per month of a ``yyyymm[dd]`` text; dates that do not parse are left out."""
    return (
        df.select(month_key(day).alias("month"))
        .filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(df: DataFrame, col: str, n: int) -> list:
    """The n most frequent values, as a list of at most n entries."""
    return [r["value"] for r in top_n(df, col, n).collect()]


def pivot_counts(
    df: DataFrame, rows: str, cols: str, row_values: list | None = None, col_values: list | None = None
) -> DataFrame:
    """Cross table of counts, zero where a pair does not occur.

    The values are passed in (usually the top n), so the filter runs before the
    shuffle and the schema is known without a job.
    """
    if row_values is not None:
        df = df.filter(F.col(rows).isin(*row_values))
    if col_values is not None:
        df = df.filter(F.col(cols).isin(*col_values))
    pairs = df.groupBy(rows, cols).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy(rows).pivot(cols, col_values).agg(F.sum("_n")).na.fill(0)


def top_pivot(df: DataFrame, rows: str, cols: str, n_rows: int = 10, n_cols: int = 10) -> DataFrame:
    return pivot_counts(df, rows, cols, top_values(df, rows, n_rows), top_values(df, cols, n_cols))


def month_pivot(df: DataFrame, day: str, group: str, n: int = 10) -> DataFrame:
    """Months by the n most frequent groups."""
    dated = df.select(month_key(day).alias("month"), group).filter(F.col("month").isNotNull())
    return pivot_counts(dated, "month", group, col_values=top_values(df, group, n))


def duplicate_stats(df: DataFrame, key: str, table: str) -> DataFrame:
    """Duplicates by whole row and by key, as counts and shares."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    keys = rows.groupBy(key).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    wide = keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_n") - F.sum("_rows"), F.lit(0)).alias("full_duplicates"),
        F.coalesce(F.sum("_n") - F.count(F.lit(1)), F.lit(0)).alias("key_duplicates"),
    )
    return wide.select(
        F.lit(table).alias("table"),
        "rows",
        "full_duplicates",
        _share(F.col("full_duplicates"), F.col("rows"), 4).alias("pct_full"),
        "key_duplicates",
        _share(F.col("key_duplicates"), F.col("rows"), 4).alias("pct_key"),
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once and how many rows beyond the first they have."""
    return (
        df.groupBy(key)
        .agg((F.count(F.lit(1)) - 1).alias("extra_rows"))
        .filter(F.col("extra_rows") > 0)
    )


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return (
        unpivot(df, [], cols, "string")
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )


def class_counts(df: DataFrame, label: str, valid: list | None = None) -> DataFrame:
    if valid:
        df = df.filter(F.col(label).isin(*valid))
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label: str, valid: list | None = None) -> DataFrame:
    """One row: classes, largest and smallest class, imbalance ratio, minority share."""
    counts = class_counts(df, label, valid)
    return counts.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("classes"),
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("majority_class"),
        F.max("n").alias("majority_rows"),
        F.min_by(label, F.struct(F.col("n"), F.col(label))).alias("minority_class"),
        F.min("n").alias("minority_rows"),
        (F.max("n") / F.greatest(F.min("n"), F.lit(1))).alias("ratio"),
        (F.min("n") / F.sum("n")).alias("minority_share"),
    )


def class_table(df: DataFrame, label: str) -> DataFrame:
    """Count, share and ratio to the first class, per class."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("n").alias("t")).scalar()
    first = counts.agg(F.min_by("n", label).alias("f")).scalar()
    return counts.select(
        label,
        "n",
        F.round(F.col("n") * 100.0 / total, 1).alias("pct"),
        F.round(first / F.col("n"), 1).alias("ratio"),
    ).orderBy(label)


def feature_mix(df: DataFrame, exclude: tuple[str, ...], approximate: bool = False) -> DataFrame:
    """How many numeric and text features, and how many values the text ones take."""
    numeric, text = split_by_type(df, exclude)
    spark = df.sparkSession
    if not text:
        stats = spark.range(1).select(F.lit(0.0).alias("mean_cardinality"), F.lit(0).cast("bigint").alias("max_cardinality"))
    elif approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in text])
        stats = unpivot(wide, [], text, "bigint").agg(
            F.avg("value").alias("mean_cardinality"), F.max("value").alias("max_cardinality")
        )
    else:
        stats = distinct_counts(df, text).agg(
            (F.sum("distinct_values") / len(text)).alias("mean_cardinality"),
            F.max("distinct_values").alias("max_cardinality"),
        )
    total = max(len(numeric) + len(text), 1)
    return stats.select(
        F.lit(len(numeric)).cast("bigint").alias("numeric_features"),
        F.lit(len(text)).cast("bigint").alias("text_features"),
        F.lit(len(text) / total).alias("text_share"),
        F.coalesce("mean_cardinality", F.lit(0.0)).alias("mean_cardinality"),
        F.coalesce("max_cardinality", F.lit(0)).alias("max_cardinality"),
    )
