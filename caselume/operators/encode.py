"""Ordinal codes of sorted categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.scale import running_totals


def fit_ordinal(df: DataFrame, col: str) -> DataFrame:
    """Dictionary ``(value, code)``: the sorted distinct values, numbered from 0.

    Numbered by range slices, so a dictionary of any size is built without one
    global sort task. Write it with ``df.write.parquet`` to keep it with a model.
    """
    values = df.select(F.col(col).alias("value")).filter(F.col(col).isNotNull()).distinct()
    ranked = running_totals(values.withColumn("one", F.lit(1)), [], ["value"], ["one"])
    return ranked.select("value", (F.col("cum_one") - 1).cast("double").alias("code"))


def encode(df: DataFrame, dictionary: DataFrame, col: str, out: str) -> DataFrame:
    """Attach the code of a value; values outside the dictionary get -1."""
    side = dictionary.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    return (
        df.join(side, F.col(col) == F.col("_value"), "left")
        .withColumn(out, F.coalesce("_code", F.lit(rules.UNKNOWN_CODE)))
        .drop("_value", "_code")
    )
