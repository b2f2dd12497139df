"""Stratified, reproducible splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.scale import seeded_rank


def stratified_holdout(
    df: DataFrame, label: str, ident: str, test_share: float = 0.2, seed: int = rules.SEED
) -> DataFrame:
    """Adds ``is_test``: the same share of every class, chosen by seeded rank."""
    ranked = seeded_rank(df, [label], ident, seed)
    return ranked.select(
        *df.columns, (F.col("rank") <= F.round(F.col("group_rows") * test_share)).alias("is_test")
    )


def stratified_folds(
    df: DataFrame, label: str, ident: str, folds: int = 5, seed: int = rules.SEED
) -> DataFrame:
    """Adds ``fold`` 0..folds-1, every class spread evenly."""
    ranked = seeded_rank(df, [label], ident, seed)
    return ranked.select(*df.columns, ((F.col("rank") - 1) % folds).cast("int").alias("fold"))
