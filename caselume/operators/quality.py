"""What to do about a column, and how to balance a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules


def column_actions(profile: DataFrame) -> DataFrame:
    """Adds the planned ``action`` to a column profile, from the null share and the type."""
    pct, text = F.col("pct_null"), F.col("type") == "string"
    action = F.when(F.col("is_key"), rules.COLUMN_ACTION_KEY)
    for below, for_text, for_numbers in rules.COLUMN_ACTIONS:
        action = action.when(pct == 0 if below is None else pct < below, F.when(text, for_text).otherwise(for_numbers))
    action = action.otherwise(rules.COLUMN_ACTION_ELSE)
    grade = (
        F.when(F.col("is_key"), "key")
        .when(pct == 0, "complete")
        .when(pct < 2, "few nulls")
        .when(pct < 10, "moderate nulls")
        .when(pct < 60, "many nulls")
        .otherwise("mostly null")
    )
    return profile.withColumn("action", action).withColumn("reason", grade)


def plan_totals(actions: DataFrame) -> DataFrame:
    a = F.col("action")

    def count(cond: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(name)

    return actions.agg(
        F.count(F.lit(1)).alias("columns"),
        count(a != "ninguna", "need_action"),
        count(a == "eliminar_columna", "to_drop"),
        count(a.startswith("imputar"), "to_impute"),
        count(a == "normalizar", "to_normalize"),
    )


def recommended_techniques(
    ratio: Column, rows: Column, text_share: Column, minority_share: Column, cardinality: Column
) -> Column:
    """Ordered array of balancing techniques for the figures of one table."""
    true_of = {
        "any": F.lit(True),
        "rare": minority_share < rules.RARE_CLASS_SHARE,
        "common": minority_share >= rules.RARE_CLASS_SHARE,
        "nominal": (text_share >= rules.NOMINAL_SHARE) | (cardinality > rules.CARDINALITY_LIMIT),
        "skewed": ratio >= rules.SMOTE_RATIO,
        "high": ratio >= rules.HYBRID_RATIO,
        "between": (ratio >= rules.SMOTE_RATIO) & (ratio < rules.HYBRID_RATIO),
    }
    by_size = {
        size: F.array_compact(F.array(*[F.when(true_of[what], F.lit(name)) for what, name in rows_]))
        for size, rows_ in rules.TECHNIQUES_BY_SIZE.items()
    }
    chosen = (
        F.when(ratio <= rules.BALANCED_RATIO, F.array().cast("array<string>"))
        .when(rows < rules.SMALL_ROWS, by_size["small"])
        .when(rows >= rules.LARGE_ROWS, by_size["large"])
        .otherwise(by_size["medium"])
    )
    return F.array_distinct(chosen)


def winning_technique(recommended: Column) -> Column:
    """First of the fixed priority list that is recommended; null when none is."""
    return F.get(F.array_intersect(F.array(*[F.lit(t) for t in rules.TECHNIQUE_PRIORITY]), recommended), F.lit(0))


def reason(ratio: Column, minority_share: Column, text_share: Column, cardinality: Column) -> Column:
    """The figures that decided, each with its value."""
    figures = (
        ("class ratio", ratio, ratio >= rules.SMOTE_RATIO),
        ("minority share", minority_share, minority_share < rules.RARE_CLASS_SHARE),
        ("share of text columns", text_share, text_share >= rules.NOMINAL_SHARE),
        ("mean cardinality", cardinality, cardinality > rules.CARDINALITY_LIMIT),
    )
    told = [F.when(fired, F.concat(F.lit(f"{name} "), F.format_number(value, 3))) for name, value, fired in figures]
    return F.concat_ws(", ", *told)


def recommend(balance: DataFrame, mix: DataFrame) -> DataFrame:
    """Techniques, winner and label from a class-balance row and a feature-mix row."""
    from ..functions.text import from_table

    # Both inputs are one row, so the text features ride along as scalars.
    row = balance.withColumn("text_share", mix.select("text_share").scalar()).withColumn(
        "mean_cardinality", mix.select("mean_cardinality").scalar()
    )
    rec = recommended_techniques(
        F.col("ratio"), F.col("rows"), F.col("text_share"), F.col("minority_share"), F.col("mean_cardinality")
    )
    named = row.select("rows", "ratio", "minority_share", "text_share", "mean_cardinality", rec.alias("techniques"))
    win = named.withColumn("winner", winning_technique(F.col("techniques")))
    return (
        win.withColumn("alternatives", F.filter("techniques", lambda t: t != F.col("winner")))
        .withColumn("label", from_table("winner", rules.TECHNIQUE_LABELS))
        .withColumn("reason", reason(*[F.col(c) for c in ("ratio", "minority_share", "text_share", "mean_cardinality")]))
    )
