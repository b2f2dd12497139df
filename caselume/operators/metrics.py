"""Classifier metrics from prediction rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import running_totals


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: list) -> DataFrame:
    """``(actual, predicted, n)`` for every pair of classes, zero cells included."""
    kind = df.schema[label].dataType
    grid = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("actual")
    ).select("actual", F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("predicted"))
    counts = df.groupBy(F.col(label).alias("actual"), F.col(prediction).cast(kind).alias("predicted")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n")
    )


def _per_class(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, 0 where undefined."""
    both = F.array(
        F.struct(F.col("actual").alias("class"), F.lit(1).alias("a"), F.lit(0).alias("p")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).alias("a"), F.lit(1).alias("p")),
    )
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    long = matrix.select("n", hit.alias("hit"), F.explode(both).alias("e")).select("n", "hit", "e.*")
    sums = long.groupBy("class").agg(
        F.sum(F.col("hit") * F.col("a")).alias("tp"),
        F.sum(F.col("n") * F.col("p")).alias("predicted_rows"),
        F.sum(F.col("n") * F.col("a")).alias("support"),
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("tp", "predicted_rows"), zero)
    recall = F.coalesce(F.try_divide("tp", "support"), zero)
    f1 = F.coalesce(F.try_divide(F.col("tp") * 2, F.col("predicted_rows") + F.col("support")), zero)
    return sums.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "tp"
    )


def classification_report(df: DataFrame, label: str, prediction: str, classes: list) -> DataFrame:
    """Rows per class plus ``macro``, ``weighted`` and ``accuracy``."""
    per = _per_class(confusion_matrix(df, label, prediction, classes))
    total = F.nullif(F.sum("support"), F.lit(0))

    def weighted(c: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), total), F.lit(0.0))

    accuracy = F.coalesce(F.try_divide(F.sum("tp"), total), F.lit(0.0))
    summary = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        weighted("precision").alias("wp"), weighted("recall").alias("wr"), weighted("f1").alias("wf"),
        accuracy.alias("acc"), F.sum("support").alias("n"),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                F.col(f).alias("f1"), F.col("n").alias("support"),
            )
            for name, p, r, f in (
                ("macro", "mp", "mr", "mf"), ("weighted", "wp", "wr", "wf"), ("accuracy", "acc", "acc", "acc")
            )
        ]
    )
    tail = summary.select(F.explode(rows).alias("r")).select("r.*")
    head = per.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    return head.unionByName(tail)


def macro_f1(df: DataFrame, label: str, prediction: str, classes: list) -> DataFrame:
    per = _per_class(confusion_matrix(df, label, prediction, classes))
    return per.agg(F.avg("f1").alias("macro_f1"), F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"))


def one_vs_rest(df: DataFrame, label: str, scores: str, classes: list) -> DataFrame:
    """Score array to rows ``(class, score, positive)``, one per class."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                F.get(scores, F.lit(i)).alias("score"),
                (F.col(label) == F.lit(c)).alias("positive"),
            )
            for i, c in enumerate(classes)
        ]
    )
    return df.select(F.explode(cells).alias("r")).select("r.*")


def _score_steps(long: DataFrame, by: str, score: str, positive: str) -> DataFrame:
    """Cumulated positives and negatives by falling score, one row per distinct score."""
    steps = long.groupBy(by, score).agg(
        F.sum(F.when(F.col(positive), 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(positive), 0).otherwise(1)).alias("neg"),
    )
    return running_totals(steps, [by], [F.desc(score)], ["pos", "neg"])


def roc_auc(long: DataFrame, by: str = "class", score: str = "score", positive: str = "positive") -> DataFrame:
    """Area under the ROC curve per class by rank sums; ties count half."""
    steps = _score_steps(long, by, score, positive)
    below = F.col("total_neg") - F.col("cum_neg") + F.col("neg") / 2.0
    return steps.groupBy(by).agg(
        F.try_divide(F.sum(F.col("pos") * below), F.max(F.col("total_pos") * F.col("total_neg") * 1.0)).alias("auc"),
        F.max("total_pos").alias("positives"),
        F.max("total_neg").alias("negatives"),
    )


def macro_auc(long: DataFrame) -> DataFrame:
    return roc_auc(long).agg(F.avg("auc").alias("macro_auc"))


def roc_curve(
    long: DataFrame, points: int = 500, by: str = "class", score: str = "score", positive: str = "positive"
) -> DataFrame:
    """``(class, fpr, tpr)`` on an even grid of false-positive rates.

    Each step of the curve emits the grid points it covers, so the interpolation
    needs no join and no ordered scan.
    """
    steps = _score_steps(long, by, score, positive).filter((F.col("total_pos") > 0) & (F.col("total_neg") > 0))
    last = points - 1
    x1 = F.col("cum_neg") / F.col("total_neg")
    y1 = F.col("cum_pos") / F.col("total_pos")
    x0 = (F.col("cum_neg") - F.col("neg")) / F.col("total_neg")
    y0 = (F.col("cum_pos") - F.col("pos")) / F.col("total_pos")
    first, stop = F.ceil(x0 * last), F.ceil(x1 * last) - 1
    spots = F.when(stop >= first, F.sequence(first, stop)).otherwise(F.array().cast("array<bigint>"))
    inner = steps.select(
        by, x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), F.explode(spots).alias("i")
    )
    slope = F.coalesce(F.try_divide(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")), F.lit(0.0))
    body = inner.select(
        by, "i", (F.col("y0") + slope * (F.col("i") / last - F.col("x0"))).alias("tpr")
    )
    end = steps.select(by).distinct().select(by, F.lit(last).cast("bigint").alias("i"), F.lit(1.0).alias("tpr"))
    return body.unionByName(end).select(by, (F.col("i") / last).alias("fpr"), "tpr")


def mean_roc_curve(long: DataFrame, points: int = 500) -> DataFrame:
    return roc_curve(long, points).groupBy("fpr").agg(F.avg("tpr").alias("tpr"))


def compare_models(reports: dict[str, DataFrame]) -> DataFrame:
    """Union of tagged one-row score tables."""
    tagged = [df.withColumn("model", F.lit(name)) for name, df in reports.items()]
    return functools.reduce(DataFrame.unionByName, tagged)


def best_model(comparison: DataFrame, metric: str) -> DataFrame:
    """Name and score of the model with the highest metric (first name on ties)."""
    return comparison.agg(
        F.min_by("model", F.struct(-F.col(metric), F.col("model"))).alias("model"), F.max(metric).alias(metric)
    )
