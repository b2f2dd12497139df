"""Class balancing: undersampling, synthetic oversampling, editing."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.random import seeded_uniform
from ..functions.scale import running_totals, seeded_rank, stage
from .clean import impute_median
from .knn import nearest_neighbors
from .profile import class_counts

MAX_CLASSES = 1000


def class_sizes(df: DataFrame, label: str) -> dict:
    """Rows per class. A label with very many values is a mistake, not a class."""
    rows = class_counts(df, label).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return dict(sorted((r[label], r["n"]) for r in rows))


def _majority(sizes: dict):
    return max(sizes, key=lambda c: (sizes[c], -list(sizes).index(c)))


def _minority(sizes: dict):
    return min(sizes, key=lambda c: (sizes[c], list(sizes).index(c)))


def needed_rows(sizes: dict) -> dict:
    """Synthetic rows that bring every class to the size of the largest."""
    most = max(sizes.values())
    return {c: most - n for c, n in sizes.items() if n < most}


def _complete(df: DataFrame, ident: str, features: list[str], label: str, extra: tuple = ()) -> DataFrame:
    """The needed columns, written once, with the median for missing feature values.

    The steps of a technique read them several times; what they were computed from
    (joins, texts) is read once.
    """
    df = stage(df.select(ident, *features, *extra, label))
    row = df.agg(*[F.count(F.when(F.col(f).isNull(), 1)).alias(f) for f in features]).first()
    missing = [f for f in features if row[f]]
    return impute_median(df, missing) if missing else df


def _per_class(label: str, values: dict, default) -> Column:
    out = F.lit(default)
    for c, v in values.items():
        out = F.when(F.col(label) == F.lit(c), F.lit(v)).otherwise(out)
    return out


# --- undersampling -----------------------------------------------------------------


def undersample(
    df: DataFrame, label: str, ident: str, seed: int = rules.SEED, per_class: bool = False
) -> DataFrame:
    """All rows of the smallest class and as many drawn from the others pooled.

    ``per_class`` draws that many from each other class instead.
    """
    sizes = class_sizes(df, label)
    least = _minority(sizes)
    rest = df.filter(F.col(label) != F.lit(least))
    drawn = seeded_rank(rest, [label] if per_class else [], ident, seed, keep=sizes[least])
    return df.filter(F.col(label) == F.lit(least)).unionByName(drawn.select(*df.columns))


def tomek_links(
    df: DataFrame, ident: str, features: list[str], label: str, **knn
) -> DataFrame:
    """Pairs of different class that are each other's nearest row: ``(a, b, label_a, label_b)``, a < b."""
    filled = _complete(df, ident, features, label)
    near = nearest_neighbors(filled, ident, features, 1, label, **knn)
    one = near.select(F.col(ident).alias("a"), F.element_at("neighbors", 1).alias("n"))
    one = one.select("a", F.col("n.id").alias("b"), F.col("n.y").alias("label_b"))
    other = one.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("label_b").alias("label_a"))
    kind = df.schema[label].dataType
    return (
        one.join(other, ["a", "b"])
        .filter((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")))
        .select("a", "b", F.col("label_a").cast(kind).alias("label_a"), F.col("label_b").cast(kind).alias("label_b"))
    )


def remove_tomek(df: DataFrame, ident: str, features: list[str], label: str, **knn) -> DataFrame:
    """Drop the members of Tomek links that are not of the smallest class."""
    least = _minority(class_sizes(df, label))
    links = tomek_links(df, ident, features, label, **knn)
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("id"), F.col("label_a").alias("y")),
                F.struct(F.col("b").alias("id"), F.col("label_b").alias("y")),
            )
        ).alias("e")
    )
    gone = ends.filter(F.col("e.y") != F.lit(least)).select(F.col("e.id").alias(ident)).distinct()
    return df.join(gone, ident, "left_anti")


def _vote(neighbors: Column, kind) -> Column:
    """Most frequent class among the neighbours, the smallest on ties."""
    ys = F.transform(neighbors, lambda n: n["y"].cast(kind))
    tally = F.transform(
        F.array_distinct(ys),
        lambda y: F.struct((-F.size(F.filter(ys, lambda v: v == y))).alias("n"), y.alias("y")),
    )
    return F.element_at(F.array_sort(tally), 1)["y"]


def edited_neighbors(
    df: DataFrame,
    ident: str,
    features: list[str],
    label: str,
    k: int = rules.ENN_NEIGHBORS,
    classes: str = "all",
    **knn,
) -> DataFrame:
    """Drop rows whose class differs from the vote of their k nearest rows.

    ``classes="not_minority"`` never drops rows of the smallest class.
    """
    near = nearest_neighbors(_complete(df, ident, features, label), ident, features, k, label, **knn)
    kind = df.schema[label].dataType
    votes = near.select(ident, _vote(F.col("neighbors"), kind).alias("_vote"))
    keep = F.col("_vote").isNull() | (F.col("_vote") == F.col(label))
    if classes == "not_minority":
        keep = keep | (F.col(label) == F.lit(_minority(class_sizes(df, label))))
    return df.join(votes, ident).filter(keep).select(*df.columns)


# --- synthetic rows ----------------------------------------------------------------


def _wanted(spark: SparkSession, label: str, need: dict, kind: str) -> DataFrame:
    """One row ``(j, label)`` per synthetic row, generated in parallel."""
    parts, start = [], 0
    for c, n in need.items():
        if n > 0:
            parts.append(spark.range(start, start + n).select(F.col("id").alias("j"), F.lit(c).cast(kind).alias(label)))
        start += max(n, 0)
    if not parts:
        return spark.range(0).select(F.col("id").alias("j"), F.lit(None).cast(kind).alias(label))
    return functools.reduce(DataFrame.unionByName, parts)


def _drawn_parents(
    bases: DataFrame, ident: str, label: str, need: dict, near: DataFrame, seed: int
) -> DataFrame:
    """Every wanted row with a base row of its class and that row's neighbours.

    Base rows are numbered in a seeded order and drawn by number, so the draw is an
    equi-join on (class, number) and no class is gathered anywhere.
    """
    ranked = seeded_rank(bases.select(ident, label), [label], ident, seed)
    parents = ranked.join(near, ident).select(
        F.col(label).alias("_y"), F.col("rank").alias("_rank"), "x", "c", "neighbors"
    )
    sizes = {r[label]: r["n"] for r in bases.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    kind = bases.schema[label].dataType.simpleString()
    need = {c: n for c, n in need.items() if c in sizes}
    wanted = _wanted(bases.sparkSession, label, need, kind).withColumn(
        "_rank",
        F.floor(seeded_uniform(seed, F.lit("base"), F.col("j")) * _per_class(label, sizes, 1)) + 1,
    )
    cols = ["j", label, "x", "c", "neighbors"]
    w = wanted.withColumnRenamed("_rank", "_want")
    return w.join(parents, (F.col(label) == F.col("_y")) & (F.col("_want") == F.col("_rank"))).select(*cols)


def _interpolate(drawn: DataFrame, features: list[str], seed: int) -> DataFrame:
    """A random point between the base row and one of its neighbours.

    A row without neighbours (a class of one) is copied.
    """
    size = F.size("neighbors")
    spot = F.floor(seeded_uniform(seed, F.lit("near"), F.col("j")) * size).cast("int")
    picked = drawn.withColumn("_nx", F.coalesce(F.get("neighbors", spot)["x"], F.col("x"))).withColumn(
        "_gap", seeded_uniform(seed, F.lit("gap"), F.col("j"))
    )
    cols = [
        (F.get("x", F.lit(i)) + F.col("_gap") * (F.get("_nx", F.lit(i)) - F.get("x", F.lit(i)))).alias(f)
        for i, f in enumerate(features)
    ]
    keep = [c for c in picked.columns if c not in ("x", "_nx", "_gap")]
    return picked.select(*keep, *cols)


def _with_originals(
    df: DataFrame, made: DataFrame, ident: str, features: list[str], label: str, extra: tuple = ()
) -> DataFrame:
    """Originals flagged false, synthetic rows true with negative ids."""
    old = df.select(
        F.col(ident).cast("bigint").alias(ident),
        *[F.col(f).cast("double").alias(f) for f in features],
        *extra,
        label,
        F.lit(False).alias("is_synthetic"),
    )
    new = made.select(
        (-F.col("j") - 1).cast("bigint").alias(ident), *features, *extra, label, F.lit(True).alias("is_synthetic")
    )
    return old.unionByName(new)


def smote(
    df: DataFrame,
    ident: str,
    features: list[str],
    label: str,
    k: int = rules.SMOTE_NEIGHBORS,
    seed: int = rules.SEED,
    **knn,
) -> DataFrame:
    """Raise every class to the size of the largest by interpolation inside the class.

    Returns ``ident, features, label, is_synthetic``. The label is never a distance
    feature. A class with at most k rows uses all its other rows as neighbours.
    """
    df = _complete(df, ident, features, label)
    need = needed_rows(class_sizes(df, label))
    small = df.filter(F.col(label).isin(*need)) if need else df.limit(0)
    near = nearest_neighbors(small, ident, features, k, label, within_label=True, **knn)
    drawn = _drawn_parents(small, ident, label, need, near, seed)
    return _with_originals(df, _interpolate(drawn, features, seed), ident, features, label)


def _others(label_text: Column) -> Column:
    return F.size(F.filter("neighbors", lambda n: n["y"] != label_text))


def danger_rows(
    df: DataFrame, ident: str, features: list[str], label: str, classes: list, m: int, **knn
) -> DataFrame:
    """Rows of the given classes with at least half, but not all, neighbours of another class."""
    asked = F.col(label).isin(*classes)
    context = nearest_neighbors(df, ident, features, m, label, queries=asked, **knn)
    joined = df.select(ident, label).join(context, ident)
    others, size = _others(F.col(label).cast("string")), F.size("neighbors")
    return joined.filter((others * 2 >= size) & (others < size)).select(ident, label)


def borderline_smote(
    df: DataFrame,
    ident: str,
    features: list[str],
    label: str,
    k: int = rules.BORDERLINE_NEIGHBORS,
    m: int = rules.BORDERLINE_CONTEXT,
    seed: int = rules.SEED,
    **knn,
) -> DataFrame:
    """SMOTE that starts only from rows near the class border."""
    df = _complete(df, ident, features, label)
    need = needed_rows(class_sizes(df, label))
    if not need:
        return _with_originals(df, smote_none(df, features, label), ident, features, label)
    danger = stage(danger_rows(df, ident, features, label, list(need), m, **knn))
    small = df.filter(F.col(label).isin(*need))
    marked = small.join(danger.select(F.col(ident).alias("_d")), F.col(ident) == F.col("_d"), "left")
    near = nearest_neighbors(
        marked, ident, features, k, label, within_label=True, queries=F.col("_d").isNotNull(), **knn
    )
    drawn = _drawn_parents(danger, ident, label, need, near, seed)
    return _with_originals(df, _interpolate(drawn, features, seed), ident, features, label)


def smote_none(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """No synthetic rows, with the columns the union expects."""
    return df.limit(0).select(
        F.lit(0).cast("bigint").alias("j"), label, *[F.col(f).cast("double").alias(f) for f in features]
    )


def adasyn(
    df: DataFrame,
    ident: str,
    features: list[str],
    label: str,
    k: int = rules.ADASYN_NEIGHBORS,
    seed: int = rules.SEED,
    chunk: int = 10_000,
    **knn,
) -> DataFrame:
    """More synthetic rows where more neighbours are of another class.

    A row's quota is its share of difficulty times the class need, rounded half to
    even, so the total can differ from the need by rounding.
    """
    df = _complete(df, ident, features, label)
    need = needed_rows(class_sizes(df, label))
    if not need:
        return _with_originals(df, smote_none(df, features, label), ident, features, label)
    asked = F.col(label).isin(*need)
    context = nearest_neighbors(df, ident, features, k, label, queries=asked, **knn)
    hard = df.select(ident, label).join(context, ident)
    hard = stage(hard.select(ident, label, _others(F.col(label).cast("string")).alias("others")))
    sums = {r[label]: r["s"] for r in hard.groupBy(label).agg(F.sum("others").alias("s")).collect()}
    share = F.try_divide(
        F.col("others") * _per_class(label, {c: float(n) for c, n in need.items()}, 0.0),
        _per_class(label, {c: float(s) for c, s in sums.items()}, 0.0),
    )
    quotas = hard.withColumn("quota", F.coalesce(F.rint(share), F.lit(0.0)).cast("bigint")).filter("quota > 0")
    # Numbering by running totals gives every synthetic row its own id; large quotas
    # are cut into chunks so that one hard row is not expanded by one task.
    numbered = running_totals(quotas, [], [label, ident], ["quota"]).withColumn(
        "_from", F.col("cum_quota") - F.col("quota")
    )
    cut = numbered.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("quota") - 1) / chunk)))
    ).repartition(ident, "_chunk")
    low = F.col("_from") + F.col("_chunk") * chunk
    high = F.least(F.col("_from") + F.col("quota"), low + chunk) - 1
    wanted = cut.select(ident, label, F.explode(F.sequence(low, high)).alias("j"))
    near = nearest_neighbors(df.filter(asked), ident, features, k, label, within_label=True, **knn)
    drawn = wanted.join(near, ident)
    return _with_originals(df, _interpolate(drawn, features, seed), ident, features, label)


def smote_nc(
    df: DataFrame,
    ident: str,
    features: list[str],
    nominal: list[str],
    label: str,
    k: int = rules.SMOTE_NEIGHBORS,
    seed: int = rules.SEED,
    limit: int = rules.NOMINAL_LIMIT,
    **knn,
) -> DataFrame:
    """SMOTE for numbers and categories.

    A differing category adds the squared median standard deviation (of the smallest
    class) to the squared distance. A synthetic category is the most frequent one
    among the neighbours. Columns with more than ``limit`` values take no part:
    originals keep theirs, synthetic rows get the overall most frequent value.
    """
    df = _complete(df, ident, features, label, tuple(nominal))
    df = df.withColumns({n: F.coalesce(F.col(n).cast("string"), F.lit("nan")) for n in nominal})
    values = df.agg(*[F.count_distinct(n).alias(n) for n in nominal]).first() if nominal else {}
    used = [n for n in nominal if values[n] <= limit]
    wide = [n for n in nominal if values[n] > limit]
    sizes = class_sizes(df, label)
    need = needed_rows(sizes)
    spread = (
        df.filter(F.col(label) == F.lit(_minority(sizes)))
        .agg(*[F.stddev_pop(F.col(f).cast("double")).alias(f) for f in features])
        .first()
    )
    median_std = float(np.median([spread[f] for f in features]))
    small = df.filter(F.col(label).isin(*need)) if need else df.limit(0)
    near = nearest_neighbors(
        small, ident, features, k, label, within_label=True,
        nominal=used, nominal_weight=median_std * median_std, **knn,
    )
    drawn = _drawn_parents(small, ident, label, need, near, seed)

    def usual(i: int) -> Column:
        seen = F.transform("neighbors", lambda n: F.get(n["c"], F.lit(i)))
        tally = F.transform(
            F.array_distinct(seen),
            lambda v: F.struct((-F.size(F.filter(seen, lambda w: w == v))).alias("n"), v.alias("v")),
        )
        best = F.get(F.array_sort(tally), F.lit(0))["v"]
        return F.coalesce(best, F.get("c", F.lit(i)))

    made = drawn.withColumns({n: usual(i) for i, n in enumerate(used)}) if used else drawn
    for n in wide:
        mode = (
            df.groupBy(n)
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.min_by(n, F.struct(-F.col("_n"), F.col(n))).alias("m"))
            .scalar()
        )
        made = made.withColumn(n, mode)
    return _with_originals(df, _interpolate(made, features, seed), ident, features, label, tuple(nominal))


def smote_enn(
    df: DataFrame,
    ident: str,
    features: list[str],
    label: str,
    k: int = rules.SMOTE_NEIGHBORS,
    n_edit: int = rules.ENN_NEIGHBORS,
    seed: int = rules.SEED,
    classes: str = "all",
    **knn,
) -> DataFrame:
    """SMOTE, then drop every row that its nearest rows outvote."""
    grown = stage(smote(df, ident, features, label, k, seed, **knn))
    return edited_neighbors(grown, ident, features, label, n_edit, classes, **knn)


# --- comparison --------------------------------------------------------------------


def compare_techniques(original: DataFrame, results: dict[str, DataFrame], label: str) -> DataFrame:
    """One row per technique: rows, imbalance ratio before and after, gain, verdict."""
    before = class_counts(original, label).agg(
        F.sum("n").alias("rows"), (F.max("n") / F.min("n")).alias("ratio")
    )
    parts = []
    for name, df in results.items():
        parts.append(
            class_counts(df, label)
            .agg(F.sum("n").alias("rows_after"), (F.max("n") / F.min("n")).alias("_after"))
            .select(F.lit(rules.TECHNIQUE_LABELS.get(name, name)).alias("technique"), "rows_after", "_after")
        )
    after = functools.reduce(DataFrame.unionByName, parts)
    joined = after.withColumn("rows_before", before.select("rows").scalar()).withColumn(
        "_before", before.select("ratio").scalar()
    )
    return joined.select(
        "technique",
        "rows_before",
        "rows_after",
        F.round("_before", 2).alias("ratio_before"),
        F.round("_after", 2).alias("ratio_after"),
        F.round((F.col("_before") - F.col("_after")) / F.col("_before") * 100, 1).alias("gain_pct"),
        (F.col("_after") <= rules.BALANCED_RATIO).alias("balanced"),
    )


def class_distribution(original: DataFrame, results: dict[str, DataFrame], label: str) -> DataFrame:
    """Rows per class before, and after every technique; classes a technique lost show 0."""
    tagged = [class_counts(original, label).withColumn("_t", F.lit("before"))]
    tagged += [class_counts(df, label).withColumn("_t", F.lit(name)) for name, df in results.items()]
    names = ["before", *results]
    return (
        functools.reduce(DataFrame.unionByName, tagged).groupBy(label).pivot("_t", names).agg(F.sum("n")).na.fill(0)
    )
