"""Finding and masking terms that give the label away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.association import digamma
from ..functions.scale import running_totals, stage, unpivot


def term_label_counts(df: DataFrame, term: str, label: str) -> DataFrame:
    """``(term, label, n, term_rows)``; a term has at most one row per label."""
    counts = df.groupBy(term, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("term_rows", F.sum("n").over(Window.partitionBy(term)))


def term_entropy(
    df: DataFrame, term: str, label: str, min_rows: int = rules.ENTROPY_MIN_ROWS
) -> DataFrame:
    """Shannon entropy (bits) of the label inside every term with enough rows."""
    p = F.col("n") / F.col("term_rows")
    bits = p * F.log2(p + F.lit(rules.ENTROPY_EPSILON))
    return (
        term_label_counts(df, term, label)
        .filter(F.col("term_rows") >= min_rows)
        .groupBy(term)
        .agg((-F.sum(bits)).alias("entropy"), F.max("term_rows").alias("rows"))
    )


def dominant_label(df: DataFrame, term: str, label: str) -> DataFrame:
    """Most frequent label of a term (smallest on ties) and its share."""
    counts = term_label_counts(df, term, label)
    return counts.groupBy(term).agg(
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("dominant"),
        (F.max("n") / F.max("term_rows")).alias("share"),
        F.max("term_rows").alias("rows"),
    )


def leaking_terms(
    train: DataFrame,
    term: str,
    label: str,
    cutoff: float = rules.ENTROPY_CUTOFF,
    min_rows: int = rules.ENTROPY_MIN_ROWS,
) -> DataFrame:
    """Terms whose label is almost certain, found on training rows only."""
    return term_entropy(train, term, label, min_rows).filter(F.col("entropy") < cutoff).select(term)


def safe_terms(analysed: DataFrame, leaking: DataFrame, term: str) -> DataFrame:
    return analysed.select(term).join(leaking.select(term), term, "left_anti")


def mask_terms(df: DataFrame, leaking: DataFrame, term: str, out: str, sentinel: str = rules.PROXY_TERM):
    """Replace listed terms by the sentinel. The list is broadcast only if it is small."""
    side = leaking.select(F.col(term).alias("_leak"))
    return (
        df.join(side, F.col(term) == F.col("_leak"), "left")
        .withColumn(out, F.when(F.col("_leak").isNotNull(), F.lit(sentinel)).otherwise(F.col(term)))
        .drop("_leak")
    )


def _information(joint: DataFrame, label: str) -> DataFrame:
    """Plug-in mutual information (nats) from ``(column, value, label, n)`` counts."""
    by_value = Window.partitionBy("column", "value")  # at most one row per label
    margins = joint.groupBy("column", label).agg(F.sum("n").alias("_ny"))
    margins = margins.withColumn("_total", F.sum("_ny").over(Window.partitionBy("column")))
    p: Column = F.col("n") / F.col("_total")
    lift = (F.col("n") * F.col("_total")) / (F.col("_nx") * F.col("_ny").cast("double"))
    return (
        joint.withColumn("_nx", F.sum("n").over(by_value).cast("double"))
        .join(margins, ["column", label])
        .groupBy("column")
        .agg(F.sum(p * F.log(lift)).alias("mutual_info"))
    )


def _nearest_on_a_line(cells: DataFrame, label: str, k: int, bucket: int) -> DataFrame:
    """Adds the open interval ``(low, high)`` around each value that ends at its k-th neighbour of the same class.

    ``cells`` has a row per (column, class, value) with ``n`` rows and the class size ``rows``. Where ``n`` alone
    holds the neighbours, ``low = high = value``. Values are ranked over all tasks, and buckets of
    ``bucket`` ranks get the ranks beside them as a halo, so no class is sorted in one task.
    """
    # More than k + 1 copies of a value change no k-th neighbour.
    ranked = running_totals(cells.withColumn("m", F.least("n", F.lit(k + 1))), ["column", label], ["value"], ["m"])
    begin, halo = F.col("cum_m") - F.col("m"), 2 * k + 1
    own = F.floor(begin / bucket)
    inside = begin - own * bucket
    none = F.array().cast("array<bigint>")
    places = F.concat(
        F.array(own),
        F.when(inside >= bucket - halo, F.array(own + 1)).otherwise(none),
        F.when((inside < halo) & (own > 0), F.array(own - 1)).otherwise(none),
    )
    spread = ranked.withColumn("own", own).withColumn("at", F.explode(places))
    beside = Window.partitionBy("column", label, "at").orderBy("value").rowsBetween(-k, k)
    near = spread.withColumn("near", F.collect_list(F.struct("value", "n")).over(beside)).filter("at = own")
    others = F.filter("near", lambda e: e["value"] != F.col("value"))
    gaps = F.flatten(F.transform(others, lambda e: F.array_repeat(F.abs(e["value"] - F.col("value")), F.least(e["n"], F.lit(k)).cast("int"))))
    same = F.array_repeat(F.lit(0.0), F.least(F.col("n") - 1, F.lit(k)).cast("int"))
    reach = near.withColumn("k", F.least(F.lit(k), F.col("rows") - 1).cast("int"))
    reach = reach.withColumn("r", F.element_at(F.array_sort(F.concat(same, gaps)), F.col("k")))
    # The end is the neighbour itself where there is one: adding the distance again could miss it by a rounding.
    left = F.filter("near", lambda e: F.col("value") - e["value"] == F.col("r"))
    right = F.filter("near", lambda e: e["value"] - F.col("value") == F.col("r"))
    low = F.coalesce(F.array_max(F.transform(left, lambda e: e["value"])), F.col("value") - F.col("r"))
    high = F.coalesce(F.array_min(F.transform(right, lambda e: e["value"])), F.col("value") + F.col("r"))
    return reach.withColumn("low", low).withColumn("high", high).select("column", label, "value", "n", "rows", "k", "r", "low", "high")


def neighbor_information(
    df: DataFrame, label: str, features: list[str], k: int = rules.MUTUAL_INFORMATION_NEIGHBORS, bucket: int = 4096
) -> DataFrame:
    """``(column, mutual_info)`` of continuous features by nearest neighbours, in nats, never below 0.

    For each row the distance to its k-th neighbour of the same class is taken on the line of the feature, and the rows of
    all classes that are nearer than that are counted (Ross, "Mutual Information between Discrete and Continuous
    Data Sets", 2014). Classes of one row take no part; smaller classes use all their rows. Nulls and NaN are left out. Rows
    are folded by value, ranks and counts come from range slices, and no class or feature is gathered in a task.
    """
    line = unpivot(df, [label], features, "double").filter(F.col("value").isNotNull() & ~F.isnan("value") & F.col(label).isNotNull())
    counts = line.groupBy("column", label, (F.col("value") + 0.0).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts)
    sizes = counts.groupBy("column", label).agg(F.sum("n").alias("rows")).filter("rows > 1")
    cells = counts.join(sizes, ["column", label])
    bounds = stage(_nearest_on_a_line(cells, label, k, bucket))
    # Counts of what lies below a place: places before (0) and after (2) the values (1) at the same spot.
    first = F.when(F.col("r") > 0, F.struct(F.col("low").alias("pos"), F.lit(2).alias("kind"))).otherwise(F.struct(F.col("value").alias("pos"), F.lit(0).alias("kind")))
    last = F.when(F.col("r") > 0, F.struct(F.col("high").alias("pos"), F.lit(0).alias("kind"))).otherwise(F.struct(F.col("value").alias("pos"), F.lit(2).alias("kind")))
    asked = bounds.withColumn("first", first).withColumn("last", last)
    places = asked.select("column", F.explode(F.array("first", "last")).alias("p")).select("column", "p.pos", "p.kind", F.lit(0).cast("bigint").alias("n"))
    values = bounds.select("column", F.col("value").alias("pos"), F.lit(1).alias("kind"), "n")
    below = stage(running_totals(places.union(values).groupBy("column", "pos", "kind").agg(F.sum("n").alias("n")), ["column"], ["pos", "kind"], ["n"]))
    below = below.filter("kind != 1").select("column", F.struct("pos", "kind").alias("place"), "cum_n")
    counted = asked.join(below.withColumnsRenamed({"place": "first", "cum_n": "before"}), ["column", "first"])
    counted = counted.join(below.withColumnsRenamed({"place": "last", "cum_n": "upto"}), ["column", "last"])
    within = (F.col("upto") - F.col("before")).cast("double")
    part = F.col("n") * (digamma(F.col("k").cast("double")) - digamma(F.col("rows").cast("double")) - digamma(within))
    total = F.sum("n").cast("double")
    return counted.groupBy("column").agg(F.greatest(F.lit(0.0), digamma(total) + F.sum(part) / total).alias("mutual_info"))


def _binned_information(df: DataFrame, label: str, continuous: list[str], bins: int) -> DataFrame:
    """Of continuous features cut into bins of equal frequency; equal values stay together."""
    counts = unpivot(df, [label], continuous, "double").groupBy("column", "value", label).agg(F.count(F.lit(1)).alias("n"))
    per_value = counts.groupBy("column", "value").agg(F.sum("n").alias("m"))
    cum = running_totals(per_value, ["column"], ["value"], ["m"])
    spot = F.floor((F.col("cum_m") - F.col("m")) * bins / F.col("total_m"))
    binned = cum.select("column", "value", spot.alias("bin"))
    joint = (
        counts.join(binned, ["column", "value"])
        .groupBy("column", F.col("bin").alias("value"), label)
        .agg(F.sum("n").alias("n"))
    )
    return _information(joint, label)


def mutual_information(
    df: DataFrame,
    label: str,
    discrete: list[str] | None = None,
    continuous: list[str] | None = None,
    bins: int | None = None,
    limit: float = rules.MUTUAL_INFORMATION_LIMIT,
    neighbors: int = rules.MUTUAL_INFORMATION_NEIGHBORS,
) -> DataFrame:
    """``(feature, mutual_info, leaking)`` against the label, largest first.

    Discrete features use exact joint counts. Continuous ones use the nearest-neighbour
    estimate, or with ``bins`` the counts of so many bins of equal frequency.
    """
    parts = []
    if discrete:
        joint = (
            unpivot(df, [label], discrete, "string")
            .na.fill({"value": ""})
            .groupBy("column", "value", label)
            .agg(F.count(F.lit(1)).alias("n"))
        )
        parts.append(_information(joint, label))
    if continuous:
        parts.append(_binned_information(df, label, continuous, bins) if bins else neighbor_information(df, label, continuous, neighbors))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(
        F.col("column").alias("feature"), "mutual_info", (F.col("mutual_info") > limit).alias("leaking")
    ).orderBy(F.desc("mutual_info"), "feature")


def masking_summary(rows: DataFrame, leaking: DataFrame, term: str) -> DataFrame:
    """How many terms are masked, and how many of the rows they cover."""
    counts = rows.groupBy(term).agg(F.count(F.lit(1)).alias("n"))
    marked = counts.join(leaking.select(F.col(term).alias("_leak")), F.col(term) == F.col("_leak"), "left")
    hit = F.col("_leak").isNotNull()
    return marked.agg(
        F.count(F.when(hit, 1)).alias("terms_masked"),
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("rows_masked"),
        F.sum("n").alias("rows"),
    )


def leakage_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Mutual information before and after masking, with the reduction in percent."""
    b = before.select("feature", F.col("mutual_info").alias("before"))
    a = after.select("feature", F.col("mutual_info").alias("after"))
    drop = (F.col("before") - F.col("after")) / (F.col("before") + F.lit(rules.ENTROPY_EPSILON)) * 100
    return b.join(a, "feature").select(
        "feature",
        "before",
        "after",
        drop.alias("reduction_pct"),
        (F.col("after") > rules.MUTUAL_INFORMATION_LIMIT).alias("leaking"),
    )
