"""Pair counts and disproportionality signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import association as assoc
from ..functions.scale import stage


def known_pairs(df: DataFrame, drug: str, term: str) -> DataFrame:
    """Rows where both sides of the pair are present."""
    d, t = F.col(drug), F.col(term)
    return df.filter(d.isNotNull() & (d.cast("string") != "") & t.isNotNull() & (t.cast("string") != ""))


def pair_counts(
    df: DataFrame, drug: str, term: str, case: str | None = None, weight: str | None = None
) -> DataFrame:
    """``(drug, term, count_a)``: joined rows, or distinct cases when ``case`` is named.

    ``weight`` names a column of multiplicities for input that is already counted.
    """
    if case is not None:
        df = df.select(drug, term, case).distinct()
    count = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(drug, term).agg(count.alias("count_a"))


def grouping_set_counts(df: DataFrame, drug: str, term: str) -> DataFrame:
    """Grand total, both margins and every pair: ``(kind, drug, term, n)``.

    Pairs are counted first, so the grouping-sets expansion multiplies the pair
    table and not the raw rows. A missing drug or term still counts on the other
    side and in the total.
    """
    pairs = df.groupBy(
        F.nullif(F.col(drug).cast("string"), F.lit("")).alias(drug),
        F.nullif(F.col(term).cast("string"), F.lit("")).alias(term),
    ).agg(F.count(F.lit(1)).alias("n"))
    sets = pairs.groupingSets(
        [[], [drug], [term], [drug, term]], drug, term
    ).agg(F.sum("n").alias("n"), F.grouping_id().alias("gid"))
    kind = (
        F.when(F.col("gid") == 3, "TOTAL")
        .when(F.col("gid") == 1, "DRUG")
        .when(F.col("gid") == 2, "REAC")
        .otherwise("PAIR")
    )
    named = (
        F.col("gid").isin(3)
        | ((F.col("gid") == 1) & F.col(drug).isNotNull())
        | ((F.col("gid") == 2) & F.col(term).isNotNull())
        | ((F.col("gid") == 0) & F.col(drug).isNotNull() & F.col(term).isNotNull())
    )
    return sets.filter(named).select(kind.alias("kind"), drug, term, "n")


def contingency(
    df: DataFrame, drug: str, term: str, case: str | None = None, weight: str | None = None
) -> DataFrame:
    """The 2x2 table of every pair: ``count_a, count_b, count_c, count_d`` as doubles.

    By rows, both margins and the total are sums over the pair table, so the raw
    rows are shuffled once (the exchange is reused). By cases, each margin counts
    its own distinct cases, because one case may hold several pairs.
    """
    if case is None:
        pairs = pair_counts(df, drug, term, None, weight)
        by_drug = pairs.groupBy(drug).agg(F.sum("count_a").alias("_drug"))
        by_term = pairs.groupBy(term).agg(F.sum("count_a").alias("_term"))
        total = pairs.agg(F.sum("count_a").alias("_n")).scalar()
    else:
        # Everything starts from the same distinct triples, so their exchange is reused.
        triples = df.select(drug, term, case).distinct()
        rows = F.count(F.lit(1))
        pairs = triples.groupBy(drug, term).agg(rows.alias("count_a"))
        by_drug = triples.select(drug, case).distinct().groupBy(drug).agg(rows.alias("_drug"))
        by_term = triples.select(term, case).distinct().groupBy(term).agg(rows.alias("_term"))
        total = triples.select(case).distinct().agg(rows.alias("_n")).scalar()
    return _with_margins(pairs, by_drug, by_term, total, drug, term)


def _with_margins(pairs: DataFrame, by_drug: DataFrame, by_term: DataFrame, total, drug: str, term: str) -> DataFrame:
    a = F.col("count_a").cast("double")
    d = F.col("_drug").cast("double")
    t = F.col("_term").cast("double")
    n = F.col("_n").cast("double")
    # The total rides on the small margin table, below the join, so that the scalar
    # subquery appears once in the plan.
    return (
        pairs.join(by_drug, drug)
        .join(by_term.withColumn("_n", total), term)
        .select(
            drug,
            term,
            "count_a",
            (d - a).alias("count_b"),
            (t - a).alias("count_c"),
            (n - d - t + a).alias("count_d"),
        )
    )


def case_contingency(drugs: DataFrame, terms: DataFrame, drug: str, term: str, case: str) -> DataFrame:
    """``contingency`` by cases from two child tables: the same figures, with the product counted only once.

    Both sides are distinct before they meet, so their product is too, and the margins are counts over the
    children's cases that have both a drug and a term.
    """
    d = stage(drugs.select(case, drug).dropna().distinct())
    t = stage(terms.select(case, term).dropna().distinct())
    both = stage(d.select(case).distinct().join(t.select(case).distinct(), case))
    rows = F.count(F.lit(1))
    pairs = d.join(t, case).groupBy(drug, term).agg(rows.alias("count_a"))
    by_drug = d.join(both, case, "left_semi").groupBy(drug).agg(rows.alias("_drug"))
    by_term = t.join(both, case, "left_semi").groupBy(term).agg(rows.alias("_term"))
    return _with_margins(pairs, by_drug, by_term, both.agg(rows.alias("_n")).scalar(), drug, term)


def score_pairs(table: DataFrame, drug: str, term: str, clamp: bool = False) -> DataFrame:
    """All measures of a contingency table: counts, support, PRR, chi-square, ROR, p."""
    a, b, c, d = (F.col(f"count_{k}").cast("double") for k in "abcd")
    expected = F.try_divide((a + b) * (a + c), a + b + c + d)
    chi2 = assoc.chi2_yates(a, b, c, d, clamp)
    return table.select(
        drug,
        term,
        F.col("count_a").cast("bigint").alias("count_a"),
        b.alias("count_b"),
        c.alias("count_c"),
        d.alias("count_d"),
        (a / (a + b + c + d)).alias("support"),
        F.try_divide(a, expected).alias("excess_ratio"),
        assoc.prr(a, b, c, d).alias("prr"),
        chi2.alias("chi2"),
        assoc.ror(a, b, c, d).alias("ror"),
        assoc.chi2_p_value(chi2).alias("p_value"),
    )


def keep_signals(
    scored: DataFrame,
    min_count: int = rules.SIGNAL_MIN_COUNT,
    min_prr: float = rules.SIGNAL_MIN_PRR,
    min_chi2: float = rules.SIGNAL_MIN_CHI2,
) -> DataFrame:
    return scored.filter(
        (F.col("count_a") >= min_count) & (F.col("prr") >= min_prr) & (F.col("chi2") >= min_chi2)
    )


def safety_signals(
    df: DataFrame,
    drug: str = "drugname",
    term: str = "pt",
    case: str | None = None,
    min_count: int = rules.SIGNAL_MIN_COUNT,
    min_prr: float = rules.SIGNAL_MIN_PRR,
    min_chi2: float = rules.SIGNAL_MIN_CHI2,
    clamp: bool = False,
) -> DataFrame:
    """Pairs reported more often than expected, strongest first.

    Missing names count as ``UNKNOWN``. ``case`` switches from joined rows to
    distinct cases as the unit of counting.
    """
    filled = df.select(
        *([case] if case else []),
        F.coalesce(F.col(drug).cast("string"), F.lit(rules.TERM_DEFAULT)).alias(drug),
        F.coalesce(F.col(term).cast("string"), F.lit(rules.TERM_DEFAULT)).alias(term),
    )
    scored = score_pairs(contingency(filled, drug, term, case), drug, term, clamp)
    return keep_signals(scored, min_count, min_prr, min_chi2).orderBy(F.desc("chi2"), drug, term)


def top_pairs(counts: DataFrame, drug: str, term: str, n: int = 20) -> DataFrame:
    """The n most frequent pairs of a table of pair counts, ties by name."""
    known = known_pairs(counts, drug, term).select(drug, term, F.col("count_a").alias("n"))
    return known.orderBy(F.desc("n"), drug, term).limit(n)


def attach_signals(cases: DataFrame, signals: DataFrame, drug: str, term: str) -> DataFrame:
    """Left lookup of the historical measures of a pair, with ``known_signal``.

    No broadcast hint: Spark broadcasts the signal table only when it is small.
    """
    keep = [c for c in ("count_a", "prr", "chi2", "ror", "p_value") if c in signals.columns]
    side = signals.select(drug, term, *keep, F.lit(True).alias("known_signal"))
    return cases.join(side, [drug, term], "left").withColumn(
        "known_signal", F.coalesce("known_signal", F.lit(False))
    )
