"""Joins that turn the relational tables into cases and consolidated rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.random import seeded_uniform
from ..functions.scale import running_totals, stage
from .clean import suffix_collisions, suffix_columns


def _tagged_keys(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """All keys of all tables with a one-column tag: the input of one shared shuffle."""
    parts = [t.select(F.col(key), F.lit(i).alias("_tag"), F.lit(1 << i).cast("bigint").alias("_bit")) for i, t in enumerate(tables.values())]
    return functools.reduce(DataFrame.unionByName, parts).filter(F.col(key).isNotNull())


def common_keys(
    tables: dict[str, DataFrame], key: str = rules.KEY, core: tuple[str, ...] = rules.CORE_TABLES
) -> DataFrame:
    """Keys present in every table; if there is none, keys present in the core tables.

    One shuffle of (key, bit) with a map-side bit_or, whatever the number of tables.
    """
    names = list(tables)
    masks = (
        _tagged_keys(tables, key)
        .groupBy(key)
        .agg(F.bit_or(F.col("_bit")).alias("_mask"))
    )
    full = (1 << len(names)) - 1
    relaxed = sum(1 << names.index(t) for t in core if t in names)
    if not relaxed:
        return masks.filter(F.col("_mask") == full).select(key)
    complete = masks.agg(
        F.coalesce(F.max(F.when(F.col("_mask") == full, 1)), F.lit(0)).alias("any")
    ).scalar()
    wanted = F.when(complete == 1, F.lit(full)).otherwise(F.lit(relaxed))
    return (
        masks.withColumn("_wanted", wanted)
        .filter(F.col("_mask").bitwiseAND(F.col("_wanted")) == F.col("_wanted"))
        .select(key)
    )


def sample_keys(keys: DataFrame, n: int, key: str = rules.KEY, seed: int = rules.SEED) -> DataFrame:
    """n keys in seeded random order, the same ones on every run."""
    return (
        keys.withColumn("_u", seeded_uniform(seed, key)).orderBy("_u", key).limit(n).select(key)
    )


def restrict(df: DataFrame, keys: DataFrame, key: str = rules.KEY) -> DataFrame:
    """Rows whose key is in the set."""
    return df.join(keys.select(key), key, "left_semi")


def coherent_sample(
    tables: dict[str, DataFrame], n: int, required: tuple[str, ...], key: str = rules.KEY, seed: int = rules.SEED
) -> dict[str, DataFrame]:
    """n keys that all required tables share, and every table cut down to them."""
    shared = common_keys({t: tables[t] for t in required}, key, core=())
    keys = sample_keys(shared, n, key, seed)
    return {name: restrict(t, keys, key) for name, t in tables.items()}


def explosion_size(tables: dict[str, DataFrame], key: str = rules.KEY) -> DataFrame:
    """Rows the multiway join would give, and its largest single key, before joining."""
    names = list(tables)
    counts = (
        _tagged_keys(tables, key)
        .groupBy(key)
        .agg(*[F.sum(F.when(F.col("_tag") == i, 1).otherwise(0)).alias(f"_n{i}") for i in range(len(names))])
    )
    product: Column = functools.reduce(
        lambda a, b: a * b, [F.col(f"_n{i}").cast("double") for i in range(len(names))]
    )
    return counts.agg(
        F.coalesce(F.sum(product), F.lit(0.0)).alias("joined_rows"),
        F.coalesce(F.max(product), F.lit(0.0)).alias("largest_key_rows"),
        F.coalesce(F.sum(F.when(product > 0, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("joined_keys"),
    )


def join_product(
    tables: dict[str, DataFrame], key: str = rules.KEY, always_suffix: bool = False, heavy_rows: int = 100_000, salts: int = 64
) -> DataFrame:
    """Every combination of the rows of a key over all tables; the key must be in all.

    A key whose product has more than ``heavy_rows`` rows is split: the rows of its largest table
    are dealt to ``salts`` parts, and the other tables' rows of that key are repeated for each
    part, so the product of one key is formed in many tasks. All other keys are joined
    as they are. Columns that collide get the table name.
    """
    named: dict[str, DataFrame] = {}
    taken: list[str] = []
    for i, (name, table) in enumerate(tables.items()):
        if always_suffix:
            table = suffix_columns(table, key, name)
        elif i:
            table = suffix_collisions(taken, table, key, name)
        named[name] = table
        taken += [c for c in table.columns if c not in taken]
    sizes = None
    for i, table in enumerate(named.values()):
        own = table.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias(f"_n{i}"))
        sizes = own if sizes is None else sizes.join(own, key)
    counts = [F.col(f"_n{i}") for i in range(len(named))]
    product = counts[0]
    for c in counts[1:]:
        product = product * c
    largest = F.array_position(F.array(*counts), F.array_max(F.array(*counts))).cast("int") - 1
    heavy = stage(sizes.filter(product > heavy_rows).select(key, largest.alias("_wide")))

    plain = split = None
    for i, table in enumerate(named.values()):
        light = table.join(heavy.select(key), key, "left_anti")
        plain = light if plain is None else plain.join(light, key)
        drawn = F.array(F.pmod(F.xxhash64(*table.columns), F.lit(salts)).cast("int"))
        parts = F.when(F.col("_wide") == i, drawn).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))
        dealt = table.join(heavy, key).withColumn("_salt", F.explode(parts)).drop("_wide")
        split = dealt if split is None else split.join(dealt, [key, "_salt"])
    return plain.unionByName(split.drop("_salt"))


def joined_pair_counts(
    drugs: DataFrame,
    terms: DataFrame,
    others: list[DataFrame],
    drug: str,
    term: str,
    key: str = rules.KEY,
) -> DataFrame:
    """Pair counts of the multiway join without building it.

    A joined row is one choice per table, so a pair occurs
    (rows with the drug) x (rows with the term) x (rows in each other table) times
    in a case. Each table is reduced to counts before the join, and the other tables' counts
    go into one weight of the drug side before drugs meet reactions.
    """
    d = drugs.groupBy(key, drug).agg(F.count(F.lit(1)).alias("_d"))
    for o in others:
        d = d.join(o.groupBy(key).agg(F.count(F.lit(1)).alias("_w")), key).withColumn("_d", F.col("_d") * F.col("_w")).drop("_w")
    t = terms.groupBy(key, term).agg(F.count(F.lit(1)).alias("_t"))
    return d.join(t, key).groupBy(drug, term).agg(F.sum(F.col("_d") * F.col("_t")).alias("count_a"))


def limited_join_count(left: DataFrame, right: DataFrame, key: str = rules.KEY, n: int = 100) -> DataFrame:
    """Joined rows of the first n left rows in key order: a quick consistency check."""
    first = left.orderBy(key).limit(n).select(key)
    return first.join(right.select(key), key).agg(F.count(F.lit(1)).alias("joined_rows"))


def suspect_pair_counts(
    drugs: DataFrame, terms: DataFrame, drug: str, term: str, role: str = "role_cod", wanted: str = "PS", key: str = rules.KEY
) -> DataFrame:
    """How often suspect drugs meet reactions of the same case.

    The role filter and the counting per case both run before the join, so a case
    with very many rows joins its distinct drugs with its distinct reactions only.
    """
    return joined_pair_counts(drugs.filter(F.col(role) == wanted), terms, [], drug, term, key)


def ordered_lists(df: DataFrame, key: str, order: str, item: str, name: str) -> DataFrame:
    """``(key, <name>)``: one row per key with its items in order, duplicates kept.

    An array holds a whole case, so it must fit in a row. Counting pairs and anything else that
    grows with a case works on the child tables instead (``case_items``, ``suspect_pair_counts``).
    """
    packed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_o"), F.col(item).alias("_i"))))
    return df.groupBy(key).agg(F.transform(packed, lambda s: s["_i"]).alias(name))


def case_items(df: DataFrame, key: str, order: str, item: str) -> DataFrame:
    """The items of all cases as a child table: ``(key, position, item)``, positions from 1.

    A case of any size is spread over range slices, so no task holds a whole one.
    """
    counted = df.select(key, F.col(order).alias("_o"), F.col(item).alias("item")).groupBy(key, "_o", "item").agg(
        F.count(F.lit(1)).alias("n")
    )
    spots = running_totals(counted, [key], ["_o", "item"], ["n"])
    return spots.select(key, F.explode(F.sequence(F.col("cum_n") - F.col("n") + 1, F.col("cum_n"))).alias("position"), "item")


def assemble_cases(
    demo: DataFrame,
    drugs: DataFrame,
    reactions: DataFrame,
    outcomes: DataFrame,
    key: str = rules.KEY,
    demo_cols: tuple[str, ...] = ("sex", "age", "reporter_country"),
    drug: tuple[str, str] = ("drug_seq", "drugname"),
    reaction: tuple[str, str] = ("pt", "pt"),
    outcome: tuple[str, str] = ("outc_cod", "outc_cod"),
) -> DataFrame:
    """One row per case with arrays of drugs, reactions and outcomes.

    Cases without a drug or without a reaction are left out; outcomes may be empty.
    """
    none = F.array().cast("array<string>")
    return (
        demo.select(key, *demo_cols)
        .join(ordered_lists(drugs, key, *drug, "drugs"), key)
        .join(ordered_lists(reactions, key, *reaction, "reactions"), key)
        .join(ordered_lists(outcomes, key, *outcome, "outcomes"), key, "left")
        .withColumn("outcomes", F.coalesce("outcomes", none))
    )


def case_pairs(cases: DataFrame, drugs: str = "drugs", reactions: str = "reactions", keep: tuple = ()) -> DataFrame:
    """Distinct (drug, reaction) pairs of every case row."""
    return cases.select(*keep, F.explode(F.array_distinct(drugs)).alias("drugname"), reactions).select(
        *keep, "drugname", F.explode(F.array_distinct(reactions)).alias("pt")
    )


def consolidate(tables: dict[str, DataFrame], key: str = rules.KEY) -> DataFrame:
    """The multiway join with severity and the fixed sex value attached."""
    from .clean import sex_value, with_severity

    out = with_severity(join_product(tables, key))
    return out.withColumn("sex_encoded", sex_value("sex")) if "sex" in out.columns else out
