"""The driver's tables in the roles of a case-report extract.

Orders are cases, order lines are the drugs and reactions of a case, the order
priority is its outcome, documents with quality labels are the labelled rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: case, drug (part name), reaction (supplier)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("primaryid"),
        F.upper("p_name").alias("drugname"),
        F.col("l_suppkey").cast("string").alias("pt"),
        F.col("p_brand"),
        F.col("p_type"),
        F.col("l_returnflag"),
    )


def demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw demographic text: key with a decimal tail, mixed sex codes, ages out of range."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("primaryid"),
        F.substring("c_mktsegment", 1, 1).alias("sex"),
        F.floor(F.col("c_acctbal") / 50).cast("bigint").cast("string").alias("age"),
        F.concat(F.lit(" n"), F.col("c_nationkey").cast("string")).alias("reporter_country"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("fda_dt"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("rare_note"),
    )


def drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw drug rows: blank names, role codes outside the set, doses out of range."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").cast("string").alias("primaryid"),
        F.when(F.col("p_size") > 1, F.concat(F.lit(" "), F.col("p_name"))).alias("drugname"),
        F.when(F.col("l_returnflag") == "R", "PS").when(F.col("l_returnflag") == "A", "C").alias("role_cod"),
        F.when(F.col("l_linestatus") == "O", F.lower("p_type")).alias("route"),
        F.concat(F.floor(F.col("l_extendedprice") / 7).cast("bigint").cast("string"), F.lit(" ")).alias("dose_amt"),
        F.when(F.col("l_linenumber") == 1, "Y").when(F.col("l_linenumber") == 2, "X").alias("dechal"),
    )


def reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reaction rows with real terms, short terms and nulls."""
    li = table(spark, sf_dir, "lineitem")
    pick = F.col("l_suppkey") % 6
    term = (
        F.when(pick == 0, " skin rash")
        .when(pick == 1, "Pyrexia ")
        .when(pick == 2, "DIZZY")
        .when(pick == 3, "ab")
        .when(pick == 4, F.concat(F.lit("event "), (F.col("l_partkey") % 9).cast("string")))
    )
    return li.select(
        F.col("l_orderkey").cast("string").alias("primaryid"),
        term.alias("pt"),
        F.when(F.col("l_returnflag") == "N", "W").alias("drug_rec_act"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: three whole-number features, two categories, a skewed class."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    size = F.length("text")
    return d.join(lab, "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (size - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double").alias("n_spaces"),
        (size - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("double").alias("n_lines"),
        "lang",
        "source",
        "quality",
        "toxic",
    )


FEATURES = ["n_chars", "n_spaces", "n_lines"]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a severity, a prediction and a score per class (with ties)."""
    from ..functions.random import seeded_uniform

    o = table(spark, sf_dir, "orders")
    y = (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("severity")
    u = [seeded_uniform(7, F.col("o_orderkey"), F.lit(c)) for c in range(1, 6)]
    row = o.select("o_orderkey", y, *[x.alias(f"u{c}") for c, x in enumerate(u, 1)])
    score = F.array(
        *[
            F.floor((F.col(f"u{c}") + F.when(F.col("severity") == c, 0.3).otherwise(0.0)) * 100) / 100
            for c in range(1, 6)
        ]
    )
    return row.select(
        "o_orderkey",
        "severity",
        F.when(F.col("u1") < 0.6, F.col("severity")).otherwise((F.floor(F.col("u2") * 5) + 1).cast("int")).alias("predicted"),
        score.alias("scores"),
    )


def event_cases(events: DataFrame) -> DataFrame:
    """The event stream as cases: user, event type as drug, property as reaction."""
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_id").alias("primaryid"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        F.array(F.upper("event_type")).alias("drugs"),
        F.array(F.concat(F.lit("K"), (k.cast("int") % 20).cast("string"))).alias("reactions"),
        "value",
    )
