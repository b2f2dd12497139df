import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselume.functions import association, random, scale, text


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw,key",
    [("12345.0", 12345), (" 12345 ", 12345), ("US-12345", 12345), ("", None), (None, None), ("abc", None)],
)
def test_clean_key(spark, raw, key):
    assert one(spark, text.clean_key(F.lit(raw).cast("string"))) == key


def test_strip_drops_every_kind_of_white_space(spark):
    assert one(spark, text.strip(F.lit("\t  a b \n"))) == "a b"


@pytest.mark.parametrize("raw", ["crohn's DISEASE", "type-2 diabetes", " x1y "])
def test_title_case_matches_python(spark, raw):
    assert one(spark, text.title_case(F.lit(raw))) == raw.strip().title()


def test_numbers_that_do_not_parse_are_null(spark):
    assert one(spark, text.to_number(F.lit(" 1e2 "))) == 100.0
    assert one(spark, text.to_number(F.lit("12a"))) is None


def test_ranges_closed_and_open(spark):
    assert one(spark, text.within(F.lit(120.0), 0, 120)) == 120.0
    assert one(spark, text.within(F.lit(0.0), 0, 10000, closed=False)) is None


def test_month_key(spark):
    assert one(spark, text.month_key(F.lit("20251231"))) == "2025-12"
    assert one(spark, text.month_key(F.lit("2025"))) is None


def test_association_worked_example(spark):
    a, b, c, d = (F.lit(float(v)) for v in (20, 5, 10, 165))
    assert one(spark, association.prr(a, b, c, d)) == pytest.approx(14.0, abs=1e-6)
    assert one(spark, association.chi2_yates(a, b, c, d)) == pytest.approx(88.941176, abs=1e-6)
    assert one(spark, association.ror(a, b, c, d)) == pytest.approx(66.0)


def test_yates_clamp(spark):
    a, b, c, d = (F.lit(float(v)) for v in (1, 9, 10, 80))
    assert one(spark, association.chi2_yates(a, b, c, d)) == pytest.approx(0.181591, abs=1e-6)
    assert one(spark, association.chi2_yates(a, b, c, d, clamp=True)) == pytest.approx(0.0)


def test_erfc_against_the_standard_library(spark):
    rows = spark.range(2000).select((F.col("id") / 100.0).alias("x"))
    for r in rows.select("x", association.erfc(F.col("x")).alias("v")).collect():
        assert r["v"] == pytest.approx(math.erfc(r["x"]), rel=1e-12)


@pytest.mark.parametrize("chi2,p", [(22.0, 2.727e-06), (16.8, 4.153e-05), (0.9, 0.3428), (2.4, 0.1213)])
def test_p_values(spark, chi2, p):
    assert one(spark, association.chi2_p_value(F.lit(chi2))) == pytest.approx(p, rel=2e-3)


def test_seeded_uniform_is_fixed(spark):
    assert one(spark, random.seeded_uniform(42, F.lit(7))) == 0.4643532645622859


def test_running_totals_over_slices(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"), F.lit(2).alias("v"))
    for order, flip in (("o", False), (F.desc("o"), True)):
        rows = scale.running_totals(df, ["g"], [order], ["v"]).collect()
        for g in range(3):
            mine = sorted((r for r in rows if r["g"] == g), key=lambda r: r["o"], reverse=flip)
            assert [r["cum_v"] for r in mine] == [2 * (i + 1) for i in range(len(mine))]
            assert {r["total_v"] for r in mine} == {2 * len(mine)}


def test_running_totals_without_group_and_with_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, o int").withColumn("one", F.lit(1))
    assert sorted(r["cum_one"] for r in scale.running_totals(df, [], ["g", "o"], ["one"]).collect()) == [1, 2, 3]
    by = scale.running_totals(df, ["g"], ["o"], ["one"]).collect()
    assert sorted(r["cum_one"] for r in by if r["g"] is None) == [1, 2]


def test_seeded_rank_is_a_permutation_and_keep_prunes(spark):
    df = spark.range(2000).select("id", (F.col("id") % 2).alias("g"))
    full = scale.seeded_rank(df, ["g"], "id", 5).collect()
    for g in (0, 1):
        assert sorted(r["rank"] for r in full if r["g"] == g) == list(range(1, 1001))
    few = {(r["id"], r["rank"]) for r in scale.seeded_rank(df, ["g"], "id", 5, keep=10).collect()}
    assert few == {(r["id"], r["rank"]) for r in full if r["rank"] <= 10}
    other = scale.seeded_rank(df, ["g"], "id", 5, buckets=7).collect()
    assert {(r["id"], r["rank"]) for r in other} == {(r["id"], r["rank"]) for r in full}


def test_exact_quantiles_match_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    data = [("a", float(v)) for v in rng.normal(size=301)] + [("a", 0.5)] * 200 + [("b", 1.0), ("b", None), ("b", 10.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in scale.exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    for g in ("a", "b"):
        vals = [v for k, v in data if k == g and v is not None]
        assert got[g] == pytest.approx(np.quantile(vals, probs).tolist())


def test_staging_folder_is_the_one_the_session_names(spark):
    folder = scale.staging_dir(spark)
    assert folder == scale.staging_dir(spark)
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert folder == (named or spark.sparkContext.getCheckpointDir())
    assert sorted(r["id"] for r in scale.stage(spark.range(3)).collect()) == [0, 1, 2]


def test_scratch_folders_are_dropped_and_the_result_stays(spark):
    import os

    from caselume.functions.scale import scratch, stage

    def folder(df):
        return os.path.dirname(df.inputFiles()[0]).removeprefix("file:").replace("//", "/")

    with scratch(spark) as outer:
        with scratch(spark) as last:
            first = stage(spark.range(5))
            second = stage(first.filter("id > 1"))
            gone = [folder(first), folder(second)]
            kept = last(second.selectExpr("id * 2 as x"))
        assert not any(map(os.path.exists, gone)) and os.path.exists(folder(kept))
        mine = folder(kept)
        assert sorted(r.x for r in kept.collect()) == [4, 6, 8]
        result = outer(kept.agg({"x": "sum"}).toDF("s"))
    assert not os.path.exists(mine) and result.first()["s"] == 18
    with pytest.raises(ZeroDivisionError), scratch(spark):
        lost = folder(stage(spark.range(3)))
        1 / 0
    assert not os.path.exists(lost)
