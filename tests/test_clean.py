import pytest
from pyspark.sql import functions as F

from caselume.operators import clean, profile, quality


def column(df, name):
    return [r[name] for r in df.collect()]


def test_median_fills_nulls_exactly(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    assert sorted(column(clean.impute_median(df, ["v"]), "v")) == [1.0, 2.0, 2.5, 3.0, 10.0]


def test_median_of_nothing_is_the_fallback(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert column(clean.impute_median(df, ["v"], 45.0), "v") == [45.0]


def test_severity_codes(spark):
    codes = ["de", " LT", "HO", "CA", "DS", "RI", "OT", "XX", None]
    df = spark.createDataFrame([(c,) for c in codes], "outc_cod string")
    assert column(clean.with_severity(df), "severity_level") == [5, 4, 3, 3, 2, 2, 1, 1, 1]
    assert column(clean.with_severity(df.withColumnRenamed("outc_cod", "x")), "severity_level") == [1] * 9


def test_short_terms(spark):
    df = spark.createDataFrame([("1", "AB"), ("2", "ABC"), ("3", None)], "primaryid string, pt string")
    assert sorted(column(clean.clean_reac(df).clean, "pt"), key=str) == ["ABC", None]
    indi = clean.clean_indi(df.withColumnRenamed("pt", "indi_pt")).clean
    assert sorted(column(indi, "indi_pt")) == ["ABC", "NO INFORMADA"]


def test_synonyms_and_duplicates(spark):
    df = spark.createDataFrame(
        [("1", "Hypoacusis "), ("1", "deafness"), ("2", "GOUT"), (" ", "GOUT")], "primaryid string, pt string"
    )
    assert sorted((r["primaryid"], r["pt"]) for r in clean.clean_reac(df).clean.collect()) == [("1", "HIPOACUSIA"), ("2", "GOUT")]


def test_demo_recipe_and_audit(spark):
    df = spark.createDataFrame(
        [("1", "F", "30", " us"), ("2", "f", "200", "usa"), ("3", " M ", "x", None), ("", "M", "1", "ES")],
        "primaryid string, sex string, age string, reporter_country string",
    )
    done = clean.clean_demo(df)
    rows = {r["primaryid"]: r for r in done.clean.collect()}
    assert [rows[k]["sex"] for k in "123"] == ["F", "U", "M"]
    assert [rows[k]["age"] for k in "123"] == [30.0, 30.0, 30.0]
    audit = {r["measure"]: r["value"] for r in done.audit().collect()}
    assert audit == {"rows_in": 4, "blank_key": 1, "sex_defaulted": 1, "age_imputed": 2, "country_not_two_letters": 1, "rows_out": 3}


def test_sparse_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", None), (3, "x", None)], "k int, a string, b string")
    assert clean.drop_sparse_columns(df, 0.6).columns == ["k", "a"]
    assert clean.drop_sparse_columns(df, 0.6, blank_is_null=True).columns == ["k"]
    assert clean.drop_empty_columns(df).columns == ["k", "a"]


def test_therapy_keeps_positive_sequences(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "0"), ("1", "x"), ("1", None)], "primaryid string, drug_seq string")
    assert column(clean.clean_ther(df).clean, "drug_seq") == [2.0]


def test_report_and_outcome_recipes(spark):
    r = spark.createDataFrame([("1", None), ("2", " hp ")], "primaryid string, rpsr_cod string")
    assert sorted(column(clean.clean_rpsr(r).clean, "rpsr_cod")) == ["HP", "UNK"]
    o = spark.createDataFrame([("1", " de"), ("2", "zz"), ("3", None)], "primaryid string, outc_cod string")
    assert sorted(column(clean.clean_outc(o).clean, "outc_cod")) == ["DE", "OT", "OT"]


def test_key_name_and_suffixes(spark):
    df = spark.createDataFrame([(1, 2)], "PRIMARYID int, v int")
    named = clean.key_named(df)
    assert named.columns == ["primaryid", "v"]
    assert clean.suffix_columns(named, "primaryid", "drug").columns == ["primaryid", "v_drug"]
    assert clean.suffix_collisions(["v"], named, "primaryid", "reac").columns == ["primaryid", "v_reac"]


def test_label_shift_is_undone(spark):
    df = spark.createDataFrame([(3,), (5,)], "y int")
    back = clean.unshift_labels(clean.shift_labels(df, "y"), "label", "again")
    assert [(r["label"], r["again"]) for r in back.orderBy("y").collect()] == [(0.0, 3), (2.0, 5)]


def test_column_plan(spark):
    rows = [(i, "x", None if i < 1 else 1.0, None if i < 5 else "y", None if i < 80 else "z") for i in range(100)]
    df = spark.createDataFrame(rows, "primaryid int, a string, b double, c string, d string")
    plan = quality.column_actions(profile.column_profile(df, "primaryid", "T"))
    assert {r["column"]: r["action"] for r in plan.collect()} == {
        "primaryid": "ninguna", "a": "normalizar", "b": "imputar_mediana",
        "c": "imputar_mediana_o_knn", "d": "eliminar_columna",
    }


def test_approximate_column_profile_has_the_same_columns(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "primaryid int, a string")
    exact = profile.column_profile(df, "primaryid", "T")
    quick = profile.column_profile(df, "primaryid", "T", approximate=True)
    assert sorted(exact.collect()) == sorted(quick.collect())


@pytest.mark.parametrize(
    "ratio,rows,text,minority,card,expected",
    [
        (1.5, 1000, 0.5, 0.2, 0, []),
        (9.0, 1000, 0.5, 0.2, 0, ["smote", "smote_nc", "smoteenn"]),
        (3.0, 1000, 0.0, 0.005, 0, ["adasyn"]),
        (6.0, 50_000, 0.0, 0.2, 60, ["random_undersampling", "smote", "smote_nc", "borderline_smote"]),
        (9.0, 400_000, 0.4, 0.001, 0, ["random_undersampling", "smote", "smoteenn", "adasyn", "smote_nc"]),
    ],
)
def test_recommendation(spark, ratio, rows, text, minority, card, expected):
    rec = quality.recommended_techniques(*[F.lit(v) for v in (ratio, rows, text, minority, card)])
    out = spark.range(1).select(rec.alias("r"), quality.winning_technique(rec).alias("w")).first()
    assert out["r"] == expected
    priority = ["smoteenn", "smote_nc", "adasyn", "borderline_smote", "smote", "random_undersampling"]
    assert out["w"] == next((t for t in priority if t in expected), None)
