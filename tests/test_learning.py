import math
import threading

import pytest
from pyspark.sql import functions as F

from caselume.operators import encode, leakage, metrics, split
from caselume.plans import training


def test_entropy_and_masking(spark):
    rows = [("lo", 1)] * 9 + [("lo", 2)] + [("hi", 1)] * 8 + [("hi", 2)] * 2 + [("few", 1)] * 2
    df = spark.createDataFrame(rows, "pt string, y int")
    h = {r["pt"]: r["entropy"] for r in leakage.term_entropy(df, "pt", "y").collect()}
    assert h["lo"] == pytest.approx(0.468996, abs=1e-5) and h["hi"] == pytest.approx(0.721928, abs=1e-5)
    assert "few" not in h
    leaking = leakage.leaking_terms(df, "pt", "y")
    assert [r["pt"] for r in leaking.collect()] == ["lo"]
    masked = leakage.mask_terms(df, leaking, "pt", "m")
    assert {r["pt"]: r["m"] for r in masked.collect()} == {"lo": "OUTCOME_PROXY", "hi": "hi", "few": "few"}
    safe = leakage.safe_terms(leakage.term_entropy(df, "pt", "y"), leaking, "pt")
    assert [r["pt"] for r in safe.collect()] == ["hi"]


def test_dominant_label_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "pt string, y int")
    assert {r["pt"]: r["dominant"] for r in leakage.dominant_label(df, "pt", "y").collect()} == {"a": 1, "b": 3}


def test_mutual_information(spark):
    rows = [("a", 0)] * 4 + [("a", 1)] + [("b", 0)] + [("b", 1)] * 4
    df = spark.createDataFrame(rows, "f string, y int").withColumn("v", F.when(F.col("f") == "a", 1.0).otherwise(2.0))
    got = {r["feature"]: r["mutual_info"] for r in leakage.mutual_information(df, "y", ["f"], ["v"], bins=2).collect()}
    assert got["f"] == pytest.approx(0.192745, abs=1e-6) and got["v"] == pytest.approx(0.192745, abs=1e-6)


def test_split_is_disjoint_complete_and_stratified(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 20, 1).otherwise(0).alias("y"))
    rows = split.stratified_holdout(df, "y", "id").collect()
    assert len(rows) == 100 and sum(r["is_test"] and r["y"] == 1 for r in rows) == 4
    assert sum(r["is_test"] for r in rows) == 20
    folds = split.stratified_folds(df, "y", "id").groupBy("fold", "y").count().collect()
    assert {r["count"] for r in folds if r["y"] == 1} == {4} and {r["count"] for r in folds if r["y"] == 0} == {16}


def test_ordinal_codes_and_unknowns(spark):
    book = encode.fit_ordinal(spark.createDataFrame([("b",), ("a",), ("C",), ("a",), (None,)], "v string"), "v")
    assert {r["value"]: r["code"] for r in book.collect()} == {"C": 0.0, "a": 1.0, "b": 2.0}
    got = encode.encode(spark.createDataFrame([("a",), ("zz",), (None,)], "v string"), book, "v", "code").collect()
    assert sorted(r["code"] for r in got) == [-1.0, -1.0, 1.0]


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2)], "y int, p int")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df, "y", "p", [1, 2, 3]).collect()}
    assert len(cells) == 9 and cells[(3, 2)] == 1 and cells[(2, 3)] == 0
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "p", [1, 2, 3]).collect()}
    assert rep["1"]["f1"] == pytest.approx(2 / 3) and rep["2"]["precision"] == pytest.approx(1 / 3)
    assert rep["3"]["f1"] == 0.0 and rep["accuracy"]["f1"] == 0.5
    assert rep["macro"]["f1"] == pytest.approx((2 / 3 + 0.5) / 3)


def test_auc_and_curve(spark):
    rows = [("c", s, p) for s, p in ((0.9, True), (0.8, True), (0.7, False), (0.6, True), (0.4, False))]
    df = spark.createDataFrame(rows, "class string, score double, positive boolean")
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx(0.833333, abs=1e-6)
    curve = {round(r["fpr"], 6): r["tpr"] for r in metrics.roc_curve(df, 5).collect()}
    assert curve == {0.0: pytest.approx(2 / 3), 0.25: pytest.approx(2 / 3), 0.5: 1.0, 0.75: 1.0, 1.0: 1.0}
    tied = df.withColumn("score", F.lit(0.5))
    assert metrics.roc_auc(tied).first()["auc"] == pytest.approx(0.5)


@pytest.fixture(scope="module")
def cases(spark):
    rows = []
    for i in range(240):
        bad = i % 3 == 0
        rows.append((i, "M" if i % 2 else "f", str(70 + i % 9) if bad else str(20 + i % 9),
                     "WARFARIN" if bad else f"DRUG{i % 4}", "SEPSIS" if i % 60 == 0 else f"PT{i % 5}", 5 if bad else 1))
    return spark.createDataFrame(rows, "primaryid long, sex string, age string, drugname string, pt string, severity_level int")


def test_encoder_learns_from_training_rows_and_survives_saving(spark, cases, tmp_path):
    train = cases.filter("primaryid % 7 > 0")
    enc = training.CaseEncoder.fit(train, "severity_level")
    coded = enc.transform(cases)
    assert coded.filter("drug_encoded = -1").count() == 0
    enc.save(str(tmp_path / "enc"))
    again = training.CaseEncoder.load(spark, str(tmp_path / "enc")).transform(cases)
    assert sorted(coded.select("primaryid", *training.CASE_FEATURES).collect()) == sorted(
        again.select("primaryid", *training.CASE_FEATURES).collect()
    )


def test_models_learn_alert_and_survive_saving(spark, cases, tmp_path):
    enc = training.CaseEncoder.fit(cases, "severity_level", cutoff=0.0)
    coded = enc.transform(cases)
    forest = training.classifiers(trees=5, depth=4)["random_forest"]
    model = training.fit(forest, coded.select(*training.CASE_FEATURES, "severity_level"), training.CASE_FEATURES, "severity_level")
    alerts = training.risk_alerts(cases, enc, model).collect()
    assert {r["primaryid"] for r in alerts} == {i for i in range(240) if i % 3 == 0}
    assert {r["severity_label"] for r in alerts} == {"Muy Grave"} and all(0.5 < r["confidence_score"] <= 1 for r in alerts)
    model.save(str(tmp_path / "m"), spark)
    again = training.FittedModel.load(spark, str(tmp_path / "m"))
    assert sorted(r["prediction"] for r in again.predict(coded).collect()) == sorted(r["prediction"] for r in model.predict(coded).collect())


def test_boosted_scores_are_shares(cases):
    coded = training.CaseEncoder.fit(cases, "severity_level").transform(cases)
    boosted = training.classifiers(rounds=2)["boosted_trees"]
    model = training.fit(boosted, coded.select(*training.CASE_FEATURES, "severity_level"), training.CASE_FEATURES, "severity_level")
    for r in model.predict(coded).limit(5).collect():
        assert math.isclose(sum(r["scores"]), 1.0) and r["confidence"] == max(r["scores"])


def test_comparison_selects_by_cross_validation(cases):
    coded = training.CaseEncoder.fit(cases, "severity_level").transform(cases)
    quick = training.classifiers(trees=3, depth=3)
    run = training.compare(
        {k: quick[k] for k in ("logistic_regression", "random_forest")}, coded, "primaryid", ["age", "sex_encoded"], "severity_level", folds=2
    )
    rows = {r["model"]: r for r in run.table.collect()}
    assert rows["random_forest"]["test_accuracy"] > 0.9
    best = max(rows.values(), key=lambda r: (r["cv_macro_f1"], r["model"] < "p"))
    assert run.best() is run.models[best["model"]]


def test_forest_rows_are_dealt_to_the_cores(spark):
    from pyspark.ml.classification import RandomForestClassifier

    seen = []

    class Watched(RandomForestClassifier):
        def _fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    rows = spark.range(0, 9000, 1, 1).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    for how, wanted in ({"numTrees": 100, "maxDepth": 16}, 4), ({"numTrees": 10, "maxDepth": 6}, 1):
        forest = Watched(labelCol="_y", weightCol="_weight", cacheNodeIds=True, **how)
        assert training._dealt(rows, 9000, forest).rdd.getNumPartitions() == wanted
    training.fit(Watched(labelCol="_y", weightCol="_weight", numTrees=500, maxDepth=2), rows, ["x"], "y")
    assert seen == [3]
    assert training.classifiers()["random_forest"].getCacheNodeIds()


def test_folds_are_fitted_at_once_and_keep_their_scores(spark, monkeypatch):
    met = threading.Barrier(3, timeout=120)
    lonely = []

    def grown(train, *_):
        try:
            met.wait()
        except threading.BrokenBarrierError:
            lonely.append(1)
        return train

    class Always:
        def __init__(self, value):
            self.value = value

        def predict(self, df):
            return df.withColumn("prediction", F.lit(self.value))

    monkeypatch.setattr(training, "balanced_rows", grown)
    monkeypatch.setattr(training, "fit", lambda estimator, *_: Always(estimator))
    rows = spark.range(30).select("id", F.when(F.col("id") < 6, 1).otherwise(0).alias("y"))
    found = training.cross_validate({"zero": 0, "one": 1}, rows, "id", ["id"], "y", folds=3)
    assert not lonely
    assert found["zero"] == pytest.approx([4 / 9] * 3) and found["one"] == pytest.approx([1 / 6] * 3)
