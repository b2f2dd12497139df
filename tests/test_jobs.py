import random

import pytest

from caselume.operators import signals
from caselume.plans import jobs, training


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """A small delimited extract: bad keys, blanks, stray codes, repeated rows."""
    folder = tmp_path_factory.mktemp("raw")
    rnd = random.Random(4)
    lines = {t: [] for t in ("demo", "drug", "reac", "outc", "indi", "ther", "rpsr")}
    for k in range(1, 121):
        bad = k % 4 == 0
        lines["demo"].append(f"{k}$c{k}${'M' if k % 2 else 'x'}${60 + k % 30 if bad else k % 50}$us$2025{1 + k % 9:02d}01")
        lines["drug"].append(f"{k}$1$ps${'Warfarin ' if bad else rnd.choice(['aspirin', 'ibuprofen'])}$oral$10")
        lines["drug"].append(f"{k}$2$SS${rnd.choice(['aspirin', 'zinc'])}$$99999")
        lines["reac"].append(f"{k}${'haemorrhage' if bad else rnd.choice(['nausea', 'skin rash'])}$")
        lines["outc"].append(f"{k}${'DE' if bad else 'OT'}")
        lines["indi"].append(f"{k}$")
        lines["ther"].append(f"{k}$1$")
        lines["rpsr"].append(f"{k}$hp")
    lines["demo"] += [lines["demo"][0], "$c0$M$1$us$20250101"]
    heads = {
        "demo": "primaryid$caseid$sex$age$reporter_country$fda_dt", "drug": "primaryid$drug_seq$role_cod$drugname$route$dose_amt",
        "reac": "primaryid$pt$drug_rec_act", "outc": "primaryid$outc_cod", "indi": "primaryid$indi_pt",
        "ther": "primaryid$drug_seq$start_dt", "rpsr": "primaryid$rpsr_cod",
    }
    for t, rows in lines.items():
        (folder / f"{t.upper()}01.txt").write_bytes("\n".join([heads[t], *rows, ""]).encode("latin-1"))
    return str(folder)


def test_from_raw_files_to_alerts(spark, raw, tmp_path):
    at = lambda name: str(tmp_path / name)
    jobs.profile_job(spark, raw, at("profile"))
    plan = spark.read.option("header", True).csv(at("profile/columns"))
    assert plan.filter("table = 'INDI' and column = 'indi_pt'").first()["action"] == "eliminar_columna"

    jobs.clean_job(spark, raw, at("clean"))
    audit = {(r["table"], r["measure"]): r["value"] for r in spark.read.json(at("clean/_audit")).collect()}
    assert audit[("demo", "blank_key")] == 1 and audit[("demo", "rows_in")] == 122 and audit[("demo", "rows_out")] == 120
    assert audit[("drug", "dose_out_of_range")] == 120

    jobs.consolidate_job(spark, at("clean"), at("joined"))
    joined = spark.read.parquet(at("joined"))
    assert joined.count() == 240 and joined.filter("drug_encoded < 0 or pt_encoded < 0").count() == 0
    assert {r[0] for r in joined.select("severity_level").distinct().collect()} == {1, 5}
    jobs.consolidate_job(spark, at("clean"), at("sampled"), sample=10)
    assert spark.read.parquet(at("sampled")).select("primaryid").distinct().count() == 10

    jobs.signal_job(spark, at("clean"), at("signals"))
    found = spark.read.option("header", True).csv(at("signals"))
    assert found.orderBy("drugname").filter("drugname = 'WARFARIN' and pt = 'HAEMORRHAGE'").count() == 1
    direct = signals.safety_signals(joined)
    assert {(r["drugname"], r["pt"]) for r in found.collect()} == {(r["drugname"], r["pt"]) for r in direct.collect()}
    jobs.signal_job(spark, at("clean"), at("case_signals"), unit="cases")
    assert spark.read.option("header", True).csv(at("case_signals")).filter("drugname = 'WARFARIN'").count() == 1

    quick = {"random_forest": training.classifiers(trees=3, depth=3)["random_forest"]}
    run = jobs.train_job(spark, at("joined"), at("model"), quick, folds=2)
    assert run.table.first()["test_macro_f1"] > 0.8
    assert spark.read.json(at("model/masked")).first()["terms_masked"] >= 1
    audited = {r["feature"]: (r["before"], r["after"]) for r in spark.read.json(at("model/leakage")).collect()}
    assert set(audited) == {"age", "sex_encoded", "drug_encoded", "pt_encoded"}
    assert audited["age"][0] == audited["age"][1] and audited["pt_encoded"][0] >= audited["pt_encoded"][1]
    report = {r["class"]: r for r in spark.read.json(at("model/evaluation/report")).collect()}
    assert {"1", "5", "macro", "weighted", "accuracy"} == set(report) and report["macro"]["f1"] > 0.8
    assert spark.read.json(at("model/evaluation/confusion")).count() == 4
    assert spark.read.json(at("model/evaluation/auc")).count() == 2 and spark.read.json(at("model/evaluation/roc")).count() > 10

    jobs.score_job(spark, at("joined"), at("model"), at("alerts"))
    alerts = spark.read.json(at("alerts"))
    assert alerts.filter("predicted_severity < 4").count() == 0 and alerts.count() > 0


def test_balance_job(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 7), int(i > 50)) for i in range(60)], "id long, v double, y int")
    df.write.parquet(str(tmp_path / "in"))
    jobs.balance_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), "smote", "id", ["v"], "y")
    counts = {r["y"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("y").count().collect()}
    assert counts == {0: 51, 1: 51}


def test_sample_and_tolerant_cleaning(spark, raw, tmp_path):
    jobs.sample_job(spark, raw, str(tmp_path / "small"), 7)
    loaded = jobs.read_raw(spark, str(tmp_path / "small"))
    keys = [{r["primaryid"] for r in df.select("primaryid").distinct().collect()} for df in loaded.values()]
    assert all(k == keys[0] for k in keys) and len(keys[0]) == 7
    assert loaded["drug"].count() == 14 and loaded["demo"].columns == jobs.read_raw(spark, raw, ("demo",))["demo"].columns
    (tmp_path / "RPSR1.txt").write_text("primaryid$rpsr_cod\n1$HP\n2$HP$x$y\n")
    (tmp_path / "RPSR2.txt").write_text("rpsr_cod$primaryid\nCSM$3\n$$$\nHP$4$\n")
    jobs.clean_job(spark, str(tmp_path), str(tmp_path / "clean"), ("rpsr",), tolerant=True)
    audit = {(r["table"], r["measure"]): r["value"] for r in spark.read.json(str(tmp_path / "clean/_audit")).collect()}
    assert audit["rpsr", "bad_lines"] == 3 and audit["rpsr", "rows_out"] == 2


def test_balance_report(spark, tmp_path):
    df = spark.createDataFrame([(i, int(i > 50)) for i in range(60)], "id long, y int")
    df.write.parquet(str(tmp_path / "all"))
    df.filter("id > 41").write.parquet(str(tmp_path / "less"))
    jobs.balance_report_job(spark, str(tmp_path / "all"), str(tmp_path / "out"), {"random_undersampling": str(tmp_path / "less")}, "y")
    row = spark.read.option("header", True).csv(str(tmp_path / "out/comparison")).first()
    assert (row["rows_before"], row["rows_after"], row["ratio_after"]) == ("60", "18", "1.0")
    assert spark.read.option("header", True).csv(str(tmp_path / "out/classes")).count() == 2
