import json
import os

import pytest
from pyspark.sql import functions as F

from caselume.plans import training
from caselume.sources import files, queue
from caselume.streaming import alerts

CASE = "primaryid long, sex string, age double, reporter_country string, drugs array<string>, reactions array<string>, outcomes array<string>"


def group(start, n, drug, term, outcome):
    return [(start + i, "M", 45.0, "US", [drug], [term], [outcome]) for i in range(n)]


def the_batch():
    rows, start = [], 1000
    for n, drug, term, outcome in (
        (20, "WARFARIN", "HAEMORRHAGE", "LT"), (15, "METFORMIN", "LACTIC ACIDOSIS", "HO"),
        (2, "ASPIRIN", "NAUSEA", "OT"), (10, "IBUPROFEN", "HEADACHE", "OT"),
        (10, "ATORVASTATIN", "MYALGIA", "DS"), (20, "LISINOPRIL", "DIZZINESS", "OT"),
    ):
        rows += group(start, n, drug, term, outcome)
        start += n
    return rows


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame(
        [("WARFARIN", "HAEMORRHAGE", 8.5, 22.0, 120), ("METFORMIN", "LACTIC ACIDOSIS", 5.1, 16.8, 85),
         ("IBUPROFEN", "HEADACHE", 1.2, 0.9, 300), ("ATORVASTATIN", "MYALGIA", 3.0, 2.4, 60)],
        "drugname string, pt string, prr double, chi2 double, count_a long",
    )


def found(spark, rows, known):
    return alerts.signal_alerts(spark.createDataFrame(rows, CASE), known).collect()


@pytest.fixture(scope="module")
def batch_alerts(spark, known):
    return found(spark, the_batch(), known)


def test_exactly_the_two_true_pairs_alert(batch_alerts):
    assert {(r["drugname"], r["pt"]) for r in batch_alerts} == {("WARFARIN", "HAEMORRHAGE"), ("METFORMIN", "LACTIC ACIDOSIS")}
    assert len(batch_alerts) == 2 and len(the_batch()) == 77


@pytest.mark.parametrize("drug", ["ASPIRIN", "IBUPROFEN", "ATORVASTATIN", "LISINOPRIL"])
def test_noise_pairs_do_not_alert(batch_alerts, drug):
    assert drug not in {r["drugname"] for r in batch_alerts}


def test_alert_fields(batch_alerts):
    by = {r["drugname"]: r for r in batch_alerts}
    assert by["WARFARIN"]["n_cases_in_batch"] == 20 and by["METFORMIN"]["n_cases_in_batch"] == 15
    assert by["WARFARIN"]["p_value"] == pytest.approx(2.727e-06, rel=1e-3)
    assert all(r["prr"] > 2 and 0 < r["p_value"] < 0.05 and r["n_cases_in_batch"] >= 3 for r in batch_alerts)


def test_repeats_give_one_alert_and_small_batches_none(spark, known):
    many = found(spark, group(0, 50, "WARFARIN", "HAEMORRHAGE", "LT"), known)
    assert len(many) == 1 and many[0]["n_cases_in_batch"] == 50
    assert found(spark, [], known) == []
    assert found(spark, group(1, 1, "WARFARIN", "HAEMORRHAGE", "LT"), known) == []
    twice = [(1, "M", 45.0, "US", ["WARFARIN"] * 3, ["HAEMORRHAGE"] * 3, [])] * 3
    assert found(spark, twice, known) == []


def test_batches_are_counted_apart_and_counters_run_on(spark, known, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    first = [dict(zip([c.split()[0] for c in CASE.split(", ")], r)) | {"stream_timestamp": "2025-01-01T00:00:00"} for r in the_batch()]
    second = [dict(c, primaryid=9000 + i, drugs=["ASPIRIN"], reactions=["HEADACHE"]) for i, c in enumerate(first[:5])]
    for n, part in enumerate((first, second)):
        (src / f"{n}.json").write_text("\n".join(json.dumps(c) for c in part) + "\nnot json\n")
    stream = queue.read_file_cases(spark, str(src))
    run = alerts.start_signal_alerts(stream, known, str(tmp_path / "out"), str(tmp_path / "state"))
    run.awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    totals = alerts.running_counters(queue.read_file_cases(spark, str(src)).withColumn("hit", F.lit(False)), "hit", "sex")
    alerts.write_per_batch(totals, str(tmp_path / "n"), str(tmp_path / "nstate"), mode="complete").trigger(
        availableNow=True
    ).start().awaitTermination()
    counted = sorted(r["consumed"] for r in spark.read.json(str(tmp_path / "n")).collect())
    assert len(counted) == 2 and counted[1] == 82
    again = alerts.start_signal_alerts(stream, known, str(tmp_path / "out"), str(tmp_path / "state"))
    again.awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_windows_do_not_depend_on_how_files_arrive(spark, known, tmp_path):
    rows = [(i, "2025-01-01T0%d:10:00" % (i // 5)) for i in range(20)]
    want = None
    for cut in (1, 4):
        src = tmp_path / f"in{cut}"
        src.mkdir()
        for n in range(cut):
            part = rows[n * len(rows) // cut : (n + 1) * len(rows) // cut]
            lines = [json.dumps({"primaryid": i, "drugs": ["WARFARIN"], "reactions": ["HAEMORRHAGE"], "stream_timestamp": t}) for i, t in part]
            (src / f"{n}.json").write_text("\n".join(lines))
            os.utime(src / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # arrival order
        found_windows = alerts.windowed_signal_alerts(queue.read_file_cases(spark, str(src)), known)
        out = str(tmp_path / f"out{cut}")
        found_windows.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / f"state{cut}")
        ).trigger(availableNow=True).start().awaitTermination()
        got = sorted((str(r["window_start"]), r["n_cases_in_batch"]) for r in spark.read.parquet(out).collect())
        assert len(got) == 3 and all(n == 5 for _, n in got)
        assert want in (None, got)
        want = got


def test_stream_scoring_equals_batch_scoring(spark, tmp_path):
    rows = [(i, "M", 80.0 if i % 2 else 20.0, "US", ["D1" if i % 2 else "D2", "ZZ"], ["P"], ["DE"]) for i in range(60)]
    rows += [(100, "M", 80.0, "US", [], ["P"], [])]
    cases = spark.createDataFrame(rows, CASE)
    flat = alerts.first_pair(cases).withColumn("y", F.when(F.col("age") > 50, 5).otherwise(1))
    enc = training.CaseEncoder.fit(flat, "y", cutoff=0.0)
    coded = enc.transform(flat).select(*training.CASE_FEATURES, "y")
    model = training.fit(training.classifiers(trees=3, depth=3)["random_forest"], coded, training.CASE_FEATURES, "y")
    batch = {r["primaryid"]: r for r in alerts.severity_alerts(cases, enc, model).collect()}
    assert sorted(batch) == [i for i in range(60) if i % 2]
    assert batch[1]["severity_label"] == "Muy Grave" and batch[1]["alert_reason"].startswith("Modelo ML predice severidad=5 (Muy Grave)")
    queue.to_messages(cases).select("value").write.text(str(tmp_path / "in"))
    stream = queue.read_file_cases(spark, str(tmp_path / "in"), 100)
    alerts.start_severity_alerts(stream, enc, model, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    seen = spark.read.json(str(tmp_path / "out")).collect()
    assert {(r["primaryid"], r["confidence_score"]) for r in seen} == {(k, v["confidence_score"]) for k, v in batch.items()}


def test_delimited_reading(spark, tmp_path):
    path = tmp_path / "DRUG.txt"
    path.write_bytes(' PrimaryID $DrugName$n\n1$"OPEN$NA\n2$caf\xe9$\n3$too$many$fields\n4$short\n'.encode("latin-1"))
    rows = {r["primaryid"]: r for r in files.read_delimited(spark, str(path), tolerant=True).collect()}
    assert sorted(rows) == ["1", "2", "4"]
    assert rows["1"]["drugname"] == '"OPEN' and rows["1"]["n"] == "NA"
    assert rows["2"]["drugname"] == "caf\xe9" and rows["2"]["n"] is None and rows["4"]["n"] is None
    assert files.read_delimited(spark, str(path), ["drugname"]).columns == ["drugname"]
    two = files.read_delimited(spark, str(path), limit=2, order_by="primaryid", tolerant=True)
    assert sorted(r["primaryid"] for r in two.collect()) == ["1", "2"]
    assert files.read_delimited(spark, str(path), ["primaryid"], tolerant=True).count() == 3


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "DEMO24Q1.txt").write_text("primaryid$sex$age\n1$F$55\n2$M$40\n3$M$1$torn\n")
    (tmp_path / "DEMO24Q2.txt").write_text("primaryid$age$sex$country\n4$33$F$ES\n")
    path = str(tmp_path / "DEMO*.txt")
    rows = {r["primaryid"]: r.asDict() for r in files.read_delimited(spark, path, tolerant=True).collect()}
    assert rows["4"] == {"primaryid": "4", "sex": "F", "age": "33", "country": "ES"} and rows["1"]["age"] == "55" and rows["1"]["country"] is None
    bad = files.bad_lines(spark, path).collect()
    assert [(r["file"].rpartition("/")[2], r["line"]) for r in bad] == [("DEMO24Q1.txt", "3$M$1$torn")]
    with pytest.raises(Exception, match="too many fields"):
        files.read_delimited(spark, path).collect()


def test_headers_take_one_job_however_many_files(spark, tmp_path):
    def jobs_of(n):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for i in range(n):
            (folder / f"F{i:02d}.txt").write_text(f"{' A' if i % 3 else 'B'} $v\n" + f"{i}$x\n" * 3000)
        (folder / "G.txt").write_text("")
        spark.sparkContext.setJobGroup(f"headers{n}", "")
        found = files.headers_of(spark, str(folder / "*.txt"))
        assert sorted(map(len, found.values())) == sorted([len(range(0, n, 3)), n - len(range(0, n, 3))]) and set(found) == {("a", "v"), ("b", "v")}
        assert files.read_delimited(spark, str(folder / "*.txt")).count() == 3000 * n
        return len([j for j in spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers{n}")])

    few, many = jobs_of(4), jobs_of(24)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert few == many
    (tmp_path / "X.txt").write_text("a$$a\n1$2$3\n")
    assert list(files.headers_of(spark, str(tmp_path / "X.txt"))) == [("a0", "_c1", "a2")]


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from caselume.functions import scale

    context = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scale.staging_dir(SimpleNamespace(sparkContext=context))


def test_a_stream_can_stay_on_its_source(spark, tmp_path):
    import time

    (tmp_path / "in").mkdir()
    case = '{"primaryid": 1, "drugs": ["A"], "reactions": ["X"], "stream_timestamp": "2024-01-01T00:00:00"}'
    stream = queue.read_file_cases(spark, str(tmp_path / "in"), 100).selectExpr("drugs[0] as level")
    run = alerts.start_level_counts(stream, str(tmp_path / "out"), str(tmp_path / "state"), "level", {"processingTime": "200 milliseconds"})
    try:
        for n in range(2):
            (tmp_path / "in" / f"f{n}.json").write_text(case.replace(": 1", f": {n + 1}") + "\n")
            for _ in range(100):
                if list((tmp_path / "out").glob(f"batch={n}/*.json")):
                    break
                time.sleep(0.3)
        assert run.isActive
        totals = spark.read.json(str(tmp_path / "out")).groupBy().max("alerts").first()[0]
        assert totals == 2
    finally:
        run.stop()


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "caf\xe9"), ("2", None)], "primaryid string, v string")
    files.write_delimited(df, str(tmp_path / "d"))
    assert sorted(files.read_delimited(spark, str(tmp_path / "d")).collect()) == sorted(df.collect())


def test_json_lines_drop_corrupt_lines_and_hidden_files(spark, tmp_path):
    folder = tmp_path / "j"
    folder.mkdir()
    (folder / "a.json").write_text('{"k": 1, "v": "x"}\nbroken\n{"k": 2}\n')
    (folder / "_b.json").write_text('{"k": 9}\n')
    (folder / ".c.json").write_text('{"k": 9}\n')
    df = files.read_json_lines(spark, str(folder), "k int, v string")
    assert sorted(r["k"] for r in df.collect()) == [1, 2] and df.select("k").count() == 2


def test_tagged_json_csv_parquet(spark, tmp_path, known):
    files.write_json_lines(known, str(tmp_path / "j"), "signals")
    assert spark.read.json(str(tmp_path / "j")).filter("table = 'signals'").count() == 4
    files.write_csv(known, str(tmp_path / "c"))
    back = files.read_signals(spark, str(tmp_path / "c"))
    assert {r["drugname"]: r["prr"] for r in back.collect()}["WARFARIN"] == 8.5
    files.write_parquet(known, str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p"), ["pt"]).columns == ["pt"]
    files.write_json(known, str(tmp_path / "doc"))
    assert spark.read.json(str(tmp_path / "doc")).count() == 4


def test_messages_and_stamps(spark):
    df = spark.createDataFrame(the_batch()[:2], CASE)
    values = queue.to_messages(queue.stamp_cases(df))
    parsed = queue.parse_cases(values)
    assert parsed.count() == 2 and parsed.first()["ts"] is not None
