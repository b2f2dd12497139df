import pytest
from pyspark.sql import functions as F

from caselume.operators import assemble, signals


@pytest.fixture(scope="module")
def reports(spark):
    rows = [("A", "X")] * 20 + [("A", "Y")] * 5 + [("B", "X")] * 10 + [("B", "Y")] * 165
    return spark.createDataFrame(rows, "drugname string, pt string")


def test_signal_of_the_worked_example(spark, reports):
    got = signals.safety_signals(reports).collect()
    assert [(r["drugname"], r["pt"]) for r in got] == [("A", "X"), ("B", "Y")]
    assert (got[0]["count_a"], round(got[0]["prr"], 6), round(got[0]["chi2"], 6)) == (20, 14.0, 88.941176)


def test_missing_names_count_as_unknown(spark):
    df = spark.createDataFrame([(None, "X")] * 5 + [("A", "Y")] * 50, "drugname string, pt string")
    assert signals.safety_signals(df).filter("pt = 'X'").first()["drugname"] == "UNKNOWN"


def test_grouping_sets_skip_blank_sides_only(spark):
    df = spark.createDataFrame([("A", "X"), ("A", None), ("", "X"), ("A", "X")], "drugname string, pt string")
    got = {(r["kind"], r["drugname"], r["pt"]): r["n"] for r in signals.grouping_set_counts(df, "drugname", "pt").collect()}
    assert got == {("TOTAL", None, None): 4, ("DRUG", "A", None): 3, ("REAC", None, "X"): 3, ("PAIR", "A", "X"): 2}


def test_cases_as_the_unit(spark):
    df = spark.createDataFrame([(1, "A", "X")] * 7 + [(2, "A", "Y"), (3, "B", "Y")], "c int, drugname string, pt string")
    got = {(r["drugname"], r["pt"]): r for r in signals.contingency(df, "drugname", "pt", "c").collect()}
    r = got[("A", "X")]
    assert (r["count_a"], r["count_b"], r["count_c"], r["count_d"]) == (1, 1, 0, 1)


def test_pair_counts_add_up(spark, reports):
    assert signals.pair_counts(reports, "drugname", "pt").agg(F.sum("count_a")).first()[0] == 200


def test_signal_lookup_marks_known_pairs(spark, reports):
    known = signals.safety_signals(reports)
    got = signals.attach_signals(reports.distinct(), known, "drugname", "pt").collect()
    assert {(r["drugname"], r["pt"]): r["known_signal"] for r in got}[("A", "X")] is True
    assert sum(r["known_signal"] for r in got) == 2


def tables(spark):
    demo = spark.createDataFrame([(1, "F"), (2, "M"), (3, "F")], "primaryid int, sex string")
    drug = spark.createDataFrame([(1, "A"), (1, "B"), (1, "A"), (2, "A")], "primaryid int, drugname string")
    reac = spark.createDataFrame([(1, "X"), (1, "Y"), (2, "X"), (3, "X")], "primaryid int, pt string")
    outc = spark.createDataFrame([(1, "DE"), (1, "HO"), (2, "OT")], "primaryid int, outc_cod string")
    return {"demo": demo, "drug": drug, "reac": reac, "outc": outc}


def test_product_join_and_its_forecast(spark):
    t = tables(spark)
    joined = assemble.consolidate(t)
    assert joined.count() == 3 * 2 * 2 + 1
    size = assemble.explosion_size(t).first()
    assert (size["joined_rows"], size["largest_key_rows"], size["joined_keys"]) == (13.0, 12.0, 2)
    assert set(r["severity_level"] for r in joined.collect()) == {5, 3, 1}


def test_factorised_pair_counts_equal_the_join(spark):
    t = tables(spark)
    fast = assemble.joined_pair_counts(t["drug"], t["reac"], [t["demo"], t["outc"]], "drugname", "pt")
    slow = signals.pair_counts(assemble.join_product(t), "drugname", "pt")
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_colliding_columns_get_the_table_name(spark):
    a = spark.createDataFrame([(1, "a")], "primaryid int, code string")
    b = spark.createDataFrame([(1, "b")], "primaryid int, code string")
    assert assemble.join_product({"x": a, "y": b}).columns == ["primaryid", "code", "code_y"]
    assert assemble.join_product({"x": a, "y": b}, always_suffix=True).columns == ["primaryid", "code_x", "code_y"]


def test_common_keys_and_the_relaxed_rule(spark):
    t = tables(spark)
    assert sorted(r[0] for r in assemble.common_keys(t).collect()) == [1, 2]
    t["outc"] = t["outc"].filter("primaryid > 9")
    assert sorted(r[0] for r in assemble.common_keys(t).collect()) == [1, 2]
    assert assemble.common_keys(t, core=()).count() == 0


def test_coherent_sample_is_repeatable(spark):
    cut = [assemble.coherent_sample(tables(spark), 1, ("demo", "drug", "reac", "outc")) for _ in range(2)]
    keys = [{name: sorted(set(r["primaryid"] for r in df.collect())) for name, df in c.items()} for c in cut]
    assert keys[0] == keys[1] and all(len(k) == 1 for k in keys[0].values())


def test_cases_without_drug_or_reaction_are_left_out(spark):
    t = tables(spark)
    cases = assemble.assemble_cases(
        t["demo"], t["drug"], t["reac"], t["outc"].filter("primaryid = 2"), demo_cols=("sex",), drug=("drugname", "drugname")
    )
    got = {r["primaryid"]: r for r in cases.collect()}
    assert sorted(got) == [1, 2]
    assert got[1]["drugs"] == ["A", "A", "B"] and got[1]["outcomes"] == []


def test_a_heavy_case_stays_one_row_and_a_child_table_spreads_it(spark):
    rows = [(1, i, "same") for i in range(40)] + [(1, 100 + i % 3, f"d{i % 5}") for i in range(35)] + [(2, 1, "z")]
    df = spark.createDataFrame(rows, "primaryid int, s int, item string")
    want = [i for _, _, i in sorted(rows[:-1], key=lambda r: (r[1], r[2]))]
    lists = {r["primaryid"]: r["items"] for r in assemble.ordered_lists(df, "primaryid", "s", "item", "items").collect()}
    assert lists == {1: want, 2: ["z"]}
    child = assemble.case_items(df, "primaryid", "s", "item").collect()
    assert [r["item"] for r in sorted(child, key=lambda r: r["position"]) if r["primaryid"] == 1] == want
    assert sorted(r["position"] for r in child if r["primaryid"] == 1) == list(range(1, 76))


def test_a_heavy_case_is_assembled_and_alerts_once(spark):
    from caselume.streaming import alerts

    demo = spark.createDataFrame([(1, "F")], "primaryid int, sex string")
    drug = spark.createDataFrame([(1, i, f"d{i}") for i in range(500)], "primaryid int, drug_seq int, drugname string")
    reac = spark.createDataFrame([(1, f"r{i}") for i in range(40)], "primaryid int, pt string")
    outc = spark.createDataFrame([], "primaryid int, outc_cod string")
    cases = assemble.assemble_cases(demo, drug, reac, outc, demo_cols=("sex",))
    assert cases.count() == 1 and alerts.first_pair(cases).count() == 1
    assert assemble.case_pairs(cases, keep=("primaryid",)).distinct().count() == 20_000


def test_a_hot_key_of_the_product_is_dealt_out(spark):
    a = spark.createDataFrame([(1, i) for i in range(400)] + [(k, k) for k in range(2, 200)], "primaryid int, a int")
    b = spark.createDataFrame([(1, i) for i in range(30)] + [(k, k) for k in range(2, 200)] + [(None, 5)], "primaryid int, b int")
    c = spark.createDataFrame([(1, i) for i in range(3)] + [(k, k) for k in range(2, 150)], "primaryid int, c int")
    tables = {"a": a, "b": b, "c": c}
    plain = assemble.join_product(tables, heavy_rows=10**9)
    split = assemble.join_product(tables, heavy_rows=1000, salts=16)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect())) and plain.count() == 400 * 30 * 3 + 148
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = assemble.join_product(tables, heavy_rows=1000, salts=16).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 0.5 * sum(sizes)


def test_signals_by_case_from_child_tables(spark):
    drugs = spark.createDataFrame([(k, f"d{k % 3}") for k in range(60)] * 2 + [(100, "d0"), (7, None)], "primaryid int, drugname string")
    terms = spark.createDataFrame([(k, f"t{k % 4}") for k in range(60)] + [(k, "t0") for k in range(0, 60, 5)] + [(101, "t1")], "primaryid int, pt string")
    rows = drugs.dropna().join(terms, "primaryid")
    want = signals.contingency(rows, "drugname", "pt", case="primaryid")
    got = signals.case_contingency(drugs, terms, "drugname", "pt", "primaryid")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_limited_join_counts_the_first_keys(spark):
    t = tables(spark)
    assert assemble.limited_join_count(t["demo"], t["drug"], n=1).first()["joined_rows"] == 3


def test_top_pairs_break_ties_by_name(spark):
    df = spark.createDataFrame([("B", "X"), ("A", "X"), ("A", "")], "drugname string, pt string")
    counts = signals.pair_counts(df, "drugname", "pt")
    assert [tuple(r) for r in signals.top_pairs(counts, "drugname", "pt", 5).collect()] == [("A", "X", 1), ("B", "X", 1)]


def test_suspect_pairs_filter_by_role(spark):
    drug = spark.createDataFrame(
        [(1, "A", "PS"), (1, "A", "PS"), (1, "B", "C"), (2, "A", "PS")], "primaryid int, drugname string, role_cod string"
    )
    reac = spark.createDataFrame([(1, "X"), (1, "Y"), (2, "X")], "primaryid int, pt string")
    got = assemble.suspect_pair_counts(drug, reac, "drugname", "pt").collect()
    assert sorted(tuple(r) for r in got) == [("A", "X", 3), ("A", "Y", 2)]
