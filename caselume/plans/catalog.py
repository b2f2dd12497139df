"""Every registered query: name -> function of (session, folder with the tables)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as tx
from ..functions.scale import stage, staging_dir
from ..operators import assemble, balance, clean, encode, knn, leakage, metrics, profile, quality, signals, split
from . import inputs
from .inputs import FEATURES, labelled, table

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
            for f in df.schema
        ]
    )


# --- signals ---------------------------------------------------------------------


@query
def signals_prr_chi2(spark, sf):
    return _round(signals.safety_signals(inputs.reports(spark, sf)))


@query
def signals_all_pairs(spark, sf):
    df = inputs.reports(spark, sf)
    return _round(signals.score_pairs(signals.contingency(df, "drugname", "pt"), "drugname", "pt", clamp=True))


@query
def signals_by_case(spark, sf):
    rows = inputs.reports(spark, sf)
    drugs = rows.select("primaryid", F.col("p_brand").alias("drugname"))
    table_ = signals.case_contingency(drugs, rows.select("primaryid", "pt"), "drugname", "pt", "primaryid")
    return _round(signals.keep_signals(signals.score_pairs(table_, "drugname", "pt"), min_prr=1.2))


@query
def pair_counts_grouping_sets(spark, sf):
    return signals.grouping_set_counts(inputs.reports(spark, sf), "drugname", "pt")


@query
def top_pairs(spark, sf):
    rows = inputs.reports(spark, sf)
    counts = assemble.suspect_pair_counts(rows, rows, "p_brand", "pt", "l_returnflag", "R")
    return signals.top_pairs(counts, "p_brand", "pt", 20)


@query
def signal_lookup(spark, sf):
    rows = inputs.reports(spark, sf)
    found = signals.safety_signals(rows)
    hits = signals.attach_signals(rows.select("primaryid", "drugname", "pt"), found, "drugname", "pt")
    return hits.groupBy("drugname", "known_signal").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("prr"), 6).alias("max_prr")
    )


# --- profiles --------------------------------------------------------------------


@query
def pivot_top_pairs(spark, sf):
    return profile.top_pivot(inputs.reports(spark, sf), "p_brand", "p_type", 10, 10)


@query
def monthly_series(spark, sf):
    return profile.monthly_series(inputs.demo(spark, sf), "fda_dt")


@query
def month_country_pivot(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("fda_dt"), "c_mktsegment"
    )
    return profile.month_pivot(rows, "fda_dt", "c_mktsegment", 10)


@query
def column_profile(spark, sf):
    return profile.column_profile(inputs.demo(spark, sf), "primaryid", "DEMO")


@query
def table_profile(spark, sf):
    rows = inputs.drugs(spark, sf).select("primaryid", "drugname", "role_cod")
    return profile.table_profile(rows, "primaryid", "DRUG")


@query
def duplicate_stats(spark, sf):
    rows = inputs.drugs(spark, sf).select("primaryid", "role_cod", "route")
    return profile.duplicate_stats(rows, "primaryid", "DRUG")


@query
def repeated_keys(spark, sf):
    return profile.repeated_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query
def distinct_counts(spark, sf):
    return profile.distinct_counts(inputs.reports(spark, sf), ["drugname", "pt", "p_brand"])


@query
def value_share(spark, sf):
    rows = inputs.drugs(spark, sf)
    return profile.value_share(rows, "role_cod", "??", rules.ROLE_LABELS, rules.UNKNOWN_LABEL)


@query
def top_n(spark, sf):
    return profile.top_n(table(spark, sf, "lineitem"), "l_suppkey", 25)


@query
def histogram_bins(spark, sf):
    return _round(profile.histogram(table(spark, sf, "customer"), "c_acctbal", 40))


@query
def reactions_per_case_histogram(spark, sf):
    per = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return _round(profile.histogram(per, "n", 20, low=0, high=20, clip_high=20))


@query
def grouped_describe(spark, sf):
    return _round(profile.describe(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"]), 4)


@query
def per_case_describe(spark, sf):
    return _round(profile.per_case_describe(table(spark, sf, "lineitem"), "l_orderkey"))


@query
def range_filters(spark, sf):
    age, dose = tx.to_number("age"), tx.to_number("dose_amt")
    a = inputs.demo(spark, sf).filter(age.between(*rules.AGE_RANGE)).agg(F.count(F.lit(1)).alias("n"))
    d = inputs.drugs(spark, sf).filter(tx.within(dose, *rules.DOSE_RANGE, closed=False).isNotNull()).agg(
        F.count(F.lit(1)).alias("n")
    )
    return a.select(F.lit("age").alias("rule"), "n").unionByName(d.select(F.lit("dose").alias("rule"), "n"))


@query
def class_balance(spark, sf):
    return _round(profile.class_balance(labelled(spark, sf), "quality"))


@query
def class_table(spark, sf):
    return profile.class_table(inputs.scored(spark, sf), "severity")


@query
def feature_mix(spark, sf):
    return _round(profile.feature_mix(labelled(spark, sf), ("doc_id", "quality", "toxic")))


@query
def recommend_technique(spark, sf):
    rows = labelled(spark, sf)
    out = quality.recommend(
        profile.class_balance(rows, "quality"), profile.feature_mix(rows, ("doc_id", "quality", "toxic"))
    )
    return _round(
        out.select(
            "rows", "ratio", F.array_join("techniques", ",").alias("techniques"), "winner",
            F.array_join("alternatives", ",").alias("alternatives"), "label",
        )
    )


@query
def quality_plan(spark, sf):
    return quality.column_actions(profile.column_profile(inputs.demo(spark, sf), "primaryid", "DEMO")).select(
        "column", "pct_null", "action"
    )


@query
def quality_plan_totals(spark, sf):
    rows = inputs.drugs(spark, sf)
    return quality.plan_totals(quality.column_actions(profile.column_profile(rows, "primaryid", "DRUG")))


# --- cleaning --------------------------------------------------------------------


@query
def clean_codes(spark, sf):
    rows = inputs.drugs(spark, sf).select(
        tx.valid_code("role_cod", rules.ROLE_CODES, rules.ROLE_DEFAULT).alias("role_cod"),
        tx.valid_code("dechal", rules.CHALLENGE_CODES, rules.CHALLENGE_DEFAULT).alias("dechal"),
        tx.upper_strip(F.coalesce("route", F.lit(rules.ROUTE_DEFAULT))).alias("route"),
    )
    return rows.groupBy("role_cod", "dechal", "route").agg(F.count(F.lit(1)).alias("n"))


@query
def clean_ranges_median(spark, sf):
    rows = inputs.demo(spark, sf).select(
        tx.clean_key("primaryid").alias("primaryid"),
        tx.within(tx.to_number("age"), *rules.AGE_RANGE).alias("age"),
    )
    return clean.impute_median(rows, ["age"], rules.AGE_FALLBACK)


@query
def impute_fixed(spark, sf):
    rows = inputs.demo(spark, sf).select(
        "primaryid", tx.within(tx.to_number("age"), *rules.AGE_RANGE).alias("age")
    )
    return clean.impute_value(rows, "age", rules.AGE_FALLBACK).groupBy("age").agg(F.count(F.lit(1)).alias("n"))


@query
def synonym_map(spark, sf):
    rows = inputs.reactions(spark, sf).withColumn("pt", tx.upper_strip("pt"))
    return clean.map_synonyms(rows, "pt").groupBy("pt").agg(F.count(F.lit(1)).alias("n"))


@query
def min_length(spark, sf):
    rows = inputs.reactions(spark, sf).withColumn("pt", tx.upper_strip("pt"))
    return clean.long_enough(rows, "pt").groupBy("pt").agg(F.count(F.lit(1)).alias("n"))


@query
def title_terms(spark, sf):
    rows = table(spark, sf, "part").select(tx.title_case(F.concat("p_name", F.lit("'s"))).alias("term"))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query
def drop_sparse_columns(spark, sf):
    return clean.drop_sparse_columns(
        inputs.demo(spark, sf).drop("age", "reporter_country", "fda_dt"), rules.SPARSE_SHARE["demo"], True
    )


@query
def normalize_key(spark, sf):
    return inputs.demo(spark, sf).select("primaryid", tx.clean_key("primaryid").alias("key"))


@query
def severity_map(spark, sf):
    code = F.get(F.array(*[F.lit(c) for c in (" de", "LT", "ho ", "DS", "XX")]), F.col("l_linenumber") % 5)
    rows = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, code).alias("outc_cod"),
        F.when(F.col("l_returnflag") == "A", "m").when(F.col("l_returnflag") == "R", " F").alias("sex"),
    )
    out = clean.with_severity(rows).withColumn("sex_encoded", clean.sex_value("sex"))
    out = out.withColumn("label", clean.severity_label("severity_level")).withColumn(
        "band", clean.recommendation_band("severity_level")
    )
    return out.groupBy("severity_level", "label", "band", "sex_encoded").agg(F.count(F.lit(1)).alias("n"))


@query
def shifted_labels(spark, sf):
    rows = inputs.scored(spark, sf).select("o_orderkey", "severity")
    back = clean.unshift_labels(clean.shift_labels(rows, "severity"), "label", "restored")
    return back.groupBy("severity", "label", "restored").agg(F.count(F.lit(1)).alias("n"))


@query
def clean_demo_table(spark, sf):
    return clean.clean_demo(inputs.demo(spark, sf)).clean


@query
def clean_drug_table(spark, sf):
    return clean.clean_drug(inputs.drugs(spark, sf)).clean


@query
def clean_reac_table(spark, sf):
    return clean.clean_reac(inputs.reactions(spark, sf)).clean


@query
def clean_indi_table(spark, sf):
    rows = inputs.reactions(spark, sf).select("primaryid", F.col("pt").alias("indi_pt"))
    return clean.clean_indi(rows).clean


@query
def clean_outc_table(spark, sf):
    o = table(spark, sf, "orders")
    code = F.get(
        F.array(*[F.lit(c) for c in (" de", "lt", "HO", None, "zz")]),
        F.substring("o_orderpriority", 1, 1).cast("int") - 1,
    )
    return clean.clean_outc(o.select(F.col("o_orderkey").cast("string").alias("primaryid"), code.alias("outc_cod"))).clean


@query
def clean_ther_table(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("primaryid"),
        (F.col("l_linenumber") - 2).cast("string").alias("drug_seq"),
        F.lit(None).cast("string").alias("start_dt"),
    )
    return clean.clean_ther(rows).clean


@query
def clean_rpsr_table(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.select(
        F.col("o_orderkey").cast("string").alias("primaryid"),
        F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus")).alias("rpsr_cod"),
    )
    return clean.clean_rpsr(rows).clean


@query
def cleaning_audit(spark, sf):
    d = clean.clean_demo(inputs.demo(spark, sf)).audit()
    g = clean.clean_drug(inputs.drugs(spark, sf)).audit()
    r = clean.clean_reac(inputs.reactions(spark, sf)).audit()
    return d.unionByName(g).unionByName(r)


# --- joins -----------------------------------------------------------------------


def _four_tables(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return {
        "demo": o.select(F.col("o_orderkey").alias("primaryid"), F.col("o_orderstatus").alias("code")),
        "drug": li.select(F.col("l_orderkey").alias("primaryid"), F.col("l_partkey").alias("drug"), F.col("l_returnflag").alias("code")),
        "reac": li.select(F.col("l_orderkey").alias("primaryid"), F.col("l_suppkey").alias("pt")),
        "outc": o.filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("primaryid"), F.col("o_orderpriority").alias("outc_cod")),
    }


@query
def join_multiway_inner(spark, sf):
    joined = assemble.join_product(_four_tables(spark, sf))
    return joined.groupBy("pt", "code", "code_drug", "outc_cod").agg(
        F.count(F.lit(1)).alias("n"), F.sum("drug").alias("drug_sum")
    )


@query
def joined_pair_counts(spark, sf):
    t = _four_tables(spark, sf)
    return assemble.joined_pair_counts(t["drug"], t["reac"], [t["demo"], t["outc"]], "code", "pt")


@query
def explosion_size(spark, sf):
    return assemble.explosion_size(_four_tables(spark, sf))


@query
def common_keys(spark, sf):
    return assemble.common_keys(_four_tables(spark, sf))


@query
def coherent_sample(spark, sf):
    t = _four_tables(spark, sf)
    cut = assemble.coherent_sample(t, 500, ("demo", "drug", "reac", "outc"))
    return cut["drug"].groupBy("primaryid").agg(F.count(F.lit(1)).alias("n"), F.sum("drug").alias("drug_sum"))


@query
def limited_join(spark, sf):
    t = _four_tables(spark, sf)
    return assemble.limited_join_count(t["demo"], t["drug"])


@query
def case_assembly(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    demo = o.select(F.col("o_orderkey").alias("primaryid"), F.col("o_orderstatus").alias("sex"))
    drugs = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("primaryid"), F.col("l_linenumber").alias("drug_seq"),
        F.col("l_partkey").cast("string").alias("drugname"),
    )
    reac = li.select(F.col("l_orderkey").alias("primaryid"), F.col("l_suppkey").cast("string").alias("pt"))
    outc = o.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("primaryid"), F.col("o_orderpriority").alias("outc_cod")
    )
    cases = assemble.assemble_cases(demo, drugs, reac, outc, demo_cols=("sex",))
    return cases.select(
        "primaryid", "sex", *[F.array_join(c, ",").alias(c) for c in ("drugs", "reactions", "outcomes")]
    )


# --- balancing -------------------------------------------------------------------


@query
def undersample(spark, sf):
    return balance.undersample(inputs.scored(spark, sf).select("o_orderkey", "severity"), "severity", "o_orderkey")


@query
def undersample_per_class(spark, sf):
    return balance.undersample(labelled(spark, sf).select("doc_id", "quality"), "quality", "doc_id", per_class=True)


@query
def knn_exact(spark, sf):
    rows = table(spark, sf, "embeddings")
    # The partitioned plan is asked for here, so that the checked plan is the one
    # that runs at scale.
    near = knn.nearest_neighbors(rows, "vec_id", ["embedding"], 5, rows=False, broadcast_spots=0, block_rows=256)
    return _round(knn.neighbor_rows(near, "vec_id"), 5)


@query
def knn_numeric(spark, sf):
    """Neighbours on three numbers, where most pairs of blocks are ruled out."""
    near = knn.nearest_neighbors(labelled(spark, sf), "doc_id", FEATURES, 5, rows=False, broadcast_spots=0, block_rows=32)
    return _round(knn.neighbor_rows(near, "doc_id"))


@query
def knn_same_class(spark, sf):
    near = knn.nearest_neighbors(labelled(spark, sf), "doc_id", FEATURES, 5, "quality", within_label=True, rows=False)
    return _round(knn.neighbor_rows(near, "doc_id"))


@query
def tomek_links(spark, sf):
    return balance.tomek_links(labelled(spark, sf), "doc_id", FEATURES, "quality")


@query
def remove_tomek(spark, sf):
    return balance.remove_tomek(labelled(spark, sf), "doc_id", FEATURES, "quality").select("doc_id", "quality")


@query
def enn(spark, sf):
    return balance.edited_neighbors(labelled(spark, sf), "doc_id", FEATURES, "quality").select("doc_id", "quality")


@query
def smote(spark, sf):
    return _round(balance.smote(labelled(spark, sf), "doc_id", FEATURES, "quality"), 4)


@query
def borderline_smote(spark, sf):
    return _round(balance.borderline_smote(labelled(spark, sf), "doc_id", FEATURES, "quality"), 4)


@query
def adasyn(spark, sf):
    return _round(balance.adasyn(labelled(spark, sf), "doc_id", FEATURES, "quality"), 4)


@query
def smote_nc(spark, sf):
    return _round(balance.smote_nc(labelled(spark, sf), "doc_id", FEATURES, ["lang", "source"], "quality"), 4)


@query
def smote_enn(spark, sf):
    return _round(balance.smote_enn(labelled(spark, sf), "doc_id", FEATURES, "quality"), 4)


def _three_results(spark, sf):
    rows = labelled(spark, sf)
    return rows, {
        "random_undersampling": balance.undersample(rows, "quality", "doc_id"),
        "tomek": balance.remove_tomek(rows, "doc_id", FEATURES, "quality"),
        "smote": balance.smote(rows, "doc_id", FEATURES, "quality"),
    }


@query
def compare_techniques(spark, sf):
    rows, results = _three_results(spark, sf)
    return balance.compare_techniques(rows, results, "quality")


@query
def class_distribution(spark, sf):
    rows, results = _three_results(spark, sf)
    return balance.class_distribution(rows, results, "quality")


# --- leakage, splits, encoders, metrics --------------------------------------------


@query
def term_entropy(spark, sf):
    return _round(leakage.term_entropy(labelled(spark, sf), "source", "quality"))


@query
def dominant_label(spark, sf):
    return _round(leakage.dominant_label(labelled(spark, sf), "source", "quality"))


@query
def mask_proxy_terms(spark, sf):
    rows = labelled(spark, sf)
    leaking = leakage.leaking_terms(rows, "source", "quality", cutoff=0.6)
    masked = leakage.mask_terms(rows, leaking, "source", "masked")
    return masked.groupBy("masked", "quality").agg(F.count(F.lit(1)).alias("n"))


@query
def safe_terms(spark, sf):
    rows = labelled(spark, sf)
    seen = leakage.term_entropy(rows, "source", "quality")
    return leakage.safe_terms(seen, leakage.leaking_terms(rows, "source", "quality", cutoff=0.6), "source")


@query
def mutual_information(spark, sf):
    rows = labelled(spark, sf)
    return _round(leakage.mutual_information(rows, "quality", ["source", "lang"], ["n_chars", "n_spaces"], bins=8))


@query
def neighbor_information(spark, sf):
    """Mutual information of continuous features by nearest neighbours."""
    return _round(leakage.neighbor_information(labelled(spark, sf), "quality", FEATURES, bucket=64))


@query
def leakage_report(spark, sf):
    rows = labelled(spark, sf)
    leaking = leakage.leaking_terms(rows, "source", "quality", cutoff=0.6)
    masked = leakage.mask_terms(rows, leaking, "source", "masked")
    before = leakage.mutual_information(masked.select("quality", F.col("source").alias("term")), "quality", ["term"])
    after = leakage.mutual_information(masked.select("quality", F.col("masked").alias("term")), "quality", ["term"])
    return _round(leakage.leakage_report(before, after))


@query
def stratified_split(spark, sf):
    rows = inputs.scored(spark, sf).select("o_orderkey", "severity")
    return split.stratified_holdout(rows, "severity", "o_orderkey")


@query
def kfold(spark, sf):
    rows = inputs.scored(spark, sf).select("o_orderkey", "severity")
    return split.stratified_folds(rows, "severity", "o_orderkey")


@query
def ordinal_encode(spark, sf):
    rows = inputs.reports(spark, sf)
    book = encode.fit_ordinal(rows.filter(F.col("p_type") != "SMALL"), "drugname")
    coded = encode.encode(rows.select("drugname", "p_type"), book, "drugname", "code")
    return coded.groupBy("drugname", "code").agg(F.count(F.lit(1)).alias("n"))


_CLASSES = [1, 2, 3, 4, 5]


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(inputs.scored(spark, sf), "severity", "predicted", _CLASSES)


@query
def class_report(spark, sf):
    return _round(metrics.classification_report(inputs.scored(spark, sf), "severity", "predicted", _CLASSES))


@query
def roc_auc(spark, sf):
    return _round(metrics.roc_auc(metrics.one_vs_rest(inputs.scored(spark, sf), "severity", "scores", _CLASSES)))


@query
def mean_roc_curve(spark, sf):
    long = metrics.one_vs_rest(inputs.scored(spark, sf), "severity", "scores", _CLASSES)
    return _round(metrics.mean_roc_curve(long))


# --- models ----------------------------------------------------------------------


@query
def boosted_nodes(spark, sf):
    """The trees of the first round: splits and values as a table."""
    from ..operators import boost

    how = boost.Boosting(rounds=1, depth=2, bins=16)
    nodes = boost.fit_boosted(labelled(spark, sf), FEATURES, "quality", [0, 1], how).nodes
    return nodes.select("class_no", "node", "feature", "threshold", F.round("value", 6).alias("value"))


@query
def boosted_alerts(spark, sf):
    """Orders whose severity a model table predicts at 4 or more."""
    from ..operators import boost

    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    severity = (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("severity")
    rows = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_totalprice", "c_acctbal", severity)
    how = boost.Boosting(rounds=1, depth=2, bins=16)
    model = boost.fit_boosted(rows, ["o_totalprice", "c_acctbal"], "severity", _CLASSES, how)
    scored = model.predict(rows).filter(F.col("prediction") >= 4)
    return scored.select("o_orderkey", "severity", "prediction", F.round("confidence", 6).alias("confidence"))


@query
def model_scores(spark, sf):
    from . import training

    parts = split.stratified_holdout(labelled(spark, sf), "quality", "doc_id")
    model = training.fit_balanced(
        training.classifiers()["random_forest"], parts.filter(~F.col("is_test")), "doc_id", FEATURES, "quality"
    )
    out = model.predict(parts.filter("is_test"))
    return out.select("doc_id", "quality", "prediction", F.round("confidence", 4).alias("confidence"))


@query
def model_compare(spark, sf):
    from . import training

    return training.compare(training.classifiers(), labelled(spark, sf), "doc_id", FEATURES, "quality").table


def _severity_rows(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    people = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("primaryid"),
        F.floor(F.col("c_acctbal") / 50).cast("string").alias("age"),
        F.substring("c_mktsegment", 1, 1).alias("sex"),
        (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("severity_level"),
    )
    pairs = inputs.reports(spark, sf).select("primaryid", "drugname", "pt")
    return people.join(pairs, "primaryid")


def _severity_model(spark, sf):
    from . import training

    rows = stage(_severity_rows(spark, sf))
    split_at = split.stratified_holdout(rows.select("primaryid", "severity_level").distinct(), "severity_level", "primaryid")
    train = rows.join(split_at.filter(~F.col("is_test")).select("primaryid"), "primaryid", "left_semi")
    encoder = training.CaseEncoder.fit(train, "severity_level")
    coded = stage(encoder.transform(train).select(*training.CASE_FEATURES, "severity_level"))
    # A small forest: the full one takes minutes on these rows (README).
    model = training.fit(training.classifiers(trees=10, depth=6)["random_forest"], coded, training.CASE_FEATURES, "severity_level")
    return rows, encoder, model


@query
def risk_alerts(spark, sf):
    from . import training

    rows, encoder, model = _severity_model(spark, sf)
    return training.risk_alerts(rows, encoder, model).drop("timestamp")


@query
def case_scores(spark, sf):
    """Every case row with its predicted severity and the history of its pair."""
    from . import training

    rows, encoder, model = _severity_model(spark, sf)
    found = signals.safety_signals(rows)
    scored = training.score_cases(rows, encoder, model, found)
    return scored.groupBy("prediction", "known_signal").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("prr"), 6).alias("max_prr")
    )


# --- streams ---------------------------------------------------------------------


def _event_stream(spark, sf):
    # A glob, because the stream source takes folders and not a single file.
    stream = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    return inputs.event_cases(stream)


def _event_signals(spark, sf):
    cases = inputs.event_cases(table(spark, sf, "events"))
    pairs = assemble.case_pairs(cases)
    return signals.score_pairs(signals.contingency(pairs, "drugname", "pt"), "drugname", "pt")


def _folder(spark):
    return f"{staging_dir(spark)}/caselume/{uuid.uuid4().hex}"


@query
def stream_batch_alerts(spark, sf):
    """Signal alerts with the micro-batch as the scope."""
    from ..streaming import alerts

    out = _folder(spark)
    known = stage(_event_signals(spark, sf))
    run = alerts.start_signal_alerts(_event_stream(spark, sf), known, f"{out}/alerts", f"{out}/state", prr=1.05, p_value=0.5)
    run.awaitTermination()
    schema = "drugname string, pt string, prr double, p_value double, n_cases_in_batch bigint, batch int"
    return _round(spark.read.schema(schema).json(f"{out}/alerts").drop("batch"))


@query
def stream_window_alerts(spark, sf):
    """Signal alerts per closed day of event time."""
    from ..streaming import alerts

    out = _folder(spark)
    known = stage(_event_signals(spark, sf))
    found = alerts.windowed_signal_alerts(_event_stream(spark, sf), known, "1 day", "10 minutes", prr=1.05, p_value=0.5)
    run = (
        found.writeStream.format("parquet")
        .option("path", f"{out}/alerts")
        .option("checkpointLocation", f"{out}/state")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    written = spark.read.schema(found.schema).parquet(f"{out}/alerts")
    return _round(written.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query
def stream_severity_alerts(spark, sf):
    """Severity alerts on a stream of events, from a model that was fitted on the table before."""
    from ..operators import boost
    from ..streaming import alerts

    def cases(events):
        kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
        number = F.get_json_object("props", "$.k").cast("double").alias("number")
        return events.select(F.col("event_id").alias("primaryid"), "value", number, F.array_position(kinds, F.col("event_type")).cast("int").alias("severity"))

    out, events = _folder(spark), table(spark, sf, "events")
    how = boost.Boosting(rounds=1, depth=2, bins=16)
    model = boost.fit_boosted(cases(events), ["value", "number"], "severity", _CLASSES, how)
    stream = cases(spark.readStream.schema(events.schema).parquet(f"{sf}/events*.parquet"))
    alerts.start_table_alerts(stream, model, f"{out}/alerts", f"{out}/state").awaitTermination()
    schema = "primaryid bigint, predicted_severity int, severity_label string, confidence_score double, batch int"
    return spark.read.schema(schema).json(f"{out}/alerts").drop("batch")


@query
def stream_alert_counts(spark, sf):
    """Running counters kept in streaming state."""
    from ..streaming import alerts

    out = _folder(spark)
    cases = _event_stream(spark, sf).select(
        F.get("drugs", F.lit(0)).alias("level"), (F.col("value") >= 10).alias("is_alert")
    )
    counts = alerts.running_counters(cases, "is_alert", "level")
    run = alerts.write_per_batch(counts, f"{out}/counts", f"{out}/state", mode="complete")
    run.trigger(availableNow=True).start().awaitTermination()
    every = spark.read.schema("level string, consumed bigint, alerts bigint, batch int").json(f"{out}/counts")
    last = every.agg(F.max("batch").alias("b")).scalar()
    return every.filter(F.col("batch") == last).drop("batch")


@query
def stream_level_totals(spark, sf):
    """Running alert totals by level, over the alerts of the event stream."""
    from ..streaming import alerts

    out = _folder(spark)
    found = _event_stream(spark, sf).filter(F.col("value") >= 10).select(F.get("drugs", F.lit(0)).alias("level"))
    alerts.start_level_counts(found, f"{out}/totals", f"{out}/state", level="level").awaitTermination()
    every = spark.read.schema("level string, alerts bigint, batch int").json(f"{out}/totals")
    last = every.agg(F.max("batch").alias("b")).scalar()
    return every.filter(F.col("batch") == last).drop("batch")


# --- sources: a given table written, and read back ---------------------------------------


def _customer_text(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("primaryid"), "c_name", F.col("c_mktsegment").alias("sex"), F.col("c_nationkey").cast("string").alias("age")
    )


@query
def delimited_roundtrip(spark, sf):
    """Two extracts with another order of columns, read as one table by their own headers."""
    from ..sources import files

    out, rows = _folder(spark), _customer_text(spark, sf)
    old = F.col("primaryid").cast("bigint") % 2 == 0
    files.write_delimited(rows.filter(old).select("primaryid", "sex", "age"), f"{out}/DEMO1")
    files.write_delimited(rows.filter(~old).select("primaryid", "age", "sex", "c_name"), f"{out}/DEMO2")
    return files.read_delimited(spark, f"{out}/DEMO*")


@query
def tolerant_read(spark, sf):
    """Lines with too many fields are left out, and counted beside the rows that stay."""
    from ..sources import files

    out, rows = _folder(spark), _customer_text(spark, sf)
    torn = F.when(F.col("primaryid").cast("bigint") % 10 == 3, F.concat("sex", F.lit("$"), "age")).otherwise(F.col("sex"))
    files.write_delimited(rows.select("primaryid", torn.alias("sex")), f"{out}/DEMO")
    good = files.read_delimited(spark, f"{out}/DEMO", tolerant=True)
    bad = files.bad_lines(spark, f"{out}/DEMO")
    return good.groupBy("sex").agg(F.count(F.lit(1)).alias("n")).union(bad.agg(F.lit("bad lines"), F.count(F.lit(1))))


@query
def json_lines_roundtrip(spark, sf):
    """JSON lines with a torn line for every tenth row; what does not parse is dropped."""
    from ..sources import files

    out, rows = _folder(spark), _customer_text(spark, sf)
    whole = F.to_json(F.struct("primaryid", "sex"))
    line = F.when(F.col("primaryid").cast("bigint") % 10 == 3, F.substring(whole, 1, 9)).otherwise(whole)
    rows.select(line.alias("value")).write.text(f"{out}/cases")
    return files.read_json_lines(spark, f"{out}/cases", "primaryid string, sex string")


@query
def csv_signal_lookup(spark, sf):
    """Signals written as CSV, read back, and attached to the pairs of the reports."""
    from ..sources import files

    out = _folder(spark)
    rows = inputs.reports(spark, sf).select("primaryid", F.col("p_brand").alias("drugname"), "pt")
    scored = signals.score_pairs(signals.contingency(rows, "drugname", "pt"), "drugname", "pt")
    files.write_csv(signals.keep_signals(scored, min_prr=1.2).select("drugname", "pt", "count_a", "prr"), f"{out}/signals")
    cases = signals.attach_signals(rows, files.read_signals(spark, f"{out}/signals"), "drugname", "pt")
    return cases.groupBy("known_signal").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("count_a", F.lit(0.0))).alias("counts"))


# --- codes -----------------------------------------------------------------------------


@query
def code_labels(spark, sf):
    """Labels of role and outcome codes, and the worst severity of each case."""
    o = table(spark, sf, "orders")
    code = F.get(F.split(F.lit("DE LT HO DS CA RI OT ZZ"), " "), (F.col("o_orderkey") % 8).cast("int"))
    role = F.get(F.split(F.lit("PS SS C I ??"), " "), (F.col("o_orderkey") % 5).cast("int"))
    rows = o.select(F.col("o_custkey").alias("primaryid"), code.alias("outc_cod"), role.alias("role_cod"))
    rated = clean.with_severity(rows, worst_of="primaryid")
    return rated.groupBy(
        clean.role_label("role_cod").alias("role"), clean.outcome_label("outc_cod").alias("outcome"), F.col("severity_level").cast("int").alias("worst")
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def case_items(spark, sf):
    """The drugs of all cases as a child table, in order."""
    rows = inputs.reports(spark, sf).select("primaryid", F.col("p_brand").alias("o"), F.col("drugname"))
    return assemble.case_items(rows, "primaryid", "o", "drugname")
