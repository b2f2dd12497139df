"""Whole jobs over folders: profile, clean, consolidate, signals, balance, train, score.

Each job reads files, writes files and can be run alone, like the stages of a
``spark-submit`` workflow. Folders may be on any file system Spark can reach.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import clean_key
from ..operators import assemble, balance, clean, encode, leakage, metrics, profile, quality, signals
from ..sources import files
from . import training


def raw_path(folder: str, table: str) -> str:
    return f"{folder}/{table.upper()}*.txt"


def read_raw(
    spark: SparkSession, folder: str, tables: tuple[str, ...] = rules.TABLES, tolerant: bool = False
) -> dict[str, DataFrame]:
    """The delimited tables of a folder, found by name (``DEMO*.txt`` and so on)."""
    return {t: files.read_delimited(spark, raw_path(folder, t), tolerant=tolerant) for t in tables}


def read_clean(spark: SparkSession, folder: str, tables: tuple[str, ...] = rules.TABLES) -> dict[str, DataFrame]:
    """Cleaned tables with the key as a whole number; rows without one are left out."""
    out = {}
    for t in tables:
        df = clean.key_named(files.read_parquet(spark, f"{folder}/{t}"))
        out[t] = df.withColumn(rules.KEY, clean_key(rules.KEY)).filter(F.col(rules.KEY).isNotNull())
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def profile_job(spark: SparkSession, raw: str, out: str, tables: tuple[str, ...] = rules.TABLES) -> None:
    """Table, column and duplicate profiles and the per-column action plan, as CSV."""
    loaded = {t: clean.key_named(df) for t, df in read_raw(spark, raw, tables).items()}
    columns = _union([profile.column_profile(df, rules.KEY, t.upper()) for t, df in loaded.items()])
    files.write_csv(quality.column_actions(columns), f"{out}/columns")
    files.write_csv(_union([profile.table_profile(df, rules.KEY, t.upper()) for t, df in loaded.items()]), f"{out}/tables")
    files.write_csv(_union([profile.duplicate_stats(df, rules.KEY, t.upper()) for t, df in loaded.items()]), f"{out}/duplicates")


def clean_job(
    spark: SparkSession, raw: str, out: str, tables: tuple[str, ...] = rules.TABLES, tolerant: bool = False
) -> None:
    """Apply the recipe of every table; write Parquet, and the audit as JSON.

    A line with too many fields ends the job, or with ``tolerant`` is left out and counted in the audit.
    """
    audits = []
    for t in tables:
        lost: list = []
        df = files.read_delimited(spark, raw_path(raw, t), tolerant=tolerant, lost=lost)
        done = clean.RECIPES[t](clean.key_named(df))
        files.write_parquet(done.clean, f"{out}/{t}")
        written = files.read_parquet(spark, f"{out}/{t}")
        audits.append(clean.Cleaned(t, done.raw, written, done.measures).audit())
        if tolerant:
            counted = sum(seen.get["n"] for seen in lost)
            audits.append(spark.range(1).select(F.lit(t).alias("table"), F.lit("bad_lines").alias("measure"), F.lit(counted).cast("bigint").alias("value")))
    files.write_json(_union(audits), f"{out}/_audit")


def consolidate_job(
    spark: SparkSession, cleaned: str, out: str, tables: tuple[str, ...] = rules.TABLES, sample: int | None = None
) -> None:
    """The multiway join with severity and codes, for all shared keys or a sample of them.

    ``assemble.explosion_size`` tells the size beforehand; where only pair counts are
    wanted, ``signal_job`` gets them without the join.
    """
    loaded = read_clean(spark, cleaned, tables)
    if sample is not None:
        keys = assemble.sample_keys(assemble.common_keys(loaded), sample)
        loaded = {t: assemble.restrict(df, keys) for t, df in loaded.items()}
    joined = assemble.consolidate(loaded)
    for name, col in (("drug_encoded", "drugname"), ("pt_encoded", "pt")):
        if col in joined.columns:
            source = loaded["drug"] if col == "drugname" else loaded["reac"]
            joined = encode.encode(joined, encode.fit_ordinal(source, col), col, name)
    files.write_parquet(joined, out)


def signal_job(
    spark: SparkSession, cleaned: str, out: str, unit: str = "rows", tables: tuple[str, ...] = rules.TABLES, **limits
) -> None:
    """Signals of the cleaned tables, written as CSV.

    ``unit="rows"`` counts the rows the multiway join would have (without joining);
    ``unit="cases"`` counts every case once per pair.
    """
    t = read_clean(spark, cleaned, tables)
    named = {
        "drug": t["drug"].select(rules.KEY, F.coalesce("drugname", F.lit(rules.TERM_DEFAULT)).alias("drugname")),
        "reac": t["reac"].select(rules.KEY, F.coalesce("pt", F.lit(rules.TERM_DEFAULT)).alias("pt")),
    }
    if unit == "rows":
        others = [df for n, df in t.items() if n not in named]
        counts = assemble.joined_pair_counts(named["drug"], named["reac"], others, "drugname", "pt")
        table = signals.contingency(counts, "drugname", "pt", weight="count_a")
    else:
        table = signals.case_contingency(named["drug"], named["reac"], "drugname", "pt", rules.KEY)
    found = signals.keep_signals(signals.score_pairs(table, "drugname", "pt"), **limits)
    files.write_csv(found.orderBy(F.desc("chi2"), "drugname", "pt"), out)


def balance_job(spark: SparkSession, source: str, out: str, technique: str, ident: str, features: list[str], label: str, **options):
    """One balancing technique by its name."""
    df = files.read_parquet(spark, source)
    run = {
        "random_undersampling": lambda: balance.undersample(df, label, ident, **options),
        "tomek": lambda: balance.remove_tomek(df, ident, features, label, **options),
        "smote": lambda: balance.smote(df, ident, features, label, **options),
        "adasyn": lambda: balance.adasyn(df, ident, features, label, **options),
        "borderline_smote": lambda: balance.borderline_smote(df, ident, features, label, **options),
        "smote_nc": lambda: balance.smote_nc(
            df, ident, features, options.pop("nominal"), label, **options
        ),
        "smoteenn": lambda: balance.smote_enn(df, ident, features, label, **options),
    }
    files.write_parquet(run[technique](), out)


def feature_information(coded: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Mutual information of all four features before and after masking of terms; age and sex count as continuous."""
    def audit(term: str) -> DataFrame:
        rows = coded.select(label, "age", "sex_encoded", "drug_encoded", F.col(term).alias("pt_encoded"))
        return leakage.mutual_information(rows, label, ["drug_encoded", "pt_encoded"], ["age", "sex_encoded"])

    return audit("pt"), audit("pt_masked")


def evaluate_job(spark: SparkSession, scored: DataFrame, out: str, label: str = "severity_level") -> None:
    """Report by class, confusion matrix, areas and mean curve of predicted rows (``prediction``, ``scores``), as JSON."""
    classes = list(balance.class_sizes(scored, label))
    rows = training.stage(scored.select(label, "prediction", "scores"))
    files.write_json(metrics.classification_report(rows, label, "prediction", classes), f"{out}/report")
    files.write_json(metrics.confusion_matrix(rows, label, "prediction", classes), f"{out}/confusion")
    long = training.stage(metrics.one_vs_rest(rows, label, "scores", classes))
    files.write_json(metrics.roc_auc(long), f"{out}/auc")
    files.write_json(metrics.mean_roc_curve(long), f"{out}/roc")


def sample_job(spark: SparkSession, raw: str, out: str, cases: int, tables: tuple[str, ...] = rules.TABLES) -> None:
    """All rows of ``cases`` cases that every table has, as delimited files with the tables' names."""
    loaded = {t: clean.key_named(df) for t, df in read_raw(spark, raw, tables).items()}
    keys = training.stage(assemble.sample_keys(assemble.common_keys(loaded), cases))
    for t, df in loaded.items():
        files.write_delimited(assemble.restrict(df, keys), f"{out}/{t.upper()}.txt")


def balance_report_job(
    spark: SparkSession, source: str, out: str, techniques: dict[str, str], label: str
) -> None:
    """Compares balanced tables (technique: folder) with their source: sizes, ratios and classes, as CSV."""
    original = files.read_parquet(spark, source)
    results = {name: files.read_parquet(spark, folder) for name, folder in techniques.items()}
    files.write_csv(balance.compare_techniques(original, results, label), f"{out}/comparison")
    files.write_csv(balance.class_distribution(original, results, label), f"{out}/classes")


def train_job(
    spark: SparkSession, consolidated: str, out: str, estimators: dict | None = None, folds: int = 5, label: str = "severity_level"
) -> training.Comparison:
    """Features, leakage audit, comparison of the models; the best model is saved.

    The hold-out is drawn before anything is fitted, so the encoder sees training
    rows only.
    """
    rows = files.read_parquet(spark, consolidated).select(rules.KEY, "age", "sex", "drugname", "pt", label)
    # Consolidated rows repeat their case, so rows get an id of their own.
    rows = training.with_row_number(rows)
    parts = training.held_out(rows, "row_id", label)
    train = parts.filter(~F.col("is_test"))
    encoder = training.CaseEncoder.fit(train, label)
    coded = training.stage(encoder.transform(parts).select("row_id", "is_test", "pt", "pt_masked", *training.CASE_FEATURES, label))
    seen = coded.filter(~F.col("is_test"))
    files.write_json(leakage.leakage_report(*feature_information(seen, label)), f"{out}/leakage")
    files.write_json(leakage.masking_summary(seen, encoder.leaking, "pt"), f"{out}/masked")
    run = training.compare(
        estimators or training.classifiers(), coded, "row_id", training.CASE_FEATURES, label, folds, split_column="is_test"
    )
    files.write_json(run.table, f"{out}/comparison")
    evaluate_job(spark, run.best().predict(coded.filter("is_test")), f"{out}/evaluation", label)
    encoder.save(f"{out}/encoder")
    run.best().save(f"{out}/best", spark)
    return run


def score_job(spark: SparkSession, consolidated: str, model: str, out: str) -> None:
    """Alerts for all consolidated rows predicted severe, as JSON lines."""
    rows = files.read_parquet(spark, consolidated)
    encoder = training.CaseEncoder.load(spark, f"{model}/encoder")
    best = training.FittedModel.load(spark, f"{model}/best")
    files.write_json_lines(training.risk_alerts(rows, encoder, best), out)
