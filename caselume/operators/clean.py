"""Cleaning rules and the whole-table cleaning recipes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.scale import exact_quantiles
from ..functions.text import (
    from_table,
    is_blank,
    strip,
    to_number,
    upper_strip,
    valid_code,
    within,
)

# --- single rules ----------------------------------------------------------------


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows where a named column is null or blank."""
    for c in cols:
        df = df.filter(~is_blank(c))
    return df


def long_enough(df: DataFrame, col: str, least: int = rules.MIN_TERM_LENGTH, keep_null: bool = True):
    """Drop short texts; nulls stay only when asked."""
    ok = F.length(col) >= least
    return df.filter(ok | F.col(col).isNull() if keep_null else ok)


def positive_integer(df: DataFrame, col: str) -> DataFrame:
    n = to_number(col)
    return df.withColumn(col, n).filter(F.col(col) > 0)


def impute_median(df: DataFrame, cols: list[str], fallback: float = 0.0) -> DataFrame:
    """Null becomes the exact column median; an all-null column gets the fallback."""
    # One number per column comes back; the column itself stays distributed.
    found = {r["column"]: r["q"][0] for r in exact_quantiles(df, cols, [0.5]).collect()}
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(found.get(c, fallback)))) for c in cols}
    )


def impute_value(df: DataFrame, col: str, value: float) -> DataFrame:
    return df.withColumn(col, F.coalesce(to_number(col), F.lit(float(value))))


def synonym_table(spark: SparkSession, synonyms: dict[str, str] | None = None) -> DataFrame:
    """The synonym list as a DataFrame (a fixed list of fewer than 100 rows)."""
    pairs = (synonyms or rules.SYNONYMS).items()
    flat = [F.lit(x) for pair in pairs for x in pair]
    return spark.range(1).select(F.explode(F.create_map(*flat)).alias("_term", "_canon"))


def map_synonyms(df: DataFrame, col: str, synonyms: dict[str, str] | None = None) -> DataFrame:
    """Upper-cased term to its canonical term; unknown terms pass through."""
    table = F.broadcast(synonym_table(df.sparkSession, synonyms))
    cols = df.columns
    joined = df.join(table, F.col(col) == F.col("_term"), "left")
    return joined.withColumn(col, F.coalesce("_canon", col)).select(*cols)


def null_shares(df: DataFrame, blank_is_null: bool = False) -> dict[str, float]:
    """Null share of every column, from one pass over the table."""
    def missing(c):
        return is_blank(c) if blank_is_null else F.col(c).isNull()

    row = df.agg(
        *[F.avg(F.when(missing(c), 1.0).otherwise(0.0)).alias(c) for c in df.columns]
    ).first()
    return {c: (row[c] if row[c] is not None else 0.0) for c in df.columns}


def drop_sparse_columns(
    df: DataFrame, share: float, blank_is_null: bool = False, filled: tuple[str, ...] = ()
) -> DataFrame:
    """Drop columns whose null share is above the limit. Runs one aggregate job.

    Columns named in ``filled`` are known to hold no nulls and are not looked at.
    """
    open_cols = [c for c in df.columns if c not in filled]
    if not open_cols:
        return df
    shares = null_shares(df.select(*open_cols), blank_is_null)
    return df.drop(*[c for c, s in shares.items() if s > share])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold nulls only."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if row["_rows"] > 0 and row[c] == 0])


def suffix_columns(df: DataFrame, key: str, suffix: str) -> DataFrame:
    return df.select(*[F.col(c) if c == key else F.col(c).alias(f"{c}_{suffix}") for c in df.columns])


def suffix_collisions(taken: list[str], df: DataFrame, key: str, suffix: str) -> DataFrame:
    """Rename only the columns whose name is already taken."""
    seen = set(taken)
    return df.select(
        *[F.col(c).alias(f"{c}_{suffix}") if c in seen and c != key else F.col(c) for c in df.columns]
    )


def key_named(df: DataFrame, key: str = rules.KEY) -> DataFrame:
    """Give the key column its lower-case name, whatever case it came in."""
    for c in df.columns:
        if c != key and c.lower() == key:
            return df.withColumnRenamed(c, key)
    return df


def severity_of(code: Column | str) -> Column:
    """Outcome code to severity 1..5; anything unknown is 1."""
    return from_table(upper_strip(code), rules.SEVERITY_OF_OUTCOME, rules.SEVERITY_DEFAULT)


def with_severity(
    df: DataFrame, outcome: str | None = "outc_cod", name: str = "severity_level", worst_of: str | None = None
) -> DataFrame:
    """Severity from the first column whose name contains ``outcome``; none gives 1.

    With ``worst_of``, a key column, all rows of a key get the greatest severity among them.
    """
    match = [c for c in df.columns if outcome and outcome in c]
    rated = df.withColumn(name, severity_of(match[0]) if match else F.lit(rules.SEVERITY_DEFAULT))
    if worst_of is None:
        return rated
    worst = rated.groupBy(worst_of).agg(F.max(name).alias(name)).withColumnRenamed(worst_of, "_worst_key")
    return rated.drop(name).join(worst, F.col(worst_of).eqNullSafe(F.col("_worst_key"))).drop("_worst_key")


def severity_label(level: Column | str) -> Column:
    return from_table(level, rules.SEVERITY_LABELS)


def recommendation_band(level: Column | str) -> Column:
    """Urgent for level 5, close watch for 3 and 4, routine below."""
    c = F.col(level) if isinstance(level, str) else level
    return F.when(c >= 5, "urgent").when(c >= 3, "watch").otherwise("routine")


def sex_value(sex: Column | str) -> Column:
    return from_table(upper_strip(sex), rules.SEX_VALUES, rules.SEX_VALUE_DEFAULT)


def role_label(code: Column | str) -> Column:
    return from_table(code, rules.ROLE_LABELS, rules.UNKNOWN_LABEL)


def outcome_label(code: Column | str) -> Column:
    return from_table(code, rules.OUTCOME_LABELS, rules.UNKNOWN_LABEL)


def shift_labels(df: DataFrame, label: str, name: str = "label") -> DataFrame:
    """Labels counted from 0, with the shift kept as a column to undo it."""
    least = df.agg(F.min(label).alias("m")).scalar()
    return df.withColumn("label_shift", least).withColumn(
        name, (F.col(label) - F.col("label_shift")).cast("double")
    )


def unshift_labels(df: DataFrame, name: str, out: str) -> DataFrame:
    return df.withColumn(out, (F.col(name) + F.col("label_shift")).cast("int"))


def split_by_type(df: DataFrame, exclude: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the text columns, read from the schema."""
    number = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name not in exclude]
    numeric = [n for n, t in kinds if t in number or t.startswith("decimal")]
    return numeric, [n for n, t in kinds if t == "string"]


# --- recipes ---------------------------------------------------------------------


@dataclass
class Cleaned:
    """A cleaned table and the measures to audit it with.

    ``audit()`` counts everything in one pass over the input and one over the
    output, instead of one count per rule.
    """

    table: str
    raw: DataFrame
    clean: DataFrame
    measures: dict[str, Column] = field(default_factory=dict)
    dropped_columns: tuple[str, ...] = ()

    def audit(self) -> DataFrame:
        names = ["rows_in", *self.measures]
        sums = [F.count(F.lit(1)).alias("rows_in")] + [
            F.coalesce(F.sum(F.when(m, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(n)
            for n, m in self.measures.items()
        ]
        rows_out = self.clean.agg(F.count(F.lit(1)).alias("rows_out")).scalar()
        wide = self.raw.agg(*sums).withColumn("rows_out", rows_out)
        cells = F.array(
            *[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in [*names, "rows_out"]]
        )
        return wide.select(F.lit(self.table).alias("table"), F.explode(cells).alias("c")).select(
            "table", "c.measure", "c.value"
        )


def _finish(table: str, raw: DataFrame, df: DataFrame, measures: dict, share=None, blank=False, filled=()):
    """Sparse columns out, then exact duplicates out."""
    before = df.columns
    if share is not None:
        df = drop_sparse_columns(df, share, blank, filled)
    gone = tuple(c for c in before if c not in df.columns)
    return Cleaned(table, raw, df.dropDuplicates(), measures, gone)


def clean_demo(df: DataFrame, key: str = rules.KEY) -> Cleaned:
    out = require(df, key)
    measures = {"blank_key": is_blank(key)}
    if "sex" in df.columns:
        out = out.withColumn("sex", valid_code("sex", rules.SEX_CODES, rules.SEX_DEFAULT))
        measures["sex_defaulted"] = valid_code("sex", rules.SEX_CODES, rules.SEX_DEFAULT) == rules.SEX_DEFAULT
    if "age" in df.columns:
        in_range = within(to_number("age"), *rules.AGE_RANGE)
        out = impute_median(out.withColumn("age", in_range), ["age"], rules.AGE_FALLBACK)
        measures["age_imputed"] = in_range.isNull()
    if "reporter_country" in df.columns:
        out = out.withColumn("reporter_country", upper_strip("reporter_country"))
        measures["country_not_two_letters"] = (
            F.length(upper_strip("reporter_country")) != rules.COUNTRY_CODE_LENGTH
        )
    return _finish("demo", df, out, measures, rules.SPARSE_SHARE["demo"], True, (key, "sex", "age"))


def clean_drug(df: DataFrame, key: str = rules.KEY, drug: str = "drugname") -> Cleaned:
    out = require(df, key, drug).withColumn(drug, upper_strip(drug))
    measures = {"blank_key": is_blank(key), "blank_drug": ~is_blank(key) & is_blank(drug)}
    if "role_cod" in df.columns:
        role = valid_code("role_cod", rules.ROLE_CODES, rules.ROLE_DEFAULT, trim=False)
        out = out.withColumn("role_cod", role)
        measures["role_defaulted"] = role == rules.ROLE_DEFAULT
    if "route" in df.columns:
        route = upper_strip(F.coalesce("route", F.lit(rules.ROUTE_DEFAULT)))
        out = out.withColumn("route", route)
        measures["route_unknown"] = route == rules.ROUTE_DEFAULT
    if "dose_amt" in df.columns:
        dose = to_number("dose_amt")
        out = out.withColumn("dose_amt", within(dose, *rules.DOSE_RANGE))
        out = impute_median(out, ["dose_amt"], rules.DOSE_FALLBACK)
        measures["dose_out_of_range"] = dose.isNotNull() & within(dose, *rules.DOSE_RANGE).isNull()
    for c in ("dechal", "rechal"):
        if c in df.columns:
            code = valid_code(c, rules.CHALLENGE_CODES, rules.CHALLENGE_DEFAULT, trim=False)
            out = out.withColumn(c, code)
            measures[f"{c}_defaulted"] = code == rules.CHALLENGE_DEFAULT
    filled = (key, drug, "role_cod", "route", "dose_amt", "dechal", "rechal")
    return _finish("drug", df, out, measures, rules.SPARSE_SHARE["drug"], filled=filled)


def clean_reac(df: DataFrame, key: str = rules.KEY, term: str = "pt") -> Cleaned:
    out = require(df, key)
    measures = {"blank_key": is_blank(key)}
    if term in df.columns:
        out = long_enough(map_synonyms(out.withColumn(term, upper_strip(term)), term), term)
        measures["short_term"] = F.length(upper_strip(term)) < rules.MIN_TERM_LENGTH
    if "drug_rec_act" in df.columns:
        out = out.withColumn("drug_rec_act", F.coalesce("drug_rec_act", F.lit(rules.ACTION_DEFAULT)))
        measures["action_defaulted"] = F.col("drug_rec_act").isNull()
    return _finish("reac", df, out, measures)


def clean_indi(df: DataFrame, key: str = rules.KEY, term: str = "indi_pt") -> Cleaned:
    out = require(df, key)
    measures = {"blank_key": is_blank(key)}
    if term in df.columns:
        filled = upper_strip(F.coalesce(term, F.lit(rules.INDICATION_DEFAULT)))
        out = long_enough(out.withColumn(term, filled), term, keep_null=False)
        measures["indication_missing"] = F.col(term).isNull()
        measures["short_term"] = F.length(filled) < rules.MIN_TERM_LENGTH
    return _finish("indi", df, out, measures, rules.SPARSE_SHARE["indi"], filled=(key, term))


def clean_outc(df: DataFrame, key: str = rules.KEY, code: str = "outc_cod") -> Cleaned:
    out = require(df, key)
    measures = {"blank_key": is_blank(key)}
    if code in df.columns:
        valid = valid_code(code, rules.OUTCOME_CODES, rules.OUTCOME_DEFAULT, upper=True)
        out = out.withColumn(code, valid)
        measures["outcome_defaulted"] = F.coalesce(~upper_strip(code).isin(*rules.OUTCOME_CODES), F.lit(True))
    return _finish("outc", df, out, measures)


def clean_ther(df: DataFrame, key: str = rules.KEY, sequence: str = "drug_seq") -> Cleaned:
    out = require(df, key)
    measures = {"blank_key": is_blank(key)}
    if sequence in df.columns:
        out = positive_integer(out, sequence)
        measures["bad_sequence"] = F.coalesce(to_number(sequence) <= 0, F.lit(True))
    # Duplicates don't change which columns are empty, so that is asked before their shuffle.
    kept = drop_empty_columns(out)
    done = _finish("ther", df, kept, measures)
    done.dropped_columns = tuple(c for c in out.columns if c not in kept.columns)
    return done


def clean_rpsr(df: DataFrame, key: str = rules.KEY, code: str = "rpsr_cod") -> Cleaned:
    out = require(df, key)
    measures = {"blank_key": is_blank(key)}
    if code in df.columns:
        out = out.withColumn(code, upper_strip(F.coalesce(code, F.lit(rules.REPORT_DEFAULT))))
        measures["report_missing"] = F.col(code).isNull()
    return _finish("rpsr", df, out, measures, rules.SPARSE_SHARE["rpsr"], filled=(key, code))


RECIPES = {
    "demo": clean_demo,
    "drug": clean_drug,
    "reac": clean_reac,
    "outc": clean_outc,
    "indi": clean_indi,
    "ther": clean_ther,
    "rpsr": clean_rpsr,
}
