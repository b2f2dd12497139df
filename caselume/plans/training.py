"""Leakage-safe features, classifiers, cross-validation, scoring."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.scale import stage
from ..functions.text import to_number, upper_strip
from ..operators import balance, encode, leakage, metrics, split
from ..operators.boost import BoostedTrees, Boosting, fit_boosted
from ..operators.clean import severity_label, sex_value
from ..operators.signals import attach_signals

CASE_FEATURES = ["age", "sex_encoded", "drug_encoded", "pt_encoded"]
#: Visits (rows x trees x levels) of one task from which a forest's rows are dealt to more tasks.
FOREST_VISITS = 4_000_000
#: Folds that are grown and fitted at once, beside the fit on all training rows.
FOLDS_AT_ONCE = 3


@dataclass
class CaseEncoder:
    """Masked terms and the two dictionaries, learned from training rows only.

    Batch scoring and stream scoring call the same ``transform``.
    """

    drug_codes: DataFrame
    term_codes: DataFrame
    leaking: DataFrame
    drug: str = "drugname"
    term: str = "pt"

    @staticmethod
    def normalise(df: DataFrame, drug: str = "drugname", term: str = "pt") -> DataFrame:
        """Upper-case names, UNKNOWN for missing ones, age 45 for unusable ages."""
        return df.withColumns(
            {
                drug: upper_strip(F.coalesce(F.col(drug).cast("string"), F.lit(rules.TERM_DEFAULT))),
                term: upper_strip(F.coalesce(F.col(term).cast("string"), F.lit(rules.TERM_DEFAULT))),
                "sex": upper_strip(F.coalesce("sex", F.lit(rules.SEX_DEFAULT))),
                "age": F.coalesce(to_number("age"), F.lit(rules.AGE_FALLBACK)),
            }
        )

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        label: str,
        drug: str = "drugname",
        term: str = "pt",
        cutoff: float = rules.ENTROPY_CUTOFF,
    ) -> CaseEncoder:
        rows = cls.normalise(train, drug, term).select(drug, term, label)
        leaking = stage(leakage.leaking_terms(rows, term, label, cutoff))
        masked = leakage.mask_terms(rows, leaking, term, "_masked")
        return cls(encode.fit_ordinal(rows, drug), encode.fit_ordinal(masked, "_masked"), leaking, drug, term)

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.normalise(df, self.drug, self.term)
        out = leakage.mask_terms(out, self.leaking, self.term, "pt_masked")
        out = encode.encode(out, self.drug_codes, self.drug, "drug_encoded")
        out = encode.encode(out, self.term_codes, "pt_masked", "pt_encoded")
        return out.withColumn("sex_encoded", sex_value("sex"))

    def save(self, path: str) -> None:
        self.drug_codes.write.mode("overwrite").parquet(f"{path}/drug_codes")
        self.term_codes.write.mode("overwrite").parquet(f"{path}/term_codes")
        self.leaking.write.mode("overwrite").parquet(f"{path}/leaking_terms")

    @classmethod
    def load(cls, spark: SparkSession, path: str, drug: str = "drugname", term: str = "pt") -> CaseEncoder:
        read = spark.read.parquet
        return cls(read(f"{path}/drug_codes"), read(f"{path}/term_codes"), read(f"{path}/leaking_terms"), drug, term)


def classifiers(trees: int = 100, depth: int = 16, rounds: int = 10, seed: int = rules.SEED) -> dict:
    """The compared models. Deep trees keep the node of each row, so that no level walks down from the root again."""
    return {
        "logistic_regression": LogisticRegression(maxIter=1000, family="multinomial", labelCol="_y"),
        "random_forest": RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, labelCol="_y", weightCol="_weight", cacheNodeIds=depth > 10
        ),
        "boosted_trees": Boosting(rounds=rounds, depth=min(depth, 4)),
    }


@dataclass
class FittedModel:
    """A model with the feature order and the classes it was trained on."""

    model: Model | BoostedTrees
    features: list[str]
    classes: list

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (in original classes), ``scores`` and ``confidence``."""
        if isinstance(self.model, BoostedTrees):
            return self.model.predict(df)
        vectors = VectorAssembler(inputCols=self.features, outputCol="_features", handleInvalid="keep").transform(df)
        self.model.setPredictionCol("_predicted")
        self.model.setFeaturesCol("_features")
        out = self.model.transform(vectors)
        scores = vector_to_array("probability")
        named = F.get(F.array(*[F.lit(c) for c in self.classes]), F.col("_predicted").cast("int"))
        return out.select(*df.columns, named.alias("prediction"), scores.alias("scores")).withColumn(
            "confidence", F.array_max("scores")
        )

    def save(self, path: str, spark: SparkSession) -> None:
        if isinstance(self.model, BoostedTrees):
            self.model.save(f"{path}/nodes")
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        kind = "nodes" if isinstance(self.model, BoostedTrees) else "model"
        spark.createDataFrame(
            [(kind, self.features, [str(c) for c in self.classes])], "kind string, features array<string>, classes array<string>"
        ).write.mode("overwrite").parquet(f"{path}/signature")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedModel:
        row = spark.read.parquet(f"{path}/signature").first()
        classes = [int(c) if c.lstrip("-").isdigit() else c for c in row["classes"]]
        features = list(row["features"])
        if row["kind"] == "nodes":
            return FittedModel(BoostedTrees.load(spark, f"{path}/nodes", features, classes), features, classes)
        return FittedModel(PipelineModel.load(f"{path}/model").stages[0], features, classes)


def _dealt(vectors: DataFrame, rows: int, forest: RandomForestClassifier) -> DataFrame:
    """A forest reads its rows once a level: they are dealt to all cores where few files would keep half of them idle.

    Every task sends the sums of all nodes of a level, so no more tasks are made than there are cores.
    """
    wanted = -(-rows * forest.getNumTrees() * forest.getMaxDepth() // FOREST_VISITS)
    wanted = min(wanted, vectors.sparkSession.sparkContext.defaultParallelism)
    return vectors.repartition(wanted) if wanted > 1 and wanted >= 2 * vectors.rdd.getNumPartitions() else vectors


def fit(estimator, train: DataFrame, features: list[str], label: str) -> FittedModel:
    """Fit on rows as given; classes are numbered from 0 and weighted inversely to size."""
    sizes = balance.class_sizes(train, label)
    classes = list(sizes)
    if isinstance(estimator, Boosting):
        return FittedModel(fit_boosted(train, features, label, classes, estimator), features, classes)
    total = float(sum(sizes.values()))
    code, weight = F.lit(None).cast("double"), F.lit(1.0)
    for i, c in enumerate(classes):
        code = F.when(F.col(label) == F.lit(c), float(i)).otherwise(code)
        weight = F.when(F.col(label) == F.lit(c), total / (len(classes) * sizes[c])).otherwise(weight)
    rows = train.select(*features, code.alias("_y"), weight.alias("_weight"))
    vectors = VectorAssembler(inputCols=features, outputCol="_features").transform(rows)
    est = estimator.copy()
    est.setFeaturesCol("_features")
    vectors = vectors.select("_features", "_y", "_weight")
    if isinstance(est, RandomForestClassifier):
        vectors = _dealt(vectors, int(total), est)
    return FittedModel(est.fit(vectors), features, classes)


def balanced_rows(train: DataFrame, ident: str, features: list[str], label: str, seed: int = rules.SEED) -> DataFrame:
    """SMOTE of the training rows, written once for all the fits that use it."""
    return stage(balance.smote(train, ident, features, label, seed=seed))


def fit_balanced(estimator, train: DataFrame, ident: str, features: list[str], label: str, seed: int = rules.SEED):
    """Fit on SMOTE of the training rows; the rows to be tested are never touched."""
    return fit(estimator, balanced_rows(train, ident, features, label, seed), features, label)


def _side_by_side(work: Callable, names: list, spark: SparkSession, parallelism: int) -> dict:
    """Submit the jobs of several models or folds at once, so that small stages fill the cluster."""
    with ThreadPool(min(parallelism, len(names))) as pool:
        return dict(zip(names, pool.map(inheritable_thread_target(spark)(work), names)))


def cross_validate(
    estimators: dict,
    train: DataFrame,
    ident: str,
    features: list[str],
    label: str,
    folds: int = 5,
    seed: int = rules.SEED,
    parallelism: int = 4,
) -> dict[str, list[float]]:
    """Macro F1 per model and fold, with SMOTE inside the training part of the fold.

    The models share the balanced rows of a fold.
    """
    parts = stage(split.stratified_folds(train, label, ident, folds, seed))
    classes = list(balance.class_sizes(train, label))

    def of_fold(f: int) -> dict[str, float]:
        grown = balanced_rows(parts.filter(F.col("fold") != f), ident, features, label, seed)
        held = parts.filter(F.col("fold") == f)

        def score(name: str) -> float:
            guess = fit(estimators[name], grown, features, label).predict(held)
            return metrics.macro_f1(guess, label, "prediction", classes).first()["macro_f1"]

        return _side_by_side(score, list(estimators), train.sparkSession, parallelism)

    done = _side_by_side(of_fold, list(range(folds)), train.sparkSession, min(parallelism, FOLDS_AT_ONCE))
    return {name: [done[f][name] for f in range(folds)] for name in estimators}


def with_row_number(rows: DataFrame, name: str = "row_id") -> DataFrame:
    """A unique whole number per row, fixed by writing the rows once."""
    return stage(rows.withColumn(name, F.monotonically_increasing_id()))


def held_out(rows: DataFrame, ident: str, label: str, share: float = 0.2, seed: int = rules.SEED) -> DataFrame:
    """Rows with ``is_test``, written once so that every later step sees the same split."""
    return stage(split.stratified_holdout(rows, label, ident, share, seed))


@dataclass
class Comparison:
    table: DataFrame
    models: dict[str, FittedModel]

    def best(self, metric: str = "cv_macro_f1") -> FittedModel:
        """Chosen by cross-validation unless another metric is named."""
        return self.models[metrics.best_model(self.table, metric).first()["model"]]


def compare(
    estimators: dict,
    rows: DataFrame,
    ident: str,
    features: list[str],
    label: str,
    folds: int = 5,
    seed: int = rules.SEED,
    split_column: str | None = None,
    parallelism: int = 4,
) -> Comparison:
    """Hold out a fifth, cross-validate and fit on the rest, test on the untouched part.

    ``split_column`` names an existing split instead.
    """
    if split_column:
        parts = rows.select(ident, *features, label, F.col(split_column).alias("is_test"))
    else:
        parts = held_out(rows.select(ident, *features, label), ident, label, seed=seed)
    train, test = parts.filter(~F.col("is_test")).drop("is_test"), parts.filter("is_test").drop("is_test")
    classes = list(balance.class_sizes(rows, label))

    def folds_scored() -> dict[str, list[float]]:
        return cross_validate(estimators, train, ident, features, label, folds, seed, parallelism)

    def fitted() -> dict:
        grown = balanced_rows(train, ident, features, label, seed)

        def final(name: str):
            model = fit(estimators[name], grown, features, label)
            return model, metrics.macro_f1(model.predict(test), label, "prediction", classes).first()

        return _side_by_side(final, list(estimators), rows.sparkSession, parallelism)

    found = _side_by_side(lambda work: work(), [folds_scored, fitted], rows.sparkSession, parallelism)
    cv_scores, done = found[folds_scored], found[fitted]
    models, lines = {n: m for n, (m, _) in done.items()}, []
    for name, (_, tested) in done.items():
        cv = cv_scores[name]
        mean = sum(cv) / len(cv)
        spread = (sum((s - mean) ** 2 for s in cv) / len(cv)) ** 0.5
        lines.append((name, mean, spread, tested["macro_f1"], tested["accuracy"]))
    table = rows.sparkSession.createDataFrame(
        lines, "model string, cv_macro_f1 double, cv_std double, test_macro_f1 double, test_accuracy double"
    )
    return Comparison(table.orderBy(F.desc("test_macro_f1"), "model"), models)


def risk_alerts(
    cases: DataFrame, encoder: CaseEncoder, model: FittedModel, ident: str = "primaryid", least: int = rules.ALERT_MIN_SEVERITY
) -> DataFrame:
    """Scored rows predicted at or above the alert severity, as alert records."""
    scored = model.predict(encoder.transform(cases))
    return scored.filter(F.col("prediction") >= least).select(
        ident,
        "age",
        "sex",
        F.col(encoder.drug).alias("drugname"),
        F.col(encoder.term).alias("pt"),
        F.col("prediction").alias("predicted_severity"),
        severity_label("prediction").alias("severity_label"),
        F.round("confidence", 4).alias("confidence_score"),
        F.current_timestamp().alias("timestamp"),
    )


def score_cases(cases: DataFrame, encoder: CaseEncoder, model: FittedModel, signals: DataFrame) -> DataFrame:
    """Every case with its predicted severity and the history of its pair."""
    scored = model.predict(encoder.transform(cases))
    return attach_signals(scored, signals, encoder.drug, encoder.term)
