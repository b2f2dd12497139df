"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Two lexicons are used: a short fixed one, and one learned from the labelled rows, of words and
beginnings of words that toxic texts use much more often. Features are densities of hits,
their nearness to a second person, capitals, punctuation and obfuscation. A training row's
features come from a lexicon learned without its fold, so that they look as those of new rows do.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scale import scratch
from ..session import ship_package
from .common import small_batches, stage, trimmed

#: Common insults, and second persons.
INSULTS = frozenset("idiot idiots moron stupid loser scum trash worthless pathetic disgusting clown dumb dumbass ugly hate shut kill die bastard bitch fuck fucking asshole crap jerk fool dumm blöd arschloch scheisse hure connard salope merde stupide idiote estúpido idiota mierda puta tonto".split())
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous vos votre tú ti usted vosotros vuestro".split())
#: Rows of each class that are learned from at most, chosen by a hash of their id; the other bounds of what is learned.
SAMPLE_ROWS, LEXICON_WORDS, FOLDS = 20_000, 20_000, 3
FEATURES = (
    "log_words", "fixed_density", "fixed_hits", "learned_density", "learned_sum", "learned_top", "learned_kinds", "near_second", "second_density", "capital_words",
    "capital_letters", "exclamations", "punctuation", "symbols", "obfuscated", "obfuscated_hits", "long_runs", "mean_length",
)

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\S+")
#: The rare character first: a sign or figure between two letters.
_OBFUSCATED = re.compile(r"[0-9@$*!|](?<=[^\W\d_].)(?=[^\W\d_])")
_RUN = re.compile(r"(\w)\1\1")
_LEET = str.maketrans("013457@$!|", "oieastasil")
KNOWN_WORDS = 60_000


def units(word: str) -> list[str]:
    """What the learned lexicon may hold of a word: itself, and its beginnings."""
    return [word, *(f"{word[:k]}~" for k in range(4, min(len(word), 8)))]


class _Weights(dict):
    """Weight of a word: that of its strongest unit, 0 without one. Bounded memory."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = out = max((self.lexicon.get(u, 0.0) for u in units(word)), default=0.0)
        return out


def features(text: str, weights: _Weights) -> list[float]:
    """The features in the order of ``FEATURES``; of an empty text all 0."""
    raw = _WORD.findall(text)
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    joined = " ".join(raw)
    low = joined.lower()
    words = low.split()
    hits = np.fromiter(map(weights.__getitem__, words), float, len(words))
    at = np.flatnonzero(hits)
    fixed = [] if INSULTS.isdisjoint(words) else [i for i, w in enumerate(words) if w in INSULTS]
    second = np.array([] if SECOND.isdisjoint(words) else [i for i, w in enumerate(words) if w in SECOND], np.int64)
    near = 0
    if len(second) and (len(at) or fixed):
        every = np.union1d(at, np.array(fixed, np.int64))
        right = np.searchsorted(second, every)
        gap = np.minimum(np.abs(second[np.minimum(right, len(second) - 1)] - every), np.abs(every - second[np.maximum(right - 1, 0)]))
        near = int((gap <= 5).sum())
    chars = len(text)
    letters = len(joined) - n + 1
    marks = chars - letters - text.count(" ") - text.count("\n")
    ends = text.count(".") + text.count(",")
    odd = [t for t in _TOKEN.findall(text) if _OBFUSCATED.search(t)] if _OBFUSCATED.search(text) else []
    plain = [w for t in odd for w in _WORD.findall(t.lower().translate(_LEET))]
    return [
        math.log1p(n), len(fixed) / n, math.log1p(len(fixed)), len(at) / n, math.log1p(float(hits.sum())), float(hits.max(initial=0.0)),
        math.log1p(len({words[i] for i in at})), near / n, len(second) / n, sum(len(w) > 1 for w in filter(str.isupper, raw)) / n,
        _capitals(joined, low) / letters, text.count("!") / n, (marks - ends) / chars, sum(map(text.count, "#$%&*@|")) / n,
        len(odd) / n, sum(w in INSULTS or weights[w] > 0 for w in plain) / n, _runs(text) / n, letters / n,
    ]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _capitals(text: str, low: str) -> int:
    """Letters that lower-casing changes."""
    if len(text) != len(low):  # a letter that becomes two
        return sum(map(str.isupper, text))
    return int(np.count_nonzero(_code_points(text) != _code_points(low)))


def _runs(text: str) -> int:
    """Runs of a repeated letter or figure, three by three."""
    at = _code_points(text)
    twice = at[1:] == at[:-1]
    here = at[2:][twice[1:] & twice[:-1]]
    return len(_RUN.findall(text)) if len(here) and any(chr(c).isalnum() or c == 95 for c in set(here.tolist())) else 0


def is_held_out(doc_id, parts: int, part: int):
    """Whether crc32 of the id as text leaves ``part``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def training_rows(labels: DataFrame, label: str, trained, rows: int | None) -> DataFrame:
    """``doc_id``, ``label``, ``weight``: all rows, or at most ``rows`` of each class, by a hash of their id.

    A class that is cut has greater weights instead. An id with several labels has the greatest.
    """
    clean = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & trained(F.col("doc_id")))
    clean = stage(clean.groupBy("doc_id").agg(F.max(label).cast("double").alias("label")))
    if rows is None:
        return clean.withColumn("weight", F.lit(1.0))
    picked = None
    for y in (0.0, 1.0):
        own = clean.filter(F.col("label") == y)
        n = own.count()
        part = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumn("weight", F.lit(max(1.0, n / rows)))
        picked = part if picked is None else picked.union(part)
    return stage(picked)


def _learn_lexicons(found: DataFrame) -> list[dict[str, float]]:
    """Lexicons without fold 0, 1, ..., and that of all folds; ``found`` has ``text``, ``label``, ``weight``, ``fold``."""

    def run(batches):
        for b in batches:
            out = [(u, f, y, w) for t, f, y, w in zip(*(b.column(c).to_pylist() for c in ("text", "fold", "label", "weight"))) for u in {u for x in set(_WORD.findall(t.lower())) for u in units(x)}]
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.float64(), pa.float64()))], names=["unit", "fold", "label", "weight"])

    with small_batches(found.sparkSession):
        seen = stage(
            found.select("text", "fold", "label", "weight").mapInArrow(trimmed(run), "unit string, fold int, label double, weight double")
            .groupBy("unit").agg(
                *[F.sum(F.when((F.col("fold") == f) & (F.col("label") == y), F.col("weight")).otherwise(0.0)).alias(f"n{f}_{y}") for f in range(FOLDS) for y in (0, 1)],
            )
        )
    totals = found.groupBy("fold", "label").agg(F.sum("weight").alias("n")).collect()
    size = np.zeros((FOLDS, 2))
    for r in totals:
        size[r["fold"], int(r["label"])] = r["n"]
    toxic, clean = (sum(F.col(f"n{f}_{y}") for f in range(FOLDS)) for y in (1, 0))
    ratio = (toxic + 0.5) / float(size[:, 1].sum() + 1) / ((clean + 0.5) / float(size[:, 0].sum() + 1))
    # Bounded: the strongest units, by how much they tell.
    best = seen.filter((toxic >= 3) & (ratio >= 3)).orderBy((toxic * F.log(ratio)).desc(), "unit").limit(LEXICON_WORDS).collect()
    names = [r["unit"] for r in best]
    counts = np.array([[[r[f"n{f}_{y}"] for y in (0, 1)] for f in range(FOLDS)] for r in best]).reshape(-1, FOLDS, 2)
    out = []
    for left_out in [*range(FOLDS), None]:
        own = [f for f in range(FOLDS) if f != left_out]
        c, n = counts[:, own].sum(axis=1), size[own].sum(axis=0)
        odds = np.log((c[:, 1] + 0.5) / (n[1] + 1)) - np.log((c[:, 0] + 0.5) / (n[0] + 1))
        keep = (odds >= 1.5) & (c[:, 1] >= 2)
        out.append({u: float(o) for u, o, k in zip(names, odds, keep) if k})
    return out


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, parts: int = 3, held_out: int = 1, rows: int = SAMPLE_ROWS, trees: int = 30,
          names: tuple[str, str, str] = ("held_out", "score", "predicted"), keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on), or under other ``names``.

    Learned from the labels whose crc32(``doc_id``) mod ``parts`` is not ``held_out``: ``rows`` of each class at most
    (a documented bound; a hash of the id chooses, weights make up for it). Every whole text is scored from
    its text alone. A null text counts as empty and has the score of one without words. Without rows of both classes all
    scores are the share of toxic labels, or 0. Columns of these names are replaced, others and repeated rows stay.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.drop(*names)
    own = docs.columns if keep is None else keep
    out = [docs[c].alias(f"c{i}") for i, c in enumerate(own)]
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(own)]
    out.append(is_held_out(F.col("doc_id"), parts, held_out).alias("__out"))
    with scratch(spark):
        lexicons, model, steps = _learn(docs, labels, parts, held_out, rows, trees)
    if model is None:
        return docs.select(*out).select(*kept, *[c.alias(n) for c, n in zip((F.col("__out"), F.lit(steps), F.lit(int(steps >= threshold))), names)])
    # Each row once, from its text to its score: nothing is shuffled or written on the way.
    seen = _with_features(docs.select(*out, F.lit(FOLDS).alias("__fold"), F.coalesce("text", F.lit("")).alias("__text")), lexicons)
    steps.setPredictionCol("calibrated")
    scored = steps.transform(model.transform(seen.withColumn("features", array_to_vector("__x"))).withColumn("p", vector_to_array("probability")[1]))
    # The steps are flat; a thousandth of the trees' own probability keeps order within one.
    final = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("calibrated") + 0.001 * F.col("p")))
    scored = scored.withColumn("__score", final)
    verdict = (F.col("__score") >= threshold).cast("int")
    return scored.select(*kept, *[c.alias(n) for c, n in zip((F.col("__out"), F.col("__score"), verdict), names)])


def _with_features(rows: DataFrame, lexicons) -> DataFrame:
    """``rows`` without their two last columns, ``__fold`` and ``__text``, and with ``__x``."""

    def run(batches):
        # Rows to learn from are seen by the lexicon without their fold, rows to score by the whole one.
        weights = [_Weights(x) for x in lexicons.value]
        for b in batches:
            n = b.num_columns - 1
            values = [features(t.as_py(), weights[f.as_py()]) for t, f in zip(b.column(n), b.column(n - 1))]
            yield pa.RecordBatch.from_arrays([*b.columns[: n - 1], pa.array(values, pa.list_(pa.float64()))], names=[*b.schema.names[: n - 1], "__x"])

    return rows.mapInArrow(trimmed(run), rows.drop("__fold", "__text").withColumn("__x", F.array(F.lit(0.0))).schema)


def _learn(docs: DataFrame, labels: DataFrame, parts: int, held_out: int, rows: int, trees: int):
    """The lexicons, sent to all tasks, the trees and their calibration; without rows of both classes no trees, and the share of toxic labels."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    spark = docs.sparkSession
    picked = training_rows(labels, "toxic", lambda d: ~is_held_out(d, parts, held_out), rows).withColumn(
        "fold", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS))).cast("int")
    )
    known = F.broadcast(picked.select(F.col("doc_id").alias("__id"), "fold", "label", "weight"))  # at most 2 * rows
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    learned = stage(texts.join(known, F.col("doc_id") == F.col("__id")).select("text", "fold", "label", "weight"))
    lexicons = spark.sparkContext.broadcast(_learn_lexicons(learned))  # LEXICON_WORDS entries each at most
    with small_batches(spark):
        train = stage(_with_features(learned.select("label", "weight", "fold", F.col("fold").alias("__fold"), F.col("text").alias("__text")), lexicons))
    train = train.select("label", "weight", "fold", array_to_vector("__x").alias("features"))
    fit, tune = stage(train.filter("fold != 0")), stage(train.filter("fold = 0"))
    if min(fit.select("label").distinct().count(), tune.select("label").distinct().count()) < 2:
        return lexicons, None, train.agg(F.avg("label")).first()[0] or 0.0
    model = GBTClassifier(maxIter=trees, maxDepth=4, stepSize=0.2, maxBins=64, minInstancesPerNode=5, weightCol="weight", seed=7).fit(fit)
    guessed = model.transform(tune).withColumn("p", vector_to_array("probability")[1]).select("p", "label", "weight")
    return lexicons, model, IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight").fit(guessed)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged. Equal texts go or stay together."""
    names = ("__held_out", "__toxic_score", "__toxic")
    return score(docs, labels, threshold, names=names).filter("__toxic = 0").drop(*names)
