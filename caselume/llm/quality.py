"""Quality: Bradley-Terry scores from preference pairs.

In a pair of labelled texts the better one wins with probability sigmoid(score difference).
The score is additive over dense features, each also cut at its quantiles, and is fitted by the
logistic loss of feature differences. The threshold is a quantile of the scores: as
many of the training rows lie above it as are labelled good.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import stage, staged_map
from .toxicity import is_held_out, training_rows

PAIRS, PARTNERS, CUTS = 60_000, 2, 10
FEATURES = (
    "log_words", "log_chars", "word_length", "long_words", "distinct_words", "top_word", "distinct_pairs", "capital_letters", "capital_words", "digits", "marks", "exclamations",
    "bars", "symbols", "ends", "lines", "short_lines", "repeated_lines", "compressed", "marked_words", "small_words", "brackets",
)
_MARKED = re.compile(r"\w[#$%&*@!|]{2,}")


def features(text: str) -> list[float]:
    """The features in the order of ``FEATURES``; of a text without words all 0."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars, low = len(text), text.lower().split()
    count: dict[str, int] = {}
    for w in low:
        count[w] = count.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    raw = text.encode()
    packed = sum(len(zlib.compress(raw[i : i + 32_768], 1)) for i in range(0, len(raw), 32_768))
    sizes = np.fromiter(map(len, words), float, n)
    letters = sum(map(str.isalpha, text)) or 1
    return [
        math.log1p(n), math.log1p(chars), float(sizes.mean()), float((sizes > 12).mean()), len(count) / n, max(count.values()) / n,
        len(set(zip(low, low[1:]))) / max(1, n - 1), sum(map(str.isupper, text)) / letters, sum(map(str.isupper, words)) / n, sum(map(str.isdigit, text)) / chars,
        1 - (letters + text.count(" ") + text.count("\n")) / chars, text.count("!") / n, text.count("|") / n, sum(map(text.count, "#$%&*@")) / n,
        (text.count(".") + text.count(",")) / n, len(lines) / n, sum(len(x) < 30 for x in lines) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        packed / len(raw), len(_MARKED.findall(text)) / n, float((sizes < 4).mean()), sum(map(text.count, "(){}[]<>=;")) / n,
    ]


def score(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, parts: int = 5, held_out: int = 0, rows: int | None = None, pairs: int = PAIRS
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) for each row of ``docs``.

    Learned from the labels whose crc32(``doc_id``) mod ``parts`` is not ``held_out``, from all of them unless ``rows`` names
    a bound for each class. A hash deals rows to pairs: ``pairs`` of them or, if that is more, about ``PARTNERS`` for each row of the larger class. Every whole text is scored from its text alone. A null text
    counts as empty and has the score of a text without words. Without rows of both classes every score is the share of good
    labels, or 0. Repeated rows stay; other columns are not read.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    spark = docs.sparkSession
    ship_package(spark)
    rows_in = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            values = [features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "x"])

    seen = staged_map(rows_in, run, "doc_id long, x array<double>")
    picked = training_rows(labels, "quality", lambda d: ~is_held_out(d, parts, held_out), rows)
    train = stage(seen.join(picked, "doc_id"))
    out = seen.select("doc_id", is_held_out(F.col("doc_id"), parts, held_out).alias("held_out"), "x")
    sizes = {r["label"]: (r["n"], r["w"]) for r in train.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    good, bad = sizes.get(1.0, (0, 0.0)), sizes.get(0.0, (0, 0.0))
    share = good[1] / (good[1] + bad[1]) if sizes else 0.0
    if not good[0] or not bad[0]:
        return out.select("doc_id", "held_out", F.lit(share).alias("score"), F.lit(int(share >= threshold)).alias("predicted"))

    # Each feature: standardised, and whether it passes each of its quantiles.
    k = len(FEATURES)
    probs = [i / CUTS for i in range(1, CUTS)]
    told = train.select(
        *[f for i in range(k) for f in (
            F.expr(f"percentile_approx(x[{i}], array({', '.join(map(str, probs))}), 1000)").alias(f"q{i}"), F.avg(F.expr(f"x[{i}]")).alias(f"m{i}"), F.stddev_pop(F.expr(f"x[{i}]")).alias(f"s{i}"),
        )]
    ).first()
    cells = []
    for i in range(k):
        cells.append((F.col("x")[i] - float(told[f"m{i}"])) / float(told[f"s{i}"] or 1.0))
        cells += [(F.col("x")[i] > float(q)).cast("double") for q in sorted(set(told[f"q{i}"]))]
    wide = stage(train.select("doc_id", "label", "weight", F.array(*cells).alias("z")))
    buckets = max(1, min(good[0] * bad[0] // pairs, min(good[0], bad[0]) // PARTNERS))
    side = wide.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(buckets)))
    winners = side.filter("label = 1").select("bucket", F.col("doc_id").alias("a"), F.col("z").alias("za"))
    losers = side.filter("label = 0").select("bucket", F.col("doc_id").alias("b"), F.col("z").alias("zb"))
    turned = F.when(F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    differences = winners.join(losers, "bucket").withColumn("turn", turned).select(
        ((F.col("turn") + 1) / 2).alias("label"), array_to_vector(F.expr("transform(zip_with(za, zb, (p, q) -> p - q), d -> d * turn)")).alias("features")
    )
    model = LogisticRegression(fitIntercept=False, regParam=1e-3, maxIter=60, standardization=False).fit(stage(differences))
    weights = [float(w) for w in model.coefficients]

    def strength(cells_):
        total = F.lit(0.0)
        for w, c in zip(weights, cells_):
            total = total + w * c
        return total

    ranked = train.select(strength(cells).alias("s"), "label", "weight")
    # As the classes may be cut to different shares, each has its own quantiles; the threshold balances both.
    grid = [i / 200 for i in range(201)]
    q = {r["label"]: np.array(r["q"]) for r in ranked.groupBy("label").agg(F.expr(f"percentile_approx(s, array({', '.join(map(str, grid))}), 2000)").alias("q")).collect()}
    points = np.sort(np.concatenate([q[0.0], q[1.0]]))
    above = sum(n[1] * (1 - np.searchsorted(q[y], points, "left") / len(grid)) for y, n in ((0.0, bad), (1.0, good)))
    cut = float(points[np.argmin(np.abs(above - good[1]))])
    spread = float(np.std(points)) or 1.0
    base = math.log(threshold / (1 - threshold))
    final = 1 / (1 + F.exp(-((F.col("s") - cut) / spread + base)))
    return out.select("doc_id", "held_out", strength(cells).alias("s")).select(
        "doc_id", "held_out", final.alias("score"), (F.col("s") >= cut).cast("int").alias("predicted")
    )
