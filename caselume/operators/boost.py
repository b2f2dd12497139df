"""Boosted trees for several classes, by first and second derivatives of the softmax loss.

Values are brought to bins, and rows with the same bins and class are folded into one weighted cell: all rounds
read cells. The trees of a round, one for each class, grow together: the sums of a level come from one
aggregation by (class, node, feature, bin), and only these sums reach the driver, where splits are chosen: their number is
bounded by the settings, not by the data. A model is a table of nodes; tasks score batches of rows from it.

The objective and the gain follow Chen and Guestrin, "XGBoost: A Scalable Tree Boosting System" (KDD 2016).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scale import running_totals, scratch, stage, unpivot

NODES = "tree int, class_no int, node int, feature int, threshold double, value double"
#: Rounds whose values are added to the cells again in every job before they are written.
STAGED = 4
#: A split must gain more than this beside ``gamma``: what is below is noise of sums.
LEAST_GAIN = 1e-6


@dataclass
class Boosting:
    """Settings. ``bins`` bounds the values at which a feature can be split, ``depth`` the levels of a tree."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    ridge: float = 1.0
    gamma: float = 0.0
    least_weight: float = 1.0
    bins: int = 64


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """For each feature at most ``bins`` values that end bins of about equal numbers of rows; equal values stay together."""
    per_value = unpivot(df, [], features, "double").filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("m"))
    cum = running_totals(per_value, ["column"], ["value"], ["m"])
    spot = F.floor((F.col("cum_m") - F.col("m")) * bins / F.col("total_m"))
    rows = cum.groupBy("column", spot.alias("spot")).agg(F.max("value").alias("edge")).collect()  # ``bins`` a feature
    return [sorted(r["edge"] for r in rows if r["column"] == f) for f in features]


def _array(values: list, kind: str) -> str:
    return f"cast(array({', '.join(map(repr, values))}) as array<{kind}>)"


def _leaf(depth: int, feats: str, cuts: str, base: str, row: str) -> str:
    """The node in which ``row``, an array, ends in the tree whose nodes begin at ``base``: node n has the children 2n and 2n + 1."""
    go = f"if(get({row}, get({feats}, {base} + n)) > get({cuts}, {base} + n), 1, 0)"
    return f"aggregate(sequence(1, {depth}), 1, (n, l) -> if(get({feats}, {base} + n) < 0, n, 2 * n + {go}))"


@dataclass
class _Trees:
    """The trees of one round: split features (-1: none) and bins by class and node, sums of the nodes."""

    classes: int
    depth: int

    def __post_init__(self):
        self.size = 2 << self.depth
        self.feats, self.cuts = [-1] * (self.classes * self.size), [0] * (self.classes * self.size)
        self.sums: dict[tuple[int, int], tuple[float, float]] = {}

    def node(self, k: str) -> str:
        return _leaf(self.depth, _array(self.feats, "int"), _array(self.cuts, "int"), f"{k} * {self.size}", "bins")

    def values(self, rate: float, ridge: float) -> list[float]:
        out = [0.0] * (self.classes * self.size)
        for (k, node), (g, h) in self.sums.items():
            if self.feats[k * self.size + node] < 0:
                out[k * self.size + node] = -rate * g / (h + ridge)
        return out


def _best_split(f: np.ndarray, bins: np.ndarray, g: np.ndarray, h: np.ndarray, how: Boosting) -> tuple | None:
    """(feature, bin, sums left of it) of a node's best split, from its sums sorted by feature and bin; none if nothing gains enough."""
    best = None
    for feature in np.unique(f):
        own = f == feature
        gl, hl = np.cumsum(g[own]), np.cumsum(h[own])
        gt, ht = gl[-1], hl[-1]
        gain = gl**2 / (hl + how.ridge) + (gt - gl) ** 2 / (ht - hl + how.ridge) - gt**2 / (ht + how.ridge)
        # Of equal gains the first bin of the first feature; sums of another order differ in their last digits.
        gain = np.where((hl >= how.least_weight) & (ht - hl >= how.least_weight) & (gain > how.gamma + LEAST_GAIN), gain.round(9), -np.inf)
        i = int(gain.argmax())
        if np.isfinite(gain[i]) and (best is None or gain[i] > best[0]):
            best = (gain[i], int(feature), int(bins[own][i]), float(gl[i]), float(hl[i]))
    return best and best[1:]


def _grow(rows: DataFrame, classes: int, features: int, how: Boosting) -> _Trees:
    """The trees of one round from ``(bins, k, g, h)``. The sums of a level, one aggregation, have classes x nodes x features x bins rows at most."""
    trees = _Trees(classes, how.depth)
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.get("bins", F.lit(i)).alias("bin")) for i in range(features)]))
    for level in range(how.depth):
        at = rows.withColumn("node", F.expr(trees.node("k"))).filter(F.col("node") >= 1 << level)
        sums = at.select("k", "node", "g", "h", cells).groupBy("k", "node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        found = sums.toPandas().sort_values(["k", "node", "f", "bin"], kind="stable")
        grown = False
        for (k, node), own in found.groupby(["k", "node"]):
            f, bins, g, h = (own[c].to_numpy() for c in ("f", "bin", "g", "h"))
            gt, ht = float(g[f == 0].sum()), float(h[f == 0].sum())
            trees.sums[k, node] = gt, ht
            split = _best_split(f, bins, g, h, how)
            if split is not None:
                grown = True
                trees.feats[k * trees.size + node], trees.cuts[k * trees.size + node] = split[:2]
                trees.sums[k, 2 * node] = split[2:]
                trees.sums[k, 2 * node + 1] = gt - split[2], ht - split[3]
        if not grown:
            break
    return trees


@dataclass
class BoostedTrees:
    """A model: ``nodes`` (``tree``, ``class_no``, ``node``, ``feature``, ``threshold``, ``value``), its features and classes.

    Node 1 is a root, and n has the children 2n (values up to the threshold, and nulls) and 2n + 1. A leaf has no feature.
    """

    nodes: DataFrame
    features: list[str]
    classes: list

    def scores(self) -> Callable[[Column], Column]:
        """A function of the array of the features: the shares of the classes, which sum to 1, as an array.

        The table of nodes, whose size the settings bound, goes to the tasks once, and a task scores a batch of rows at a time.
        """
        nodes = self.nodes.toPandas()
        count, size = len(self.classes), 2 << max(1, int(nodes["node"].max()).bit_length() - 1)
        at = nodes["tree"].to_numpy(int) * size + nodes["node"].to_numpy(int)
        slots = (int(nodes["tree"].max()) + 1) * size
        feats, cuts, values = np.full(slots, -1), np.zeros(slots), np.zeros(slots)
        for whole, column in ((feats, "feature"), (cuts, "threshold"), (values, "value")):
            known = nodes[column].notna() if column != "threshold" else nodes["feature"].notna()
            whole[at[known]] = nodes[column][known].to_numpy(float)
        shared = self.nodes.sparkSession.sparkContext.broadcast((feats, cuts, values))

        # Not deterministic by name, so that a filter on the scores doesn't have them computed twice.
        @F.arrow_udf("array<double>")
        def shares(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            feats, cuts, values = shared.value
            for batch in batches:
                # A null goes where the smallest value goes; Spark has NaN above all numbers.
                x = pc.fill_null(batch.flatten(), -np.inf).to_numpy(zero_copy_only=False).reshape(len(batch), -1).T
                rows, sums = np.arange(x.shape[1]), np.zeros((count, x.shape[1]))
                for tree in range(len(feats) // size):
                    node = np.ones(len(rows), int)
                    for _ in range(size.bit_length() - 2):
                        f, cut = feats[tree * size + node], cuts[tree * size + node]
                        v = x[np.maximum(f, 0), rows]
                        right = (v > cut) | (np.isnan(v) & ~np.isnan(cut))
                        node = np.where(f < 0, node, 2 * node + right)
                    sums[tree % count] += values[tree * size + node]
                odds = np.exp(sums - sums.max(axis=0))
                total = np.zeros(len(rows))
                for o in odds:
                    total += o
                yield pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * count, (odds / total).T.ravel())

        return shares.asNondeterministic()

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (the class with the largest score, the first at a tie), ``scores`` (shares that sum to 1) and ``confidence``."""
        out = df.withColumn("_s", self.scores()(F.array(*[F.col(f).cast("double") for f in self.features]))).withColumn("_top", F.array_max("_s"))
        best = F.array_position("_s", F.col("_top")).cast("int") - 1
        named = F.get(F.array(*[F.lit(c) for c in self.classes]), best)
        return out.select(*df.columns, named.alias("prediction"), F.col("_s").alias("scores"), F.col("_top").alias("confidence"))

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, features: list[str], classes: list) -> BoostedTrees:
        return BoostedTrees(spark.read.parquet(path), features, classes)


def fit_boosted(df: DataFrame, features: list[str], label: str, classes: list, how: Boosting | None = None, weight: str | None = None) -> BoostedTrees:
    """Trees for the classes in the order given; rows of another or no class are left out, and nulls count as the smallest value."""
    how = how or Boosting()
    spark = df.sparkSession
    with scratch(spark) as last:
        number = F.lit(None).cast("int")
        for i, c in enumerate(classes):
            number = F.when(F.col(label) == F.lit(c), i).otherwise(number)
        rows = stage(df.select(*features, number.alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")).filter("y is not null"))
        edges = bin_edges(rows, features, how.bins)
        bins = F.array(*[F.expr(f"size(filter({_array(e, 'double')}, t -> t < cast(`{f}` as double)))") if e else F.lit(0) for f, e in zip(features, edges)])
        cells = rows.groupBy(bins.alias("bins"), "y").agg(F.sum("w").alias("w"))
        cells = stage(cells.withColumn("m", F.array_repeat(F.lit(0.0), len(classes))))
        nodes = []
        for round_ in range(how.rounds):
            odds = cells.withColumn("e", F.transform("m", lambda m: F.exp(m - F.array_max("m"))))
            shares = odds.withColumn("z", F.aggregate("e", F.lit(0.0), lambda acc, v: acc + v))
            slopes = F.expr("inline(transform(e, (v, i) -> named_struct('k', i, 'g', w * (v / z - if(y = i, 1, 0)), 'h', w * 2 * (v / z) * (1 - v / z))))")
            trees = _grow(shares.select("bins", slopes), len(classes), len(features), how)
            values = trees.values(how.rate, how.ridge)
            step = f"transform(m, (x, i) -> x + get({_array(values, 'double')}, i * {trees.size} + {trees.node('i')}))"
            if round_ + 1 < how.rounds:
                cells = cells.withColumn("m", F.expr(step))
                cells = stage(cells) if round_ % STAGED == STAGED - 1 else cells
            for k, node in sorted(trees.sums):
                f, cut = trees.feats[k * trees.size + node], trees.cuts[k * trees.size + node]
                inner = f >= 0
                nodes.append((int(round_ * len(classes) + k), int(k), int(node), f if inner else None, edges[f][cut] if inner else None, None if inner else values[k * trees.size + node]))
        return BoostedTrees(last(spark.createDataFrame(nodes, NODES)), features, classes)
