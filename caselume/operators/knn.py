"""Exact k nearest neighbours of every row, without comparing all pairs.

Ties are broken by neighbour id, so the answer is unique. The plan:

1. Equal feature vectors are folded into one *spot* that keeps its k+1 smallest
   ids. Ties go to the smallest ids, so no other copy can ever be an answer, and a
   vector that a third of all rows share costs no more than any other.
2. Few spots (rows and values are counted against fixed limits): they are broadcast
   and every task scans them.
3. Many spots: a tree of pivots. A cell with more than ``block_rows`` spots gets pivots of
   its own, those of its spots with the smallest hashes, and each spot goes to the nearest; so on
   level by level until every cell is a block of at most ``block_rows``. The tree is a table
   (centre, radius, rows of each cell) that is joined and never gathered.
4. A block answers its own spots, which bounds their k-th distances.
5. Pairs of cells are followed down the tree, two levels at a time, and dropped as soon as the balls
   around them are farther apart than the bound of the first. What is left are the
   pairs of blocks that can matter; no row has moved so far.
6. Blocks that lie together form a team of about ``TEAM_ROWS`` spots. A block that has to visit blocks of a team sends its
   spots there once, and the task keeps the best rows of each spot, whose bound shrinks on the way: there
   are ``k + 1`` candidates at most for each spot and team. A team with many visitors is copied. Candidates are
   (spot, distance, id); labels and vectors of the answers are joined once at the end.

Pivot cells follow Lu et al., "Efficient Processing of k Nearest Neighbor Joins
using MapReduce" (VLDB 2012); pairs of cells are pruned as in dual-tree searches (Gray and Moore, 2001).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scale import scratch, stage
from ..session import ship_package

#: Spots and values that are broadcast at most; beyond, the tree is used.
BROADCAST_SPOTS = 8192
BROADCAST_VALUES = 1_000_000
#: Spots of a block, pivots of a cell, spots that one task deals to the pivots of their cell.
BLOCK_ROWS = 2048
FANOUT = 64
DEALT_ROWS = 16_384
#: Spots of the small cells that a call of Python takes together, spots of a team, spots of a team compared at once.
GROUP_ROWS = 4096
TEAM_ROWS = 16_384
SLAB_ROWS = 1024
#: Pairs of cells whose balls are compared at once.
MET = 1 << 19
_CHUNK = 512
#: Relative error of a sum of products of doubles, for each dimension, with room to spare.
_EPS = 1e-15

_CANDIDATE = "sid bigint, d2 double, id bigint"


# --- kernels on the arrays of one block --------------------------------------------


@dataclass
class _Points:
    """Spots of one block as arrays; the ids of spot i are ``ids[off[i] : off[i + 1]]``."""

    sid: np.ndarray
    x: np.ndarray
    c: np.ndarray
    off: np.ndarray
    ids: np.ndarray

    @staticmethod
    def of(pdf: pd.DataFrame) -> _Points:
        sizes = np.array([len(v) for v in pdf["ids"]], dtype=np.int64)
        ids = np.concatenate([np.asarray(v, dtype=np.int64) for v in pdf["ids"]]) if len(pdf) else np.zeros(0, np.int64)
        return _Points(pdf["sid"].to_numpy(), _matrix(pdf["x"]), _texts(pdf["c"]), np.concatenate([[0], np.cumsum(sizes)]), ids)

    @staticmethod
    def packed(row) -> _Points:
        sid = np.asarray(row["sid"], np.int64)
        x, c = np.asarray(row["x"], np.float64).reshape(len(sid), -1), np.asarray(row["c"], object).reshape(len(sid), -1)
        return _Points(sid, x, c, np.asarray(row["off"], np.int64), np.asarray(row["ids"], np.int64))


def _matrix(col) -> np.ndarray:
    if not len(col):
        return np.zeros((0, 0))
    return np.array([np.asarray(v, dtype=np.float64) for v in col], dtype=np.float64).reshape(len(col), -1)


def _texts(col) -> np.ndarray:
    out = np.empty((len(col), len(col.iloc[0]) if len(col) else 0), dtype=object)
    for i, v in enumerate(col):
        out[i, :] = list(v)
    return out


def _differing(qc, pc) -> np.ndarray | float:
    """How many categories differ, for all pairs."""
    out: np.ndarray | float = 0.0
    for j in range(pc.shape[1] if len(pc) and len(qc) else 0):
        codes = np.unique(np.concatenate([qc[:, j], pc[:, j]]).astype(str), return_inverse=True)[1]
        out = out + (codes[: len(qc), None] != codes[None, len(qc) :])
    return out


def _about(qx, qc, px, pc, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one product of matrices, and how far each query's may be off."""
    middle = px.mean(axis=0) if len(px) else 0.0
    q, p = qx - middle, px - middle
    qq, pp = (q * q).sum(axis=1), (p * p).sum(axis=1)
    d = qq[:, None] + pp[None, :] - 2.0 * (q @ p.T) + weight * _differing(qc, pc)
    top = np.abs(middle).max() if np.size(middle) else 0.0
    size = qq + pp.max(initial=0.0) + top * top * _EPS
    return d, _EPS * (8 * px.shape[1] + 16) * (size + weight * pc.shape[1])


def _exact(qx, qc, px, pc, weight: float) -> np.ndarray:
    """Squared distances of rows side by side, summed feature by feature; a differing category adds ``weight``."""
    d = np.zeros(len(qx))
    for j in range(px.shape[1]):
        gap = qx[:, j] - px[:, j]
        d += gap * gap
    for j in range(pc.shape[1]):
        d += weight * (qc[:, j] != pc[:, j])
    return d


def _first_of_each(r: np.ndarray, m: int) -> np.ndarray:
    """Mask of the first m entries of every run of equal values in sorted ``r``."""
    starts = np.concatenate([[True], r[1:] != r[:-1]]) if len(r) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(starts, np.arange(len(r)), 0)) if len(r) else r
    return (np.arange(len(r)) - begin) < m


def _nearest(qx, qc, pts: _Points, weight: float, m: int, theta: np.ndarray | None = None, apart: tuple | None = None):
    """The m nearest rows of each query: (query, squared distance, id), sorted by these.

    What can be among them is found with distances from a product of matrices and their error bound; only
    for these pairs distances are summed feature by feature, so ties are ties. Rows farther than ``theta`` of a query may
    be left out. ``apart`` numbers queries and rows; those of the same number are not compared.
    """
    rows, dists, ids = [], [], []
    for lo in range(0, len(qx), _CHUNK):
        q, c = qx[lo : lo + _CHUNK], qc[lo : lo + _CHUNK]
        d, off = _about(q, c, pts.x, pts.c, weight)
        near = np.ones_like(d, dtype=bool)
        if theta is not None:
            near = d <= (theta[lo : lo + _CHUNK] ** 2 * (1 + 1e-9) + 1e-12 + 2.0 * off)[:, None]
        if apart is not None:
            other = apart[0][lo : lo + _CHUNK, None] != apart[1][None, :]
            near &= other
            d = np.where(other, d, np.inf)
        if d.shape[1] > m and (theta is None or np.count_nonzero(near) > 4 * m * len(q)):
            edge = np.partition(d, m - 1, axis=1)[:, m - 1] + 2.0 * off
            near &= d <= edge[:, None]
        r, s = np.nonzero(near)
        v = _exact(q[r], c[r], pts.x[s], pts.c[s], weight)
        n = pts.off[s + 1] - pts.off[s]
        place = np.repeat(pts.off[s], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        r, v, i = np.repeat(r, n), np.repeat(v, n), pts.ids[place]
        order = np.lexsort((i, v, r))
        r, v, i = r[order], v[order], i[order]
        top = _first_of_each(r, m)
        rows.append(r[top] + lo)
        dists.append(v[top])
        ids.append(i[top])
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(a) if a else none for a in (rows, dists, ids))


# --- the operator ------------------------------------------------------------------


def _spots(base: DataFrame, m: int, everyone: bool) -> DataFrame:
    """One row per distinct vector with its m smallest ids.

    ``row_number() <= m`` is pruned before the shuffle as well as after it, so a
    frequent vector sends at most m rows per input task.
    """
    vector = Window.partitionBy("g", "x", "c").orderBy("id")
    heads = base.withColumn("_n", F.row_number().over(vector)).filter(F.col("_n") <= m)
    spots = heads.groupBy("g", "x", "c").agg(F.sort_array(F.collect_list(F.struct("id", "y"))).alias("p"))
    spots = spots.select("g", "x", "c", F.col("p.id").alias("ids"), F.col("p.y").alias("ys"), F.element_at("p.id", 1).alias("sid"))
    if everyone:
        return spots.withColumn("asked", F.lit(True))
    asked = base.groupBy("g", "x", "c").agg(F.max("asked").alias("asked"))
    return spots.join(asked, ["g", "x", "c"])


def _scan_broadcast(spots: DataFrame, m: int, weight: float) -> DataFrame:
    """All spots fit a broadcast (the caller counted them), so answers come with their labels and vectors."""
    local = spots.select("g", "sid", "x", "c", "ids", "ys").toPandas()
    groups = {}
    for g, pdf in local.groupby("g"):
        pts = _Points.of(pdf)
        spot = np.repeat(np.arange(len(pdf)), np.diff(pts.off))
        labels = np.array([y for ys in pdf["ys"] for y in ys], dtype=object)
        groups[g] = pts, {i: (s, y) for i, s, y in zip(pts.ids.tolist(), spot.tolist(), labels)}
    shared = spots.sparkSession.sparkContext.broadcast(groups)

    def scan(batches):
        for pdf in batches:
            for g, part in pdf.groupby("g"):
                pts, known = shared.value[g]
                r, d, i = _nearest(_matrix(part["x"]), _texts(part["c"]), pts, weight, m)
                found = [known[x] for x in i.tolist()]
                at = [s for s, _ in found]
                yield pd.DataFrame({
                    "sid": part["sid"].to_numpy()[r], "d2": d, "id": i, "y": [y for _, y in found], "x": list(pts.x[at]), "c": [list(t) for t in pts.c[at]],
                })

    asked = spots.filter("asked").select("g", "sid", "x", "c")
    spread = asked.repartition(spots.sparkSession.sparkContext.defaultParallelism, "sid")
    return spread.mapInPandas(scan, f"{_CANDIDATE}, y string, x array<double>, c array<string>")


@contextmanager
def _few_rows(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Arrow batches of few rows: a row holds the arrays of two cells."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _name(level: int, cell: str = "cell") -> Column:
    """A cell is named by its level and its pivot's spot; a root by its group."""
    return F.concat(F.lit(f"{level}:"), F.col(cell))


@dataclass
class _Tree:
    """``blocks``: a row per block with its ``team``, the arrays of its spots, and of those asked with their answers and bounds. ``nodes``: ``node``, ``parent``, ``x``, ``c``,
    ``radius``, ``rows``, ``leaf``."""

    blocks: DataFrame
    nodes: DataFrame
    depth: int


def _spread(spark: SparkSession, spots: int) -> int:
    """Partitions for the rows of Python tasks, which take long for their bytes."""
    return max(2 * spark.sparkContext.defaultParallelism, spots // (16 * GROUP_ROWS))


def _grow(spots: DataFrame, count: int, weight: float, m: int, block_rows: int, fanout: int) -> _Tree:
    """Cells of at most ``block_rows`` spots, the tree above them, and what each block answers by itself."""
    fields = "sid bigint, x array<double>, c array<string>, ids array<bigint>, asked boolean, team string, parent string, cell string, far double"
    names = [f.split()[0] for f in fields.split(", ")]
    none = F.lit(None).cast("string")
    now = spots.select("sid", "x", "c", "ids", "asked", none.alias("team"), none.alias("parent"), F.col("g").alias("cell"), F.lit(0.0).alias("far"))
    leaves, nodes, level = [], [], 0
    parts, buckets, team_rows = _spread(spots.sparkSession, count), F.lit(max(1, count // GROUP_ROWS)), max(TEAM_ROWS, block_rows)

    def deal_share(spots_of: pd.DataFrame, pivots_of: pd.DataFrame) -> pd.DataFrame:
        px, pc = _matrix(pivots_of["px"]), _texts(pivots_of["pc"])
        x, c = _matrix(spots_of["x"]), _texts(spots_of["c"])
        near = np.concatenate([_about(x[i : i + _CHUNK], c[i : i + _CHUNK], px, pc, weight)[0].argmin(axis=1) for i in range(0, len(x), _CHUNK)])
        # A pivot's own spot is its cell's centre.
        own = {s: i for i, s in enumerate(pivots_of["pivot"])}
        near = np.array([own.get(s, i) for s, i in zip(spots_of["sid"], near)])
        far = np.sqrt(_exact(x, c, px[near], pc[near], weight))
        return spots_of.assign(cell=pivots_of["pivot"].astype(str).to_numpy()[near], far=far)[names]

    def deal(spots_of: pd.DataFrame, pivots_of: pd.DataFrame) -> pd.DataFrame:
        pivots = dict(list(pivots_of.groupby(["of", "part"])))
        out = [deal_share(own, pivots[unit]) for unit, own in spots_of.groupby(["parent", "share"])]
        return pd.concat(out) if out else pd.DataFrame(columns=names)

    while True:
        centre = F.when(F.col("sid").cast("string") == F.col("cell"), F.struct("x", "c")) if level else F.lit(None).cast("struct<x:array<double>,c:array<string>>")
        cells = now.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"), F.sum(F.size("ids")).alias("rows"), F.max("parent").alias("parent"), F.max(centre).alias("centre")
        )
        open_ = (F.col("n") > block_rows) & ((F.col("radius") > 0) | F.lit(not level))
        # Cells that are no larger than a team are put together with those beside them, ``fanout`` at most.
        fits = F.col("n") <= team_rows
        beside = Window.partitionBy("parent").orderBy("centre.x", "cell").rowsBetween(Window.unboundedPreceding, -1)
        number = F.floor(F.coalesce(F.sum(F.when(fits, F.col("n"))).over(beside), F.lit(0)) / team_rows)
        here = F.concat_ws(":", F.lit(level), "parent", number) if level else _name(0)
        cells = stage(cells.withColumn("here", F.when(fits, here)))
        nodes.append(cells.select(
            _name(level).alias("node"), F.concat(F.lit(f"{level - 1}:"), "parent").alias("parent"), "centre.x", "centre.c", "radius", "rows", (~open_).alias("leaf")
        ))
        team = F.coalesce("team", "here").alias("team")
        large = cells.filter(open_).select("cell", "n", "here")
        some = not large.isEmpty()
        small = now.join(cells.filter(~open_).select("cell", "here"), "cell").withColumn("node", _name(level))
        leaves.append(small.select("sid", "x", "c", "ids", "asked", "node", F.coalesce(team, "node").alias("team")))
        if not some:
            break
        inside = now.join(large, "cell").select(F.col("cell").alias("parent"), "n", "sid", "x", "c", "ids", "asked", team)
        order = Window.partitionBy("parent").orderBy(F.xxhash64("sid", F.lit(level)), "sid")
        wanted = F.least(F.lit(fanout), F.ceil(2 * F.col("n") / block_rows))
        drawn = inside.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= fanout).filter(F.col("_n") <= wanted)
        # A cell that holds a large share of all spots is dealt by many tasks, and many small cells by one.
        shares = F.ceil(F.col("n") / DEALT_ROWS).cast("int")
        dealt = inside.withColumn("share", F.pmod(F.xxhash64("sid"), shares).cast("int")).withColumn("bucket", F.pmod(F.xxhash64("parent", "share"), buckets))
        pivots = drawn.select(
            F.col("parent").alias("of"), F.col("sid").alias("pivot"), F.col("x").alias("px"), F.col("c").alias("pc"),
            F.explode(F.sequence(F.lit(0), shares - 1)).alias("part"),
        ).withColumn("bucket", F.pmod(F.xxhash64("of", "part"), buckets))
        dealt, pivots = dealt.repartition(parts, "bucket"), pivots.repartition(parts, "bucket")
        now = stage(dealt.groupBy("bucket").cogroup(pivots.groupBy("bucket")).applyInPandas(deal, fields))
        level += 1

    def pack(pdf):
        out = []
        for node, own in pdf.groupby("node"):
            pts, ask = _Points.of(own), np.flatnonzero(own["asked"].to_numpy(bool))
            r, d, i = _nearest(pts.x[ask], pts.c[ask], pts, weight, m)
            worst = np.zeros(len(ask))
            np.maximum.at(worst, r, d)
            theta = np.where(np.bincount(r, minlength=len(ask)) >= m, np.sqrt(worst), np.inf)
            asks = pts.sid[ask]
            out.append((node, own["team"].iloc[0], pts.sid, pts.x.ravel(), pts.c.ravel(), pts.off, pts.ids, asks, pts.x[ask].ravel(), pts.c[ask].ravel(), theta, asks[r], d, i))
        return pd.DataFrame(out, columns=["node", "team", "sid", "x", "c", "off", "ids", "asks", "qx", "qc", "theta", "qsid", "d2", "id"])

    rows, table = leaves[0], nodes[0]
    for more, other in zip(leaves[1:], nodes[1:]):
        rows, table = rows.unionByName(more), table.unionByName(other)
    kind = (
        "node string, team string, sid array<bigint>, x array<double>, c array<string>, off array<bigint>, ids array<bigint>, asks array<bigint>, "
        "qx array<double>, qc array<string>, theta array<double>, qsid array<bigint>, d2 array<double>, id array<bigint>"
    )
    packed = rows.withColumn("bucket", F.pmod(F.xxhash64("node"), buckets)).repartition(parts, "bucket").groupBy("bucket")
    return _Tree(stage(packed.applyInPandas(pack, kind)), table, level)


def _bounded_nodes(tree: _Tree, weight: float, m: int) -> DataFrame:
    """The nodes with ``theta``: no asked spot below has its m-th row farther away; null if none is asked.

    A block of fewer than m rows takes its bound, ``reach``, from the cells beside it, by their centres, radii and rows.
    """

    def beside(pdf: pd.DataFrame) -> pd.DataFrame:
        x, c = _matrix(pdf["x"]), _texts(pdf["c"])
        d, off = _about(x, c, x, c, weight)
        radius, rows = pdf["radius"].to_numpy(), pdf["rows"].to_numpy()
        far = np.sqrt(np.maximum(d + off[:, None], 0.0)) + radius[None, :] + radius[:, None]
        order = np.argsort(far, axis=1)
        enough = (np.cumsum(rows[order], axis=1) >= m).argmax(axis=1)
        reach = far[np.arange(len(far)), order[np.arange(len(far)), enough]]
        reach[rows.sum() < m] = np.inf
        return pdf[["node"]].assign(reach=reach * (1 + 1e-9))

    found = tree.blocks.filter(F.size("theta") > 0).select("node", F.array_max("theta").alias("own"))
    nodes = tree.nodes.join(found, "node", "left")
    nodes = stage(nodes) if tree.depth > 1 else nodes
    few = nodes.filter((F.col("own") == float("inf")) & F.col("parent").isNotNull()).select("parent").distinct()
    near = nodes.join(few, "parent").select("parent", "node", "x", "c", "radius", "rows")
    reach = near.groupBy("parent").applyInPandas(beside, "node string, reach double")
    nodes = nodes.join(reach, "node", "left")
    nodes = nodes.withColumn("theta", F.when(F.col("own") == float("inf"), F.col("reach")).otherwise(F.col("own"))).drop("own")
    if tree.depth < 2:
        return nodes.withColumn("theta", F.when(F.col("leaf"), F.col("theta")).otherwise(float("inf")))
    nodes = stage(nodes)
    done = nodes.filter("leaf")
    above = done.select("parent", "theta")
    for level in reversed(range(tree.depth)):
        inner = nodes.filter(~F.col("leaf") & F.col("node").startswith(f"{level}:")).drop("theta")
        best = above.groupBy("parent").agg(F.max("theta").alias("theta")).withColumnRenamed("parent", "node")
        inner = stage(inner.join(best, "node", "left"))
        done = done.unionByName(inner)
        above = above.unionByName(inner.select("parent", "theta"))
    return done


def _block_pairs(nodes: DataFrame, depth: int, parts: int, weight: float) -> DataFrame:
    """Pairs of different blocks ``(a, b)`` such that a row of b can be an answer for a spot of a."""
    fields = F.struct("node", "leaf", "x", "c", "radius", F.coalesce("theta", F.lit(-1.0)).alias("theta"))
    below = nodes.filter("parent is not null").groupBy("parent").agg(F.collect_list(fields).alias("kids"))  # ``fanout`` at most
    same = nodes.filter("leaf").select(F.col("node").alias("parent"), F.array(fields).alias("kids"))
    kids = below.unionByName(same).select(
        "parent", "kids.node", "kids.leaf", F.flatten("kids.x").alias("x"), F.flatten("kids.c").alias("c"), "kids.radius", "kids.theta"
    )
    kids = stage(kids) if depth > 1 else kids

    def side(name: str) -> DataFrame:
        return kids.select(*[F.col(c).alias(name if c == "parent" else f"{name}_{c}") for c in kids.columns])

    def arrays(batch: pa.RecordBatch, name: str) -> tuple:
        """How many cells each row has, their names, coordinates and categories one by one, radii, bounds, and which are leaves."""
        n = pc.list_value_length(batch.column(f"{name}_node")).to_numpy()
        node, x, c, radius, theta, leaf = (batch.column(f"{name}_{k}").flatten() for k in ("node", "x", "c", "radius", "theta", "leaf"))
        x, c, radius, theta, leaf = (k.to_numpy(zero_copy_only=False) for k in (x, c, radius, theta, leaf))
        return n, node, x.reshape(len(node), -1).T.copy(), c.reshape(len(node), -1).T, radius, theta, leaf.astype(bool)

    def meet(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            na, a, ax, ac, ar, theta, leaf = arrays(batch, "a")
            nb, b, bx, bc, br, _, _ = arrays(batch, "b")
            sizes, a0, b0 = na.astype(np.int64) * nb, np.cumsum(na) - na, np.cumsum(nb) - nb
            block = np.cumsum(sizes) // MET
            for at in np.unique(block):
                row = np.flatnonzero(block == at)
                n = sizes[row]
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(row, n)
                i, j = a0[row] + place // nb[row], b0[row] + place % nb[row]
                asked = theta[i] >= 0
                i, j = i[asked], j[asked]
                d = np.zeros(len(i))
                for p, q in zip(ax, bx):
                    gap = p[i] - q[j]
                    d += gap * gap
                for p, q in zip(ac, bc):
                    d += weight * (p[i] != q[j])
                near = np.sqrt(d) - (ar[i] + br[j]) * (1 + 1e-9) <= theta[i] * (1 + 1e-9) + 1e-12
                i, j = i[near], j[near]
                found = pa.RecordBatch.from_arrays([a.take(pa.array(i)), b.take(pa.array(j))], names=["a", "b"])
                yield found.filter(pc.invert(pc.and_(pc.equal(found.column(0), found.column(1)), pa.array(leaf[i], pa.bool_()))))

    pairs = nodes.filter("parent is null and not leaf").select(F.col("node").alias("a"), F.col("node").alias("b"))
    for _ in range(depth):
        both = pairs.repartition(parts, "a", "b").join(side("a"), "a").join(side("b"), "b").drop("a", "b")
        with _few_rows(nodes.sparkSession):
            pairs = stage(both.mapInArrow(meet, "a string, b string"))
    return pairs


def _visits(tree: _Tree, nodes: DataFrame, pairs: DataFrame, count: int, weight: float, m: int) -> DataFrame:
    """Candidates that asked spots find in other blocks, for each team of blocks they visit the m best."""
    spark = tree.blocks.sparkSession
    parts = _spread(spark, count)
    calls = stage(pairs.join(tree.blocks.select(F.col("node").alias("b"), "team"), "b").select(F.col("a").alias("node"), "team").distinct())
    visits = min(TEAM_ROWS, max(2048, count // (2 * spark.sparkContext.defaultParallelism)))
    copies = calls.join(tree.blocks.select("node", F.size("asks").alias("n")), "node").groupBy("team").agg(F.ceil(F.sum("n") / visits).cast("int").alias("copies"))
    asks = tree.blocks.select("node", "asks", "qx", "qc", "theta").join(nodes.select("node", "reach"), "node")
    visitors = calls.join(copies, "team").withColumn("copy", F.pmod(F.xxhash64("node"), F.col("copies")).cast("int")).drop("copies").join(asks, "node")
    balls = nodes.select("node", F.col("x").alias("bx"), F.col("c").alias("bc"), "radius")
    hosts = tree.blocks.select("node", "team", "sid", "x", "c", "off", "ids").join(balls, "node").join(copies, "team")
    hosts = hosts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    def visit(come: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if come.empty or there.empty:
            return pd.DataFrame({"sid": [], "d2": [], "id": []})
        there = there.iloc[sorted(range(len(there)), key=lambda i: tuple(there["bx"].iloc[i]))]
        blocks = [_Points.packed(row) for _, row in there.iterrows()]
        ends, home = np.cumsum([len(p.sid) for p in blocks]), {node: i for i, node in enumerate(there["node"])}
        x, c, ids = np.concatenate([p.x for p in blocks]), np.concatenate([p.c for p in blocks]), np.concatenate([p.ids for p in blocks])
        sid, off = np.concatenate([p.sid for p in blocks]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.off) for p in blocks]))])
        block = np.repeat(np.arange(len(blocks)), np.diff(ends, prepend=0))
        bx, bc, radius = _matrix(there["bx"]), _texts(there["bc"]), there["radius"].to_numpy(float)
        sizes = [len(s) for s in come["asks"]]
        asks = np.concatenate(list(come["asks"])).astype(np.int64)
        qx, qc = np.concatenate(list(come["qx"])).reshape(len(asks), -1), np.concatenate(list(come["qc"])).reshape(len(asks), -1)
        theta, reach = np.concatenate(list(come["theta"])).astype(float), np.repeat(come["reach"].fillna(np.inf).to_numpy(float), sizes)
        theta = np.where(np.isfinite(theta), theta, reach)
        own = np.repeat([home.get(node, -1) for node in come["node"]], sizes)
        r, v, i = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        lo = 0
        while lo < len(blocks):
            begin = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, begin + SLAB_ROWS, "right")))
            go = np.flatnonzero(_reached(qx, qc, theta, own - lo, bx[lo:hi], bc[lo:hi], radius[lo:hi], weight))
            if len(go):
                at = slice(begin, ends[hi - 1])
                slab = _Points(sid[at], x[at], c[at], off[begin : ends[hi - 1] + 1], ids)
                fr, fv, fi = _nearest(qx[go], qc[go], slab, weight, m, theta[go], (own[go], block[at]))
                r, v, i = np.concatenate([r, go[fr]]), np.concatenate([v, fv]), np.concatenate([i, fi])
                order = np.lexsort((i, v, r))
                r, v, i = r[order], v[order], i[order]
                top = _first_of_each(r, m)
                r, v, i = r[top], v[top], i[top]
                n = np.bincount(r, minlength=len(asks))
                full = n >= m
                theta[full] = np.minimum(theta[full], np.sqrt(v[np.cumsum(n)[full] - 1]))
            lo = hi
        return pd.DataFrame({"sid": asks[r], "d2": v, "id": i})

    visitors, hosts = visitors.repartition(parts, "team", "copy"), hosts.repartition(parts, "team", "copy")
    return visitors.groupBy("team", "copy").cogroup(hosts.groupBy("team", "copy")).applyInPandas(visit, _CANDIDATE)


def _reached(qx, qc, theta, own, bx, bc, radius, weight: float) -> np.ndarray:
    """Whether a query's bound reaches into one of the balls; ``own`` is the number of the one it comes from."""
    out = []
    for lo in range(0, len(qx), 8 * _CHUNK):
        at = slice(lo, lo + 8 * _CHUNK)
        d, off = _about(qx[at], qc[at], bx, bc, weight)
        gap = np.sqrt(np.maximum(d - off[:, None], 0.0)) - radius[None, :] * (1 + 1e-9)
        home = np.flatnonzero((own[at] >= 0) & (own[at] < len(bx)))
        gap[home, own[at][home]] = np.inf
        out.append(((gap <= theta[at, None] * (1 + 1e-9) + 1e-12) & (gap < np.inf)).any(axis=1))
    return np.concatenate(out)


def _scan_tree(spots: DataFrame, count: int, m: int, weight: float, block_rows: int, fanout: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, the nodes of the tree, and the pairs of blocks that were visited."""
    tree = _grow(spots, count, weight, m, max(block_rows, 2 * m), fanout)
    found = tree.blocks.select(F.explode(F.arrays_zip("qsid", "d2", "id")).alias("_c")).select(F.col("_c.qsid").alias("sid"), "_c.d2", "_c.id")
    if not tree.depth:
        return found, tree.nodes, tree.blocks.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    nodes = stage(_bounded_nodes(tree, weight, m))
    pairs = _block_pairs(nodes, tree.depth, _spread(spots.sparkSession, count), weight)
    return found.unionByName(_visits(tree, nodes, pairs, count, weight, m)), nodes, pairs


def _prepared(df, ident, features, k, label, within_label, nominal, queries) -> tuple[DataFrame, DataFrame]:
    """The rows in the columns of the plan, and their spots."""
    if len(features) == 1 and df.schema[features[0]].dataType.typeName() == "array":
        vector = F.col(features[0]).cast("array<double>")
    else:
        vector = F.array(*[F.col(f).cast("double") for f in features])
    y = F.col(label).cast("string") if label else F.lit("")
    base = df.select(
        F.col(ident).cast("bigint").alias("id"),
        y.alias("y"),
        (F.coalesce(y, F.lit("")) if within_label else F.lit("")).alias("g"),
        vector.alias("x"),
        F.array(*[F.col(n).cast("string") for n in nominal]).cast("array<string>").alias("c"),
        (queries if queries is not None else F.lit(True)).alias("asked"),
    )
    return base, stage(_spots(base, k + 1, queries is None))


def nearest_neighbors(
    df: DataFrame,
    ident: str,
    features: list[str],
    k: int,
    label: str | None = None,
    within_label: bool = False,
    nominal: list[str] | None = None,
    nominal_weight: float = 0.0,
    queries: Column | None = None,
    rows: bool = True,
    broadcast_spots: int = BROADCAST_SPOTS,
    block_rows: int = BLOCK_ROWS,
    fanout: int = FANOUT,
) -> DataFrame:
    """``(ident, x, c, neighbors)`` for every row, or for the rows of ``queries``.

    ``neighbors`` is an array of ``(d2, id, y, x, c)`` ordered by distance and id: at
    most k rows other than the row itself, fewer only when its group has fewer. Without ``rows`` it
    holds ``(d2, id)`` alone, which saves a join.
    ``x`` are the features as doubles, ``c`` the nominal ones. A single feature of
    array type is used as the vector itself. With ``within_label`` only rows of the
    same label are compared. Features are used unscaled and must not be null; the
    identifier must be a unique whole number.
    """
    spark = df.sparkSession
    ship_package(spark)
    m = k + 1
    base, spots = _prepared(df, ident, features, k, label, within_label, nominal or [], queries)
    size = spots.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("x") + F.size("c") + F.size("ids")).alias("values")).first()
    fields = ["d2", "id", "y", "x", "c"] if rows else ["d2", "id"]

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("sid").orderBy("d2", "id")
        return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= m)

    def answers(found: DataFrame) -> DataFrame:
        return found.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("found"))

    if size["n"] <= broadcast_spots and (size["values"] or 0) <= BROADCAST_VALUES:
        answer = answers(best(_scan_broadcast(spots, m, nominal_weight)))
    else:
        with scratch(spark) as last:
            found = best(_scan_tree(spots, size["n"], m, nominal_weight, block_rows, fanout)[0]).select("sid", "d2", "id")
            answer = last(answers(found.join(base.select("id", "y", "x", "c"), "id") if rows else found))
    # A frequent vector makes this join skewed on the row side; adaptive execution
    # splits that side, and the answer side has one row per vector.
    keyed = spots.filter("asked").select(F.col("g").alias("_g"), F.col("x").alias("_x"), F.col("c").alias("_c"), "sid").join(answer, "sid")
    joined = base.filter("asked").join(
        keyed, (F.col("g") == F.col("_g")) & (F.col("x") == F.col("_x")) & (F.col("c") == F.col("_c"))
    )
    others = F.slice(F.filter("found", lambda n: n["id"] != F.col("id")), 1, k)
    return joined.select(F.col("id").alias(ident), "x", "c", others.alias("neighbors"))


def visited_share(
    df: DataFrame, ident: str, features: list[str], k: int, block_rows: int = BLOCK_ROWS, fanout: int = FANOUT
) -> DataFrame:
    """How much the tree prunes: ``blocks``, ``pairs`` of different blocks that are visited, and their ``share`` of all."""
    ship_package(df.sparkSession)
    with scratch(df.sparkSession) as last:
        _, spots = _prepared(df, ident, features, k, None, False, [], None)
        _, nodes, pairs = _scan_tree(spots, spots.count(), k + 1, 0.0, block_rows, fanout)
        blocks = nodes.filter("leaf").agg(F.count(F.lit(1)).alias("blocks"))
        both = last(blocks.withColumn("pairs", pairs.agg(F.count(F.lit(1))).scalar()))
    all_pairs = F.greatest(F.col("blocks") * (F.col("blocks") - 1), F.lit(1))
    return both.withColumn("share", F.col("pairs") / all_pairs)


def neighbor_rows(neighbors: DataFrame, ident: str) -> DataFrame:
    """One row per neighbour: ``(ident, rank, nn_id, distance)``."""
    return neighbors.select(ident, F.posexplode("neighbors").alias("_p", "_n")).select(
        ident,
        (F.col("_p") + 1).alias("rank"),
        F.col("_n.id").alias("nn_id"),
        F.sqrt("_n.d2").alias("distance"),
    )
