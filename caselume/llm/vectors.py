"""Near-duplicate embeddings by a robust-pruned flat graph on overlapping shards.

Centres fitted on a bounded sample deal the vectors into shards; a vector lives in its nearest
shard and is copied into others that are almost as near, so that shards overlap. In each shard
every vector gets neighbours by robust pruning: of its candidates one is dropped if a
kept one is much nearer to it. The lists of a vector's copies are joined: a copy knows
in which other shards its vector has neighbours. All vectors are then searched for, block by block: from a shard's
medoid (and the query's own place) a greedy search expands the nearest nodes, and
once inside the range all nodes in it. Where it meets a vector that lives in another shard, the query goes
on there in the next round, until no query goes on. Every link is checked by its cosine in double precision.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import components, group_bounds, small_batches, stage, staged_map, trimmed, whole_groups

#: Vectors that centres are fitted on at most; vectors in a shard on average, and at most before it is dealt out by hash.
SAMPLE, SHARD, LARGE_SHARD = 20_000, 600, 3_000
#: Centres of one level; where more are needed, large shards are dealt again by centres of their own.
CENTRES = 2_000
#: Vectors that one task deals to the centres of their shard, queries of one block, vectors of an audit's or an exact comparison's block.
PIECE, BLOCK, COMPARED = 20_000, 4_096, 2_048
#: Copies of a vector, and how much farther (in cosine) than the nearest a centre may be.
COPIES, SLACK = 3, 0.15
#: Neighbours kept, candidates looked at, how much nearer a kept one must be, width of the greedy search.
DEGREE, CANDIDATES, ALPHA, BEAM = 24, 64, 1.2, 16
QUERIES = 256


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def fit_centres(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on a bounded sample; starts are spread by a fixed draw."""
    draw = np.random.default_rng(11)
    centres = sample[draw.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(sample[i : i + 2048] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], centres)
    return centres


def robust_prune(sim: np.ndarray, candidates: np.ndarray, among: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Of ``candidates`` (positions, nearest first; ``sim`` to the vector, ``among`` between them) those to keep."""
    away = np.maximum(0.0, 1 - sim)
    alive = np.ones(len(candidates), bool)
    kept = []
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            # A candidate much nearer to a kept one is reached through it.
            alive &= alpha * np.maximum(0.0, 1 - among[i]) > away
    return candidates[kept]


def build_graph(x: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES) -> tuple[np.ndarray, int]:
    """Neighbours of each row (padded with -1), and the medoid. The graph is connected in both directions."""
    n = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    lists: list[set[int]] = [set() for _ in range(n)]
    draw = np.random.default_rng(n)
    for start in range(0, n, QUERIES):
        sims = x[start : start + QUERIES] @ x.T
        k = min(candidates, n - 1)
        near = np.argpartition(-sims, k, axis=1)[:, : k + 1]
        far = draw.integers(0, n, (len(sims), 8))  # long edges, so that far parts are reached
        for r in range(len(sims)):
            i = start + r
            c = np.unique(np.concatenate([near[r], far[r], [medoid]]))
            c = c[c != i]
            c = c[np.lexsort((c, -sims[r, c]))]
            for j in robust_prune(sims[r, c], c, x[c] @ x[c].T, degree).tolist():
                lists[i].add(j)
                lists[j].add(i)
    for i in range(n):
        if not lists[i] and n > 1:
            lists[i].add(medoid)
            lists[medoid].add(i)
    out = np.full((n, max(1, max(map(len, lists), default=1))), -1, np.int64)
    for i, own in enumerate(lists):
        out[i, : len(own)] = sorted(own)
    return out, medoid


def range_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, starts: np.ndarray, least: float, beam: int = BEAM) -> np.ndarray:
    """For each query the rows found with cosine ``least`` or more, as a matrix of booleans.

    Greedy until the ``beam`` nearest nodes seen are expanded, then on as long as nodes in range are not.
    """
    m, n = len(queries), len(x)
    sims = np.full((m, n), -np.inf)  # of nodes that were seen
    done = np.zeros((m, n), bool)
    rows = np.arange(m)
    for s in starts.T:
        ok = s >= 0
        sims[rows[ok], s[ok]] = np.einsum("ij,ij->i", queries[ok], x[s[ok]])
    active = rows
    while len(active):
        open_ = np.where(done[active], -np.inf, sims[active])
        k = min(4, n)
        best = np.argpartition(-open_, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(open_, best, axis=1)
        edge = np.partition(sims[active], n - min(beam, n), axis=1)[:, n - min(beam, n)]
        go = (value > -np.inf) & ((value >= edge[:, None]) | (value >= least))
        active, best, go = active[go.any(axis=1)], best[go.any(axis=1)], go[go.any(axis=1)]
        if not len(active):
            break
        q, at = np.nonzero(go)
        done[active[q], best[q, at]] = True
        reached = graph[best[q, at]]
        query = np.repeat(active[q], reached.shape[1])
        node = reached.ravel()
        new = node >= 0
        query, node = query[new], node[new]
        code = np.unique(query * n + node)
        query, node = code // n, code % n
        new = sims[query, node] == -np.inf
        query, node = query[new], node[new]
        sims[query, node] = np.einsum("ij,ij->i", queries[query], x[node])
    return sims >= least


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _deal(spark: SparkSession, centres: np.ndarray, copies: int, slack: float):
    sent = spark.sparkContext.broadcast(centres)  # of one level: CENTRES rows at most

    def run(batches):
        c = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            near = unit(_matrix(b.column("v"))) @ c.T
            order = np.argsort(-near, axis=1, kind="stable")[:, :copies]
            value = np.take_along_axis(near, order, axis=1)
            q, k = np.nonzero(value >= value[:, :1] - slack)
            take = pa.array(q)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(take), b.column("v").take(take), b.column("n").take(take), pa.array(order[q, k].astype(np.int64)), pa.array(k == 0)],
                names=["id", "v", "n", "shard", "home"],
            )

    return run


def _graphs(batches):
    """Shards, sorted by (shard, part, id), with their graphs: neighbours are positions in that order."""
    for t in whole_groups(batches, ["shard", "part"], LARGE_SHARD):
        x = unit(_matrix(t.column("v")))
        bounds = group_bounds(t.column("shard").to_numpy(), t.column("part").to_numpy())
        near, middle = [], np.zeros(len(x), bool)
        for a, z in zip(bounds[:-1], bounds[1:]):
            graph, medoid = build_graph(x[a:z])
            middle[a + medoid] = True
            near += [g[g >= 0].tolist() for g in graph]
        for i in range(0, len(x), 1000):
            part = t.slice(i, 1000)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).combine_chunks() for c in ("shard", "part", "id", "v", "n", "home")), pa.array(near[i : i + 1000], pa.list_(pa.int64())), pa.array(middle[i : i + 1000])],
                names=["shard", "part", "id", "v", "n", "home", "near", "medoid"],
            )


def _search(least: float):
    """Nodes and a block of queries of a shard to counts, next shards and a forest of links."""

    def run(batches):
        for t in whole_groups(batches, ["shard", "part", "block"], 1):
            bounds = group_bounds(*[t.column(k).to_numpy() for k in ("shard", "part", "block")])
            for a, z in zip(bounds[:-1], bounds[1:]):
                group = t.slice(a, z - a).combine_chunks()
                asked = group.column("asked").to_numpy(zero_copy_only=False)
                split = int(np.searchsorted(asked, True))  # the nodes come first
                g, queries = group.slice(0, split).combine_chunks(), group.slice(split).combine_chunks()
                if not g.num_rows or not queries.num_rows:
                    continue
                near = g.column("near").to_pylist()
                graph = np.full((len(near), max(1, max(map(len, near)))), -1, np.int64)
                for i, own in enumerate(near):
                    graph[i, : len(own)] = own
                nodes = (
                    g.column("id").to_numpy(), unit(_matrix(g.column("v"))), graph, g.column("n").to_numpy(), np.array(g.column("home").to_pylist(), bool),
                    int(np.flatnonzero(np.array(g.column("medoid").to_pylist(), bool))[0]), g.column("homes").to_pylist(),
                )
                yield from _answer(nodes, queries, least)

    return run


def _answer(nodes, g, least: float):
    ids, x, graph, weight, home, medoid, homes = nodes
    asked = g.column("id").to_numpy()
    queries = unit(_matrix(g.column("v")))
    for i in range(0, len(asked), QUERIES):
        q = asked[i : i + QUERIES]
        own = np.minimum(np.searchsorted(ids, q), len(ids) - 1)
        own = np.where(ids[own] == q, own, -1)
        hit = range_search(x, graph, queries[i : i + QUERIES], np.stack([np.full(len(q), medoid), own], axis=1), least)
        hit[np.flatnonzero(own >= 0), own[own >= 0]] = False
        count = (hit & home) @ weight
        # Links as a forest of queries and nodes: as many rows as there are of both, at most.
        root: dict[int, int] = {}

        def find(a):
            while root.setdefault(a, a) != a:
                root[a] = root[root[a]]
                a = root[a]
            return a

        further: list[list[int]] = []
        for r in range(len(q)):
            at = np.flatnonzero(hit[r])
            out = set()
            if len(at):
                a = find(int(q[r]))
                for j in at.tolist():
                    b = find(int(ids[j]))
                    if a != b:
                        a, b = min(a, b), max(a, b)
                        root[b] = a
                for j in at.tolist():
                    out.update(homes[j])
            further.append(sorted(out))
        edges = [(k, find(k)) for k in root]
        edges = [(a, b) for a, b in edges if a != b]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([q, np.array([a for a, _ in edges], np.int64)])), pa.array(np.concatenate([count, np.zeros(len(edges), count.dtype)]).astype(np.int64)),
                pa.array([*further, *[[]] * len(edges)], pa.list_(pa.int64())), pa.array([*[None] * len(q), *[b for _, b in edges]], pa.int64()),
            ],
            names=["id", "found", "further", "root"],
        )


def near_vectors(vectors: DataFrame, least: float = 0.9, audit: int = 20, goal: float = 0.99, attempts: int = 2) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each row of ``vectors`` (``vec_id``, ``embedding``).

    ``n_links`` counts other rows at cosine ``least`` or more that the search found, copies included;
    ``component_id`` is the smallest ``vec_id`` reachable by links, itself included, and ``kept`` says that it is the row's own. A vector
    that is null, empty, zero or has a null or non-finite component links with nothing, nor does one with a null ``vec_id``
    (``kept`` is then null); vectors of different length never link. Copies of a vector are searched for once. Repeated rows
    stay and count as copies. Other columns are not read.

    After the search the vectors whose id is divisible by ``audit`` are compared with all others, in blocks; if the mean share of
    their links that were found is less than ``goal``, it is done again with more copies and a wider overlap, and after ``attempts``
    all vectors are compared with each other in blocks, whose work grows with the square of their number, so
    that no result of a lower recall is given.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    good = "v is not null and size(v) > 0 and vec_id is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)"
    rows = stage(rows.withColumn("usable", F.coalesce(F.expr(good), F.lit(False))))
    different = stage(rows.filter("usable").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")))
    found = None
    for size in [r[0] for r in different.select(F.size("v")).distinct().collect()]:  # mostly one
        own = different.filter(F.size("v") == size)
        for attempt in range(attempts):
            result = _search_all(own, least, COPIES * (1 + attempt), SLACK * (1 + attempt))
            if _recall(own, result, least, audit) >= goal:
                break
        else:
            result = _compare_all(own, least)
        found = result if found is None else tuple(a.union(b) for a, b in zip(found, result))
    lone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return lone.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    counts, edges = found
    roots = components(edges).withColumnsRenamed({"node": "id"})
    known = different.join(counts, "id", "left").join(roots, "id", "left").select(
        "v", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    linked = rows.filter("usable").join(known, "v").select("vec_id", "n_links", "component_id")
    return linked.union(lone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _search_all(vectors: DataFrame, least: float, copies: int, slack: float) -> tuple[DataFrame, DataFrame]:
    """Counts (``id``, ``found``) and links as a forest (``a``, ``b``)."""
    spark = vectors.sparkSession
    total = vectors.count()
    # A bounded, documented sample: the SAMPLE vectors with the smallest hash of their id.
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    k = max(1, min(CENTRES, total // SHARD, sample.num_rows))
    centres = fit_centres(unit(_matrix(sample.column("v"))), k)
    kind = "id long, v array<double>, n long, shard long, home boolean"
    dealt = staged_map(vectors.select("id", "v", "n"), _deal(spark, centres, copies, slack), kind, 2000)
    reach = CENTRES
    while total // SHARD > reach:
        dealt, reach = _deal_again(dealt, copies, slack), reach * CENTRES
    # What is still large, such as a crowd of vectors that are almost the same, is dealt out by hash and searched in all its parts.
    sizes = stage(dealt.groupBy("shard").agg(F.count("*").alias("size"))).select("shard", F.ceil(F.col("size") / LARGE_SHARD).cast("int").alias("parts"))
    placed = stage(dealt.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")))
    with small_batches(spark, 1000):
        graphs = stage(
            placed.select("shard", "part", "id", "v", "n", "home").repartition("shard", "part").sortWithinPartitions("shard", "part", "id")
            .mapInArrow(trimmed(_graphs), "shard long, part int, id long, v array<double>, n long, home boolean, near array<bigint>, medoid boolean")
        )
    # The lists of a vector's copies, joined: from each copy the search may go on in every shard that has one.
    homes = graphs.groupBy("id").agg(F.collect_set("shard").alias("homes"))
    graphs = stage(graphs.join(homes, "id"))
    parts = sizes.select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # A query begins in every shard that has a copy of it.
    asked = placed.select("id", "v", "shard")
    visits = asked.select("id", "shard")
    answers = None
    while True:
        queries = asked.join(parts, "shard").select("shard", "part", "id", "v")
        # The nodes of a part go to each block of its queries.
        load = queries.groupBy("shard", "part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        queries = queries.join(load, ["shard", "part"]).select(
            "shard", "part", "id", "v", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int").alias("block"), F.lit(True).alias("asked")
        )
        nodes = graphs.join(load, ["shard", "part"]).select(
            "shard", "part", "id", "v", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("asked"), "n", "home", "near", "medoid", "homes"
        )
        both = nodes.unionByName(queries, allowMissingColumns=True)
        with small_batches(spark, 1000):
            now = stage(
                both.repartition("shard", "part", "block").sortWithinPartitions("shard", "part", "block", "asked", "id")
                .select("shard", "part", "block", "asked", "id", "v", "n", "home", "near", "medoid", "homes")
                .mapInArrow(trimmed(_search(least)), "id long, found long, further array<bigint>, root long")
            )
        answers = now if answers is None else answers.union(now)
        next_ = now.filter("root is null").select("id", F.explode("further").alias("shard")).distinct()
        next_ = stage(next_.join(visits, ["id", "shard"], "left_anti"))
        if next_.isEmpty():
            break
        visits = stage(visits.union(next_))
        asked = next_.join(vectors.select("id", "v"), "id")
    counts = answers.filter("root is null").groupBy("id").agg(F.sum("found").alias("found"))
    return stage(counts), stage(answers.filter("root is not null").select(F.col("id").alias("a"), F.col("root").alias("b")))


def _deal_again(dealt: DataFrame, copies: int, slack: float) -> DataFrame:
    """Shards of more than ``LARGE_SHARD`` vectors dealt by centres of their own; others keep their vectors under a new number.

    Centres are fitted in a task for each shard, on a quarter of ``SAMPLE`` vectors at most, those with the smallest hashes.
    """
    spark = dealt.sparkSession
    sizes = stage(dealt.groupBy("shard").agg(F.count("*").alias("size"))).filter(F.col("size") > LARGE_SHARD)
    first = Window.partitionBy("shard").orderBy(F.xxhash64("id", F.lit(5)), "id")
    pieces = F.ceil(F.col("size") / PIECE).cast("int")
    large = dealt.join(sizes, "shard").withColumn("piece", F.pmod(F.xxhash64("id"), pieces).cast("int"))
    drawn = large.filter("home").withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= SAMPLE // 4)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.array(pdf["v"].tolist(), float))
        k = max(1, min(CENTRES, int(pdf["size"].iloc[0]) // SHARD, len(x)))
        return pd.DataFrame({"of": [pdf["shard"].iloc[0]], "centres": [fit_centres(x, k).ravel()], "pieces": [-(-int(pdf["size"].iloc[0]) // PIECE)]})

    fitted = stage(drawn.select("shard", "size", "v").groupBy("shard").applyInPandas(fit, "of long, centres array<double>, pieces int"))
    fitted = fitted.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))

    def deal(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or around.empty:
            return pd.DataFrame(columns=["id", "v", "n", "shard", "home"])
        x = unit(np.array(rows["v"].tolist(), float))
        near = x @ np.asarray(around["centres"].iloc[0], float).reshape(-1, x.shape[1]).T
        order = np.argsort(-near, axis=1, kind="stable")[:, :copies]
        value = np.take_along_axis(near, order, axis=1)
        q, k = np.nonzero(value >= value[:, :1] - slack)
        out = rows.iloc[q][["id", "v", "n", "shard", "home"]]
        return out.assign(shard=out["shard"] * CENTRES + order[q, k], home=out["home"].to_numpy(bool) & (k == 0))

    kind = "id long, v array<double>, n long, shard long, home boolean"
    again = large.select("id", "v", "n", "shard", "home", "piece").groupBy("shard", "piece").cogroup(fitted.groupBy("of", "part")).applyInPandas(deal, kind)
    rest = dealt.join(sizes, "shard", "left_anti").select("id", "v", "n", (F.col("shard") * CENTRES).alias("shard"), "home")
    # A vector has one home, and one copy in a shard, though its copies may have been dealt to neighbours of each other.
    return stage(again.unionByName(rest).groupBy("id", "shard").agg(F.first("v").alias("v"), F.first("n").alias("n"), F.max("home").alias("home")).select("id", "v", "n", "shard", "home"))


def _compare_all(vectors: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Exact counts and links as a forest: every vector with every other, in pairs of blocks of about ``COMPARED``."""
    spark = vectors.sparkSession
    blocks = max(1, -(-vectors.count() // COMPARED))
    own = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(blocks)).cast("int")
    met = vectors.select("id", "v", "n", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("with"))
    met = met.select(F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "id", "v", "n")

    def run(batches):
        for t in whole_groups(batches, ["i", "j"], 1):
            bounds = group_bounds(*[t.column(k).to_numpy() for k in ("i", "j")])
            for a, z in zip(bounds[:-1], bounds[1:]):
                g = t.slice(a, z - a).combine_chunks()
                ids, n, side = (g.column(c).to_numpy() for c in ("id", "n", "own"))
                x = unit(_matrix(g.column("v")))
                low = side == side.min()
                left, right = (np.flatnonzero(low), np.flatnonzero(~low)) if (~low).any() else (np.arange(len(ids)),) * 2
                if not (~low).any() and g.column("i")[0].as_py() != g.column("j")[0].as_py():
                    continue  # the other block is empty
                hit = x[left] @ x[right].T >= least
                hit &= ids[left][:, None] != ids[right][None, :]
                found = np.zeros(len(ids), np.int64)
                found[left] += hit @ n[right]
                if (~low).any():
                    found[right] += hit.T @ n[left]
                # Of a row's links one to each part suffices: a star for every row, joined to what it meets first.
                r, c = np.nonzero(hit)
                edges = _forest(ids[left][r], ids[right][c])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids, edges[:, 0]])), pa.array(np.concatenate([found, np.zeros(len(edges), np.int64)])), pa.array([*[None] * len(ids), *edges[:, 1].tolist()], pa.int64())],
                    names=["id", "found", "root"],
                )

    with small_batches(spark, 1000):
        done = stage(met.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(trimmed(run), "id long, found long, root long"))
    counts = done.filter("root is null").groupBy("id").agg(F.sum("found").alias("found"))
    return stage(counts), stage(done.filter("root is not null").select(F.col("id").alias("a"), F.col("root").alias("b")))


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links (a, b) reduced to (node, smallest node of its part)."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, a, b = np.arange(len(names)), at[: len(a)], at[len(a) :]
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    keep = root != np.arange(len(names))
    return np.stack([names[keep], names[root[keep]]], axis=1)


def _recall(vectors: DataFrame, result: tuple[DataFrame, DataFrame], least: float, audit: int) -> float:
    """Mean share of the true links that were counted, over the vectors whose id is divisible by ``audit`` and that have links.

    They meet all rows, a block of them at a time. 1 if none of them has a link.
    """
    spark = vectors.sparkSession
    asked = vectors.filter(F.col("id") % audit == 0).select("id", "v")
    blocks, true = -(-asked.count() // (8 * COMPARED)), []
    for block in range(blocks):
        some = asked.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)) == block).toArrow()  # 8 * COMPARED rows on average
        if not some.num_rows:
            continue
        sent = spark.sparkContext.broadcast((some.column("id").to_numpy(), unit(_matrix(some.column("v")))))

        def run(batches, sent=sent):
            ids, q = sent.value
            total = np.zeros(len(ids), np.int64)
            for b in batches:
                if b.num_rows:
                    x, own = unit(_matrix(b.column("v"))), b.column("id").to_numpy()
                    for i in range(0, len(ids), COMPARED):
                        hit = (q[i : i + COMPARED] @ x.T >= least) & (ids[i : i + COMPARED, None] != own[None, :])
                        total[i : i + COMPARED] += hit @ b.column("n").to_numpy()
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(total[some])], names=["id", "true"])

        true.append(staged_map(vectors.select("id", "v", "n"), run, "id long, true long", 2000))
    if not true:
        return 1.0
    sums = reduce(DataFrame.union, true).groupBy("id").agg(F.sum("true").alias("true"))
    share = F.least("true", F.coalesce("found", F.lit(0))) / F.col("true")
    got = sums.join(result[0], "id", "left").agg(F.avg(share).alias("mean")).first()
    return 1.0 if got["mean"] is None else got["mean"]
