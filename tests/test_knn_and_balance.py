import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselume.operators import balance, knn

SCALED = {"broadcast_spots": 0, "block_rows": 40, "fanout": 5}


def brute(x, ids, k, labels=None, cats=None, weight=0.0):
    out = {}
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        if cats is not None:
            d = d + weight * (np.array(cats) != cats[i])
        near = sorted((d[j], ids[j]) for j in range(len(x)) if j != i and (labels is None or labels[j] == labels[i]))
        out[ids[i]] = near[:k]
    return out


def answers(df, ident="id"):
    return {r[ident]: [(n["d2"], n["id"]) for n in r["neighbors"]] for r in df.collect()}


@pytest.fixture(scope="module")
def cloud(spark):
    """A third of the rows are copies of one point, the rest is grid and noise."""
    rng = np.random.default_rng(1)
    x = np.vstack([np.full((150, 2), 5.0), rng.integers(0, 9, (150, 2)), rng.normal(40, 8, (150, 2)).round()])
    ids = rng.permutation(len(x)).tolist()
    y = rng.integers(0, 2, len(x)).tolist()
    c = rng.choice(["p", "q", "r"], len(x)).tolist()
    rows = [(int(i), float(a), float(b), int(l), str(s)) for i, (a, b), l, s in zip(ids, x, y, c)]
    return x.astype(float), ids, y, c, spark.createDataFrame(rows, "id long, a double, b double, y int, c string")


@pytest.mark.parametrize("plan", [{}, SCALED], ids=["broadcast", "partitioned"])
@pytest.mark.parametrize("same", [False, True])
def test_neighbours_equal_brute_force(cloud, plan, same):
    x, ids, y, _, df = cloud
    got = answers(knn.nearest_neighbors(df, "id", ["a", "b"], 4, "y", within_label=same, **plan))
    assert got == brute(x, ids, 4, y if same else None)


@pytest.mark.parametrize("plan", [{}, SCALED], ids=["broadcast", "partitioned"])
def test_mixed_distance_equals_brute_force(cloud, plan):
    x, ids, _, c, df = cloud
    got = answers(knn.nearest_neighbors(df, "id", ["a", "b"], 3, nominal=["c"], nominal_weight=2.0, **plan))
    assert got == brute(x, ids, 3, cats=c, weight=2.0)


@pytest.mark.parametrize("plan", [{}, SCALED], ids=["broadcast", "partitioned"])
def test_only_asked_rows_are_answered(cloud, plan):
    x, ids, y, _, df = cloud
    got = answers(knn.nearest_neighbors(df, "id", ["a", "b"], 4, "y", queries=F.col("y") == 1, **plan))
    want = brute(x, ids, 4)
    assert got == {i: want[i] for i, l in zip(ids, y) if l == 1}


def test_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id long, a double")
    for plan in ({}, SCALED):
        assert answers(knn.nearest_neighbors(df, "id", ["a"], 5, **plan)) == {1: [(1.0, 2)], 2: [(1.0, 1)]}


@pytest.fixture(scope="module")
def line(spark):
    pts = [(1, 0.0, 0), (6, 0.2, 0), (7, -0.3, 0), (2, 1.0, 0), (3, 1.4, 1), (4, 5.0, 1), (5, 5.2, 1)]
    return spark.createDataFrame(pts, "id long, v double, y int")


def test_tomek_link_and_removal(line):
    links = balance.tomek_links(line, "id", ["v"], "y").collect()
    assert [(r["a"], r["b"]) for r in links] == [(2, 3)]
    left = balance.remove_tomek(line, "id", ["v"], "y")
    assert sorted(r["id"] for r in left.collect()) == [1, 3, 4, 5, 6, 7]


def test_editing_all_or_only_larger_classes(line):
    every = balance.edited_neighbors(line, "id", ["v"], "y")
    votes = {r["id"] for r in every.collect()}
    assert 3 not in votes
    kept = balance.edited_neighbors(line, "id", ["v"], "y", classes="not_minority")
    assert 3 in {r["id"] for r in kept.collect()}


def test_smote_small_class_falls_back_to_fewer_neighbours(line):
    out = balance.smote(line, "id", ["v"], "y").collect()
    new = [r for r in out if r["is_synthetic"]]
    assert len(out) == 8 and len(new) == 1
    assert new[0]["y"] == 1 and 1.4 <= new[0]["v"] <= 5.2 and new[0]["id"] < 0


def test_smote_copies_a_class_of_one(spark):
    df = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 0), (3, 2.0, 0), (4, 9.0, 1)], "id long, v double, y int")
    new = balance.smote(df, "id", ["v"], "y").filter("is_synthetic").collect()
    assert [(r["v"], r["y"]) for r in new] == [(9.0, 1)] * 2


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(b), 0, "m" if i % 3 else "n") for i, (a, b) in enumerate(rng.normal(0, 1, (120, 2)).round(2))]
    rows += [(200 + i, float(a), float(b), 1, "n") for i, (a, b) in enumerate(rng.normal(1.5, 1, (25, 2)).round(2))]
    rows += [(300 + i, float(a), float(b), 2, "m") for i, (a, b) in enumerate(rng.normal(-2, 1, (60, 2)).round(2))]
    return spark.createDataFrame(rows, "id long, a double, b double, y int, c string")


def test_smote_balances_every_class_between_parents(skewed):
    out = balance.smote(skewed, "id", ["a", "b"], "y").collect()
    assert collections.Counter(r["y"] for r in out) == {0: 120, 1: 120, 2: 120}
    assert len({r["id"] for r in out}) == len(out)
    for y in (1, 2):
        old = [r for r in out if r["y"] == y and not r["is_synthetic"]]
        for r in (r for r in out if r["y"] == y and r["is_synthetic"]):
            for f in ("a", "b"):
                assert min(o[f] for o in old) <= r[f] <= max(o[f] for o in old)


def test_smote_does_not_depend_on_the_neighbour_plan(skewed):
    one = sorted(balance.smote(skewed, "id", ["a", "b"], "y").collect())
    two = sorted(balance.smote(skewed, "id", ["a", "b"], "y", **SCALED).collect())
    assert one == two


def test_adasyn_chunks_change_nothing(skewed):
    one = sorted(balance.adasyn(skewed, "id", ["a", "b"], "y").collect())
    two = sorted(balance.adasyn(skewed, "id", ["a", "b"], "y", chunk=3).collect())
    assert one == two
    assert len({r["id"] for r in one}) == len(one)
    grown = collections.Counter(r["y"] for r in one)
    assert abs(grown[1] - 120) <= 25 and abs(grown[2] - 120) <= 60


def test_borderline_starts_from_danger_rows_only(skewed):
    danger = {r["id"] for r in balance.danger_rows(skewed, "id", ["a", "b"], "y", [1, 2], 7).collect()}
    assert danger and danger < {r["id"] for r in skewed.filter("y > 0").collect()}
    out = balance.borderline_smote(skewed, "id", ["a", "b"], "y")
    assert collections.Counter(r["y"] for r in out.collect()) == {0: 120, 1: 120, 2: 120}


def test_nominal_smote_keeps_real_categories(skewed):
    df = skewed.withColumn("wide", F.concat(F.lit("w"), (F.col("id") % 150).cast("string")))
    out = balance.smote_nc(df, "id", ["a", "b"], ["c", "wide"], "y", limit=10).collect()
    new = [r for r in out if r["is_synthetic"]]
    assert {r["c"] for r in new} <= {"m", "n"} and all(r["c"] == "n" for r in new if r["y"] == 1)
    assert len({r["wide"] for r in new}) == 1
    old = {r["id"]: r["wide"] for r in out if not r["is_synthetic"]}
    assert old == {r["id"]: r["wide"] for r in df.collect()}


def test_smote_enn_is_smote_then_editing(skewed):
    grown = balance.smote(skewed, "id", ["a", "b"], "y")
    want = sorted(balance.edited_neighbors(grown, "id", ["a", "b"], "y").collect())
    assert sorted(balance.smote_enn(skewed, "id", ["a", "b"], "y").collect()) == want


def test_undersampling_pooled_and_per_class(skewed):
    pooled = collections.Counter(r["y"] for r in balance.undersample(skewed, "y", "id").collect())
    assert pooled[1] == 25 and pooled[0] + pooled[2] == 25
    each = collections.Counter(r["y"] for r in balance.undersample(skewed, "y", "id", per_class=True).collect())
    assert each == {0: 25, 1: 25, 2: 25}


def test_missing_features_take_the_median(spark):
    df = spark.createDataFrame([(1, 0.0, 0), (2, None, 0), (3, 4.0, 0), (4, 2.0, 1)], "id long, v double, y int")
    out = {r["id"]: r["v"] for r in balance.smote(df, "id", ["v"], "y").collect()}
    assert out[2] == 2.0


def test_balanced_input_gains_nothing(spark):
    df = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 1)], "id long, v double, y int")
    for fn in (balance.smote, balance.adasyn, balance.borderline_smote):
        assert fn(df, "id", ["v"], "y").filter("is_synthetic").count() == 0


def test_comparison_tables(skewed):
    under = balance.undersample(skewed, "y", "id", per_class=True)
    row = balance.compare_techniques(skewed, {"random_undersampling": under}, "y").first()
    assert (row["rows_before"], row["rows_after"], row["ratio_before"], row["ratio_after"]) == (205, 75, 4.8, 1.0)
    assert row["balanced"] and row["gain_pct"] == 79.2
    dist = {r["y"]: (r["before"], r["x"]) for r in balance.class_distribution(skewed, {"x": under.filter("y > 0")}, "y").collect()}
    assert dist == {0: (120, 0), 1: (25, 25), 2: (60, 25)}


@pytest.fixture(scope="module")
def clusters(spark):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(c, 0.4, (150, 3)) for c in rng.uniform(-40, 40, (14, 3))] + [rng.uniform(-400, 400, (60, 3))]).round(3)
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(5)


@pytest.mark.parametrize("fanout", [3, 64], ids=["deep", "flat"])
def test_tree_of_several_levels_equals_brute_force(clusters, fanout):
    x, df = clusters
    got = answers(knn.nearest_neighbors(df, "id", ["a", "b", "c"], 5, broadcast_spots=0, block_rows=50, fanout=fanout))
    want = brute(x, list(range(len(x))), 5)
    assert {i: [n for _, n in v] for i, v in got.items()} == {i: [n for _, n in v] for i, v in want.items()}


def test_most_pairs_of_blocks_are_ruled_out(spark):
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(c, 1.0, (150, 3)) for c in rng.uniform(-60, 60, (40, 3))])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double")
    row = knn.visited_share(df, "id", ["a", "b", "c"], 5, block_rows=50).first()
    assert row["blocks"] > 120 and row["share"] < 0.2


def test_distances_without_rows(cloud):
    x, ids, _, _, df = cloud
    want = brute(x, ids, 3)
    for plan in ({}, SCALED):
        near = knn.nearest_neighbors(df, "id", ["a", "b"], 3, rows=False, **plan)
        assert answers(near) == want


def test_a_spot_takes_few_candidates_from_each_team(spark):
    """In many dimensions nearly all blocks are visited; candidates grow with the teams and not with the blocks."""
    x = np.random.default_rng(5).normal(size=(300, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    _, spots = knn._prepared(df, "id", ["v"], 4, None, False, [], None)
    found, nodes, pairs = knn._scan_tree(spots, 300, 5, 0.0, 10, 4)
    blocks = nodes.filter("leaf").count()
    assert pairs.count() > blocks * (blocks - 1) / 2 and found.count() <= 300 * 5 * 2 < 300 * 5 * blocks / 2
    got = {r["id"]: [n["id"] for n in r["neighbors"]] for r in knn.nearest_neighbors(df, "id", ["v"], 4, broadcast_spots=0, block_rows=10, fanout=4).collect()}
    for i in range(300):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert got[i] == np.argsort(d, kind="stable")[:4].tolist()
