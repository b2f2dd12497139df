"""Boosted trees against a plain implementation on whole arrays."""

import numpy as np
import pytest

from caselume.operators import boost


def slow_boost(x, y, classes, how):
    """Nodes (tree, node) -> (feature, threshold, value), and the margins of all rows."""
    edges = []
    for f in range(x.shape[1]):
        v = np.sort(x[:, f])
        first = np.searchsorted(v, v, side="left")
        spot = first * how.bins // len(v)
        edges.append([v[spot == s].max() for s in np.unique(spot)])
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    m, nodes = np.zeros((len(x), len(classes))), {}
    for r in range(how.rounds):
        p = np.exp(m - m.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        step = np.zeros_like(m)
        for k, c in enumerate(classes):
            g, h = p[:, k] - (y == c), 2 * p[:, k] * (1 - p[:, k])
            at = np.ones(len(x), int)
            for level in range(how.depth):
                for node in sorted({n for n in at.tolist() if n >= 1 << level}):
                    own, best = at == node, None
                    gt, ht = g[own].sum(), h[own].sum()
                    for f in range(x.shape[1]):
                        for b in range(len(edges[f])):
                            left = own & (bins[:, f] <= b)
                            gl, hl = g[left].sum(), h[left].sum()
                            if hl < how.least_weight or ht - hl < how.least_weight:
                                continue
                            gain = gl**2 / (hl + how.ridge) + (gt - gl) ** 2 / (ht - hl + how.ridge) - gt**2 / (ht + how.ridge)
                            if gain > how.gamma + 1e-6 and (best is None or round(gain, 9) > best[0]):
                                best = (round(gain, 9), f, b)
                    if best:
                        nodes[r * len(classes) + k, node] = (best[1], edges[best[1]][best[2]], None)
                        at[own] = 2 * node + (bins[own, best[1]] > best[2])
            for node in set(at.tolist()):
                own = at == node
                value = -how.rate * g[own].sum() / (h[own].sum() + how.ridge)
                nodes[r * len(classes) + k, node] = (None, None, value)
                step[own, k] = value
        m += step
    return nodes, m


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(2)
    x = np.stack([draw.normal(size=260).round(1), draw.integers(0, 6, 260), draw.exponential(size=260).round(2)], axis=1)
    y = (x[:, 0] + 0.4 * x[:, 1] + draw.normal(size=260) * 0.5 > 1).astype(int) + (x[:, 2] > 1.2)
    df = spark.createDataFrame([(i, *map(float, v), int(c) + 1) for i, (v, c) in enumerate(zip(x, y))], "id long, a double, b double, c double, y int")
    return x, y + 1, df.repartition(4)


def test_trees_and_scores_equal_a_plain_implementation(spark, rows, tmp_path):
    x, y, df = rows
    how = boost.Boosting(rounds=2, depth=3, bins=8)
    model = boost.fit_boosted(df, ["a", "b", "c"], "y", [1, 2, 3], how)
    nodes, margins = slow_boost(x, y, [1, 2, 3], how)
    got = {(r["tree"], r["node"]): (r["feature"], r["threshold"], r["value"]) for r in model.nodes.collect()}
    assert got.keys() == nodes.keys()
    for key, (f, t, v) in nodes.items():
        assert got[key][:2] == (f, t) and (v is None) == (got[key][2] is None) and (v is None or got[key][2] == pytest.approx(v))
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    model.save(str(tmp_path / "nodes"))
    again = boost.BoostedTrees.load(spark, str(tmp_path / "nodes"), ["a", "b", "c"], [1, 2, 3])
    for m in (model, again):
        for r in m.predict(df).collect():
            assert r["scores"] == pytest.approx(p[r["id"]].tolist()) and r["prediction"] == 1 + int(p[r["id"]].argmax())


def test_weights_nulls_and_one_class(spark, rows):
    _, _, df = rows
    how = boost.Boosting(rounds=1, depth=2, bins=8)
    twice = boost.fit_boosted(df.unionAll(df), ["a", "b"], "y", [1, 2, 3], how)
    weighted = boost.fit_boosted(df.selectExpr("*", "2.0 as w"), ["a", "b"], "y", [1, 2, 3], how, weight="w")
    assert sorted(map(str, twice.nodes.collect())) == sorted(map(str, weighted.nodes.collect()))
    odd = spark.createDataFrame([(None, 1), (1.0, 1), (2.0, 2), (None, None), (5.0, 2)] * 9, "v double, y int")
    model = boost.fit_boosted(odd, ["v"], "y", [1, 2], how)
    assert {(r["v"], r["prediction"]) for r in model.predict(odd).collect()} == {(None, 1), (1.0, 1), (2.0, 2), (5.0, 2)}
    alone = boost.fit_boosted(odd, ["v"], "y", [2], how).predict(odd)
    assert {r["prediction"] for r in alone.collect()} == {2}


def test_scores_are_computed_once_for_rows_that_are_filtered_by_them(spark):
    rows = spark.range(60_000).selectExpr("id", "double(id % 97) as a", "double(id % 89) as b", "int(1 + (id % 97) div 20) as y")
    model = boost.fit_boosted(rows, ["a", "b"], "y", [1, 2, 3, 4, 5], boost.Boosting(rounds=1, depth=2, bins=16))
    found = model.predict(rows).filter("prediction >= 4")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Substituted into the filter, the sums of the trees stood in the plan hundreds of times.
    assert plan.count("shares(") == 1 and "lambdafunction" not in plan
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (float("-inf"), None), (96.0, 1.0)], "a double, b double")
    got = [r["prediction"] for r in model.predict(odd).collect()]
    assert got[0] == got[2] == 1 and got[1] == got[3] == 5
