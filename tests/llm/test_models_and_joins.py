"""Scored, joined and staged operators: held-out accuracy, brute force, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselume.llm import decontaminate, quality, toxicity, urls, vectors
from caselume.llm.common import components

LABELS = "doc_id long, quality int, toxic int"


def auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    a, b = s[y == 1][:, None], s[y == 0][None, :]
    return float((a > b).mean() + 0.5 * (a == b).mean())


@pytest.fixture(scope="module")
def labelled(make_docs, spark):
    draw = random.Random(8)
    docs, labels = [], []
    for i in range(900):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(draw.randint(20, 80))]
        bad, toxic = draw.random() < 0.4, draw.random() < 0.3
        if toxic:
            for _ in range(4):
                words.insert(draw.randint(0, len(words)), draw.choice(["idiot", "you idiot", "zzgrok", "zzgroking"]))
        text = " | ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + "."
        docs.append((i, text))
        labels.append((i, int(not bad), int(toxic)))
    return make_docs(docs), spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t in labels}


def test_toxicity_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    got = toxicity.score(docs, labels, trees=10).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert auc([r.score for r in held], [truth[r.doc_id][1] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_quality_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    got = quality.score(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert auc([r.score for r in held], [truth[r.doc_id][0] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_equal_texts_have_equal_scores_labelled_or_not(labelled):
    docs, labels, _ = labelled
    more = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1_000_000))
    seen = {}
    for r in toxicity.score(more, labels, trees=5).collect():
        seen.setdefault(r.text, set()).add((r.score, r.predicted))
    assert len(seen) > 100 and all(len(v) == 1 for v in seen.values())
    kept = toxicity.without_toxic(more, labels)
    assert {r.n for r in kept.groupBy("text").agg(F.count_distinct("doc_id").alias("n")).collect()} <= {r.n for r in more.groupBy("text").agg(F.count_distinct("doc_id").alias("n")).collect()}


@pytest.mark.parametrize("score", [toxicity.score, quality.score])
def test_scores_of_odd_rows(spark, make_docs, odd_rows, labelled, score):
    docs, labels, _ = labelled
    both = docs.union(make_docs([(i if i is None else 10_000 + i, t) for i, t in odd_rows]))
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (10_002, None, None), (10_003, 1, 0), (10_003, 0, 1)], LABELS))
    got = score(both, odd).collect()
    assert len(got) == 900 + len(odd_rows) and all(r.score is not None and r.held_out is not None for r in got)
    # Nothing to learn from, or nothing to score.
    none = score(make_docs(odd_rows), labels.limit(0)).collect()
    assert len(none) == len(odd_rows) and {r.score for r in none} == {0.0}
    assert score(make_docs([]), labels).count() == 0


def test_toxicity_keeps_clashing_columns(labelled):
    docs, labels, truth = labelled
    clean = toxicity.without_toxic(docs.withColumn("score", F.lit("mine")), labels)
    assert clean.columns == [*docs.columns, "score"]
    kept = {r.doc_id for r in clean.collect()}
    assert sum(truth[i][1] for i in kept) < 0.1 * sum(t for _, t in truth.values()) and len(kept) > 550


# --- decontamination ------------------------------------------------------------------------------

def test_leaks_exact_and_with_other_parameters(spark, make_docs):
    item = "If Alice buys 12 apples for 3.5 dollars each and gives 12 dollars to Bob, how much does she have left over?"
    other = "A train leaves at noon and runs along the coast until it meets the old harbour bridge near the city wall"
    bench = spark.createDataFrame([(1, item), (2, other), (3, "very short plain item"), (4, None), (5, ""), (None, item), (None, "a null item that no other repeats must be found too")], "item_id long, text string")
    docs = make_docs([
        (9, "well, a null item that no other repeats must be found too, here"), (10, "x " * 40 + item + " y" * 40), (11, item.upper()), (12, item.replace("12", "7").replace("3.5", "2").replace("Bob", "Dan")),
        (13, item.replace("12 apples", "7 apples").replace("12 dollars", "9 dollars").replace("Bob", "Dan")), (14, "so " + " ".join(other.split()[:14])), (15, " ".join(other.split()[:7])),
        (16, "a very short plain item here"), (17, None), (18, ""), (19, "nothing of the kind stands in here at all, is it so or not so"), (None, other), (20, other), (20, other),
    ])
    got = {(r.doc_id, r.item_id): r.exact for r in decontaminate.find_leaks(docs, bench).collect()}
    named = {(10, 1): True, (11, 1): True, (12, 1): False, (14, 2): True, (16, 3): True, (None, 2): True, (20, 2): True}
    assert got == named | {(9, None): True, (10, None): True, (11, None): True, (12, None): False}
    kept = decontaminate.without_leaks(docs.withColumn("key", F.lit(1)), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [13, 15, 17, 18, 19] and "key" in kept.columns
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0 and decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == 14
    blocks = {(r.doc_id, r.item_id): r.exact for r in decontaminate.find_leaks(docs, bench, block=5).collect()}
    assert blocks == got


def test_items_dense_in_numbers_are_found(spark, make_docs):
    short = "What is 12 * 7 + 3 - 45 / 9?"
    mixed = "Please add up all of these many numbers now 12 7 3 45 9 8 6 5 4 2 11 13"
    bench = spark.createDataFrame([(1, short), (2, mixed), (3, "42")], "item_id long, text string")
    docs = make_docs([
        (10, "so it is " + short + " that is the question"), (11, "What is 12 * 7 + 3 - 45 / 8?"), (12, "x " + mixed + " y"), (13, "the answer is 42 here"),
        (14, "12 7 3 45"), (15, short), (16, mixed.replace("45", "46")), (17, "Please add up all of these many numbers"),
    ])
    got = {(r.doc_id, r.item_id): r.exact for r in decontaminate.find_leaks(docs, bench).collect()}
    assert {k for k, exact in got.items() if exact} == {(10, 1), (12, 2), (15, 1)} and {k[0] for k in got} <= {10, 12, 15, 16}
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, bench).collect())[:3] == [11, 13, 14]


def test_slot_conflicts_leave_verbatim_runs_and_equal_values(spark, make_docs):
    start = "A farmer has 3 red hens that lay one egg on every day of the warm season while the old dog sleeps in the yard near the big gate"
    end = "and after that the same farmer sells all the eggs at the town market and buys 3 new hens for the coming spring season with what was earned"
    two = "the baker makes 3 round loaves in the morning and 5 long loaves in the evening of each day"
    bench = spark.createDataFrame([(1, f"{start} {end}"), (2, two)], "item_id long, text string")
    docs = make_docs([(10, f"{start} {end.replace('3', '4')}"), (11, two.replace("3", "4").replace("5", "4")), (12, "nothing of the kind stands in here at all, is it so")])
    got = {(r.doc_id, r.item_id): r.exact for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(10, 1): False, (11, 2): False}


# --- vectors --------------------------------------------------------------------------------------

def slow_links(rows, least=0.9):
    import math

    good = [i for i, (n, v) in enumerate(rows) if n is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: 0 for i in range(len(rows))}
    root = {n: n for n, _ in rows if n is not None}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in good:
        for b in good:
            if a != b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[a] += 1
                    p, q = find(rows[a][0]), find(rows[b][0])
                    root[max(p, q)] = min(p, q)
    return sorted(((n, links[i], find(n) if n is not None else None) for i, (n, _) in enumerate(rows)), key=repr)


def vector_rows():
    draw = np.random.default_rng(9)
    rows = [(i, draw.normal(size=16).astype(np.float32).tolist()) for i in range(400)]
    for g in range(8):
        centre = draw.normal(size=16)
        rows += [(1000 + 50 * g + j, (centre + draw.normal(size=16) * 0.12).astype(np.float32).tolist()) for j in range(g * 5 + 2)]
    rows += [(5000 + j, rows[0][1]) for j in range(60)]  # copies
    return rows + [(6000, None), (6001, []), (6002, [0.0] * 16), (6003, [None] + [1.0] * 15), (6004, [float("nan")] + [1.0] * 15), (6005, [1.0, 2.0]), (6006, [2.0, 4.0]), (None, rows[1][1]), (6007, rows[2][1]), (6007, rows[2][1])]


def as_vectors(spark, rows):
    """With columns whose names the operator uses itself."""
    df = spark.createDataFrame([(n, v, 0) for n, v in rows], "vec_id long, embedding array<float>, label int").repartition(4)
    return df.withColumn("id", F.lit("clash")).withColumn("v", F.lit(1)).withColumn("n", F.lit(None)).withColumn("shard", F.lit("s"))


@pytest.mark.parametrize("sizes", [(600, 3000, 2000), (40, 30, 4)])
def test_vectors_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD", "LARGE_SHARD", "CENTRES"), sizes):
        monkeypatch.setattr(vectors, name, value)
    rows = vector_rows()
    df = as_vectors(spark, rows)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()), key=repr)
    want = slow_links(rows)
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.97 * true and all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got, want))
    assert np.mean([g[2] == w[2] for g, w in zip(got, want)]) > 0.97
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_a_missed_goal_ends_in_an_exact_comparison(spark, monkeypatch):
    monkeypatch.setattr(vectors, "COMPARED", 60)
    draw = np.random.default_rng(3)
    rows = vector_rows()
    for i in range(40):  # lone pairs just above the bound
        x = vectors.unit(draw.normal(size=(1, 16)))[0]
        y = draw.normal(size=16)
        y = vectors.unit((y - (y @ x) * x)[None, :])[0]
        c = 0.9005 + 0.0004 * i
        rows += [(8000 + 2 * i, x.tolist()), (8001 + 2 * i, (c * x + (1 - c * c) ** 0.5 * y).tolist())]
    df = as_vectors(spark, rows)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(df, goal=1.1, attempts=1).collect()), key=repr)
    assert got == slow_links([(n, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for n, v in rows])


def test_pruning_keeps_what_no_neighbour_leads_to():
    x = vectors.unit(np.array([[1, 0.0], [1, 0.1], [1, 0.12], [0, 1.0], [1, -0.3]]))
    near = np.array([1, 2, 4, 3])
    kept = vectors.robust_prune(x[near] @ x[0], near, x[near] @ x[near].T)
    assert kept.tolist()[0] == 1 and 2 not in kept and 4 in kept


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(900, 900)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 100) for i in range(100, 161)} | {(i, 500) for i in range(500, 700)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- urls -----------------------------------------------------------------------------------------

def slow_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_urls_against_the_rules(spark):
    given = [None, "", "no scheme", "http://", "http://Example.ORG/es/a?x", "https://a.example.org/en/123#t", "https://example.org?q", "http://org/", "http://forg/x", "http://x.com/de/1", "http://x.com/fr/1://2",
             "http://É.com/de/", "a://b://c/d", "http://x.net/a/" + "b/" * 300]
    given += [f"http://h{i % 3}.example.{t}/{lang}/{i}.html" for i in range(60) for t in ("com", "net", "org") for lang in ("de", "fr", "en")]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*given, given[5]])], "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge(df.withColumn("host", F.lit("clash"))).collect()}
    for i, u in enumerate([*given, given[5]]):
        host, path, rule, verdict = slow_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    by_template = {(r.host, r.template): r.verdict for r in got.values() if r.rule is None}
    assert by_template["h0.example.com", "/en/#.html"] == "allow"
    assert urls.judge(df.limit(0)).count() == 0


def test_variable_segments_become_wildcards(spark):
    rows = [("h.com", f"/user/{chr(97 + i % 26)}{chr(97 + i // 26)}x/page") for i in range(100)] + [("h.com", "/about/us")]
    got = {r.path: r.template for r in urls.templates(spark.createDataFrame(rows, "host string, path string")).collect()}
    assert set(got.values()) == {"/user/*/page", "/about/us"}


@pytest.mark.parametrize("slugs", [10, 60])
def test_segments_below_a_wildcard_become_wildcards(spark, slugs):
    names = [f"{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    rows = [("h.com", f"/user/{n}/{n}-{word(s)}") for n in names for s in range(slugs)] + [("h.com", f"/user/{n}/profile") for n in names if slugs < 20]
    got = {r.template for r in urls.templates(spark.createDataFrame(rows, "host string, path string")).collect()}
    assert got == ({"/user/*/*", "/user/*/profile"} if slugs < 20 else {"/user/*/*"})


def test_share_backs_off_along_prefixes(spark):
    rules = (("block", "h.com", "/shop/a"), ("allow", "h.com", "/news"), ("allow", "g.net", "/"))
    given = [f"http://h.com/shop/a/{c}" for c in "abcdefghij"] + [f"http://h.com/shop/b/{c}" for c in "abcde"] + ["http://h.com/other", "http://h.com/news"]
    given += [f"http://h.com/news/{c}" for c in "abcdefghijklmno"] + [f"http://g.net/shop/b/{c}{d}" for c in "abcdefgh" for d in "abcde"] + ["http://new.org/shop/b/a"]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    got = {given[r.page_id]: r for r in urls.judge(df, rules).collect()}
    assert {got[f"http://h.com/shop/b/{c}"].verdict for c in "abcde"} == {"block"}
    assert got["http://h.com/other"].verdict == got["http://new.org/shop/b/a"].verdict == "allow"
    assert got["http://h.com/shop/b/a"].purity == got["http://h.com/shop/b/e"].purity


def test_quality_learns_from_all_labelled_rows(spark, monkeypatch):
    """More rows of a class than any bound there was; the quantiles and pairs are made from all of them."""
    from caselume.llm.toxicity import is_held_out, training_rows

    labels = spark.range(60_000).selectExpr("id as doc_id", "int(id % 10 = 0) as quality", "0 as toxic")
    asked = []
    monkeypatch.setattr(quality, "training_rows", lambda *a: asked.append(a) or training_rows(*a))
    docs = labels.filter("doc_id < 200").selectExpr("doc_id", "if(quality = 1, 'a fine and whole sentence, read by all.', 'x x x $$ ##') as text")
    assert quality.score(docs, labels).count() == 200
    got = training_rows(*asked[0])
    want = labels.filter(~is_held_out(labels.doc_id, 5, 0))
    assert got.count() == want.count() > 45_000 and got.filter("weight <> 1").isEmpty()
