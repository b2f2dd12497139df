"""The filter audit against rules applied one document and one order at a time."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from caselume.llm import audit
from caselume.llm.common import Spans


def slow_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_fails(rows):
    out = []
    for i, text, part in rows:
        t, w = text or "", slow_words(text)
        bad = set()
        if len(w) < 50:
            bad.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            bad.add("C")
        if re.search("[#$%&*|]", t):
            bad.add("D")
        if i is not None and any((u or "") == t and j is not None and j < i for j, u, _ in rows):
            bad.add("E")
        out.append((i, part or "", bad))
    return out


def slow_audit(rows, labels):
    fails, out, shapley = slow_fails(rows), [], Counter()
    # A label without an id belongs to no document.
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    for part in {p for _, p, _ in fails}:
        mine = [(i, bad) for i, p, bad in fails if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(i, b) for i, b in left if f in b]
                left = [(i, b) for i, b in left if f not in b]
                shapley[part, f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(f in b for _, b in mine) - len(gone), sum(b == {f} for _, b in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def generated(n, seed=7):
    draw = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "naïve", "日本語", "x" * 9, "y" * 300, "y" * 299 + "z", "a", "#tag", "50%", "the", "of", "internationalisation"]
    out = []
    for i in range(n):
        vocabulary = draw.sample(words, draw.randint(1, 9)) + [f"w{k}" for k in range(draw.choice([1, 30, 200]))]
        text = "".join(draw.choice(vocabulary) + draw.choice([" ", "\n", "\t\v", "\f\r", "  "]) for _ in range(draw.choice([0, 3, 49, 50, 80, 200])))
        out.append((i, text, draw.choice(["s0", "s0", "s1", None, ""])))
        if draw.random() < 0.3:
            out.append((n + draw.randint(-n, n), text, draw.choice(["s0", "s2"])))
    return out


def test_audit_against_brute_force(spark, odd_rows):
    rows = generated(120) + [(i, t, "odd") for i, t in odd_rows] + [(None, "", "odd"), (3, "", "s0"), (900, None, None)]
    labels = [(i, i % 3 % 2, i % 5 % 2) for i in range(0, 240, 2)] + [(4, 1, 1), (None, 1, 1), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mask", F.lit("clash")).withColumn("n", F.lit(0)).repartition(5)
    got = audit.audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1)))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == slow_audit(rows, labels)


def test_measures_of_each_text(spark, make_docs, odd_rows):
    given = [r for r in odd_rows] + [(i, t) for i, t, _ in generated(60, 9)]
    got = audit.text_measures(make_docs(given)).select("doc_id", "words", "different", "capitals", "symbols", "points").collect()
    want = [
        (i, len(slow_words(t)), len(set(slow_words(t))), len(re.findall("[A-Z]", t or "")), len(re.findall("[#$%&*|]", t or "")), len(t or "")) for i, t in given
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_equal_hashes_of_different_words_are_told_apart():
    texts = [b"aa bb aa cc", b"", b"bb bb " + b"q" * 400 + b" " + b"q" * 399 + b"r " + b"q" * 400]
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    assert audit.measures(buffer, ends)["different"].tolist() == [3, 0, 3]
    start = np.array([0, 3, 6, 9, 11, 14, 17, 418, 819])
    size = np.array([2, 2, 2, 2, 2, 2, 400, 400, 400])
    spans = Spans(buffer, start, size)
    assert [spans.whole(i) for i in range(4)] == [b"aa", b"bb", b"aa", b"cc"]
    same = np.zeros(9, np.uint64)
    assert audit.distinct_words(spans, np.array([0, 0, 0, 0, 2, 2, 2, 2, 2]), 3, same).tolist() == [3, 0, 3]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit.audit_filters(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
