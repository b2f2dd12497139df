"""Operators and stages against loops over whole texts, and stages on odd tables."""

import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from caselume.llm import decontaminate, toxicity

DATA = contract.SMOKE_DIR


# --- toxicity: features ----------------------------------------------------------------------------

def slow_features(text, lexicon):
    words = re.findall(r"[^\W\d_]+", text)
    n = len(words)
    if not n:
        return [0.0] * len(toxicity.FEATURES)
    low = [w.lower() for w in words]
    weight = lambda w: max([lexicon.get(u, 0.0) for u in toxicity.units(w)], default=0.0)
    hits = [weight(w) for w in low]
    at = [i for i, h in enumerate(hits) if h]
    fixed = [i for i, w in enumerate(low) if w in toxicity.INSULTS]
    second = [i for i, w in enumerate(low) if w in toxicity.SECOND]
    near = sum(any(abs(i - j) <= 5 for j in second) for i in {*at, *fixed})
    letters = sum(map(len, words))
    odd = [t for t in text.split() if re.search(r"[^\W\d_][0-9@$*!|][^\W\d_]", t)]
    leet = str.maketrans("013457@$!|", "oieastasil")
    plain = [w for t in odd for w in re.findall(r"[^\W\d_]+", t.lower().translate(leet))]
    marks = len(text) - letters - text.count(" ") - text.count("\n") - text.count(".") - text.count(",")
    return [
        math.log1p(n), len(fixed) / n, math.log1p(len(fixed)), len(at) / n, math.log1p(sum(hits)), max(hits), math.log1p(len({low[i] for i in at})), near / n,
        len(second) / n, sum(w.isupper() and len(w) > 1 for w in words) / n, sum(c.isupper() for c in text) / letters, text.count("!") / n, marks / len(text),
        sum(text.count(c) for c in "#$%&*@|") / n, len(odd) / n, sum(w in toxicity.INSULTS or weight(w) > 0 for w in plain) / n, len(re.findall(r"(\w)\1\1", text)) / n, letters / n,
    ]


def test_features_equal_their_definitions():
    draw = random.Random(8)
    pieces = ["you", "YOU", "idiot", "ID10T", "m0ron", "st*pid", "Straße", "ÉTÉ", "naïve", "aaa", "soooo", "!!!", "...", "a1b", "x_y_z", "foo", "foolish", "日本", "42", "@home", "#tag", "\n", "  ", "___", "7777", "Du", "dumm,"]
    lexicon = {"foo": 1.5, "fool~": 2.25, "日本": 0.5, "home": 3.0}
    for _ in range(400):
        text = " ".join(draw.choice(pieces) for _ in range(draw.randint(0, 40)))
        assert toxicity.features(text, toxicity._Weights(lexicon)) == pytest.approx(slow_features(text, lexicon)), text
    assert toxicity.features("", toxicity._Weights({})) == [0.0] * len(toxicity.FEATURES)


# --- decontamination: windows ------------------------------------------------------------------------

def slow_leaks(docs, items, size=8, covered=0.5, in_a_row=6):
    """For texts of plain lower-case words: (document, item) with the best alignment's coverage and place."""
    out = {}
    for d, text in docs:
        t = (text or "").split()
        for i, item in items:
            w = (item or "").split()
            n = min(size, len(w))
            if not w or n < 4 and len(w) != n:
                continue
            total, best = len(w) - n + 1, None
            for shift in range(-total + 1, len(t)):
                found = [a for a in range(total) if 0 <= a + shift <= len(t) - n and t[a + shift : a + shift + n] == w[a : a + n]]
                run = longest = 0
                for a in range(total):
                    run = run + 1 if a in found else 0
                    longest = max(longest, run)
                if found and (len(found) / total >= covered or len(found) >= in_a_row or longest >= in_a_row):
                    best = max(best or (0, 0), (len(found) / total, -shift))
            if best:
                out[d, i] = (best[0], -best[1])
    return out


def test_leaks_and_the_stage_equal_brute_force(spark, make_docs):
    draw = random.Random(6)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)] + ["the", "of"]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([1, 3, 5, 8, 9, 14, 30])))) for i in range(25)] + [(None, " ".join(words[:12]))]
    docs = []
    for d in range(80):
        parts = [draw.choice(words) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 2)):
            w = draw.choice(items)[1].split()
            a = draw.randint(0, len(w) // 2)
            at = draw.randint(0, len(parts))
            parts[at:at] = w[a : draw.randint(a, len(w))]
        docs.append((d, " ".join(parts)))
    docs += [(1000 + d, t) for d, t in docs[:9]] + [(None, items[5][1]), (2007, None), (2008, "")]
    long = " ".join(draw.choice(words) for _ in range(30_000)) + " " + items[-1][1]
    df, bench = make_docs(docs), spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    want = slow_leaks(docs, items)
    got = {(r.doc_id, r.item_id): (r.coverage, r["at"]) for r in decontaminate.find_leaks(df.withColumn("window", F.lit("clash")), bench).collect()}
    assert got == want and len(want) > 30
    kept = sorted(((r.doc_id, r.text) for r in decontaminate.without_leaks(df, bench).collect()), key=repr)
    hit = {dict(docs)[d] for d, _ in want}
    assert kept == sorted(((d, t) for d, t in docs if t not in hit), key=repr)
    assert {(r.item_id, r["at"]) for r in decontaminate.find_leaks(make_docs([(1, long)]), bench.filter("item_id is null")).collect()} == {(None, 30_000)}


# --- stages on odd tables ----------------------------------------------------------------------------

@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
def test_stages_take_odd_rows_and_empty_tables(spark, make_docs, odd_rows):
    given = [(i, t) for i, t in odd_rows if t is None or len(t) < 100_000]
    odd = make_docs(given).withColumn("key", F.lit("clash")).withColumn("digest", F.lit(None).cast("binary")).withColumn("least", F.lit(0))
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, odd, DATA)
        assert out.columns == odd.columns and step(spark, odd.limit(0), DATA).count() == 0, name
        rows = out.collect()
        ids = sorted((r.doc_id for r in rows), key=repr)
        every = sorted((i for i, _ in given), key=repr)
        if name == "simhash_dedup":  # one row of equal texts stays, and one of those without words: the smallest id
            assert ids == sorted([1, 2, 7, 8, 10, None], key=repr)
        else:
            assert ids == every, name
        if name != "suffix_dedup":
            texts = {(i, t) for i, t in given}
            assert all((r.doc_id, r.text) in texts and r["key"] == "clash" for r in rows)
    last = corpus_pipeline.STAGES[-1][1](spark, odd, DATA)
    assert last.count() == len(given) and corpus_pipeline.STAGES[-1][1](spark, odd.limit(0), DATA).count() == 0
