"""Fill-in-the-middle against slices of the whole text."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from caselume.llm import middle


def slow(i, text, seed=1):
    t = text or ""
    s = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(s[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, e = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{e}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{e}<M>{m}"


def generated(n, seed=4):
    draw = random.Random(seed)
    alphabet = ["a", "b ", "é", "日", "😀", "\n", "<", "S>", "<P", ">", "M"]
    return [(100 + i, "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 90)))) for i in range(n)]


@pytest.mark.parametrize("frame", [1, 7, 65_536])
def test_outputs_and_digests_against_brute_force(spark, make_docs, odd_rows, frame):
    given = odd_rows[-8:] + odd_rows[:4] + generated(250) + [(5, "x <P> y"), (6, "<S>"), (77, "<M"), (78, "<M>")]
    if frame > 1:
        given += odd_rows
    docs = make_docs(given).withColumn("form", F.lit("clash")).withColumn("output", F.lit(1)).withColumn("frames", F.lit(2))
    want = sorted(((i, *slow(i, t)) for i, t in given), key=repr)
    out = middle.fill_in_middle(docs, frame=frame, as_text=True)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = sorted(((i, *slow(i, t)[:4], sha(slow(i, t)[4]), sha(t)) for i, t in given), key=repr)
    assert sorted((tuple(r) for r in middle.digests(docs, frame=frame).collect()), key=repr) == want
    assert {r["form"] for r in out.collect()} == {"plain", "psm", "spm"}


def test_only_cut_frames_are_decompressed(spark, make_docs):
    text = "".join(f"{i:09d} " for i in range(10_000))
    row = middle.draw(middle.store_frames(make_docs([(1, text)]), frame=1000)).first()
    assert row["starts"] == list(range(0, 100_000, 1000)) and len(row["frames"]) == 100
    opened = []
    held = middle.Frames(row["starts"], row["frames"])
    was, held.open = held.open, lambda f: opened.append(f) or was(f)
    import zstandard

    out = list(middle.output_frames("psm", row["n"], 12_345, 67_890, held, zstandard.ZstdCompressor().compress))
    assert len(opened) == 2 and sum(f in row["frames"] for f in out) == 98
    joined = b"".join(middle.streamed(out)).decode()
    assert joined == f"<P>{text[:12_345]}<S>{text[67_890:]}<M>{text[12_345:67_890]}"
    assert b"".join(middle.restored(middle.streamed(out), "psm")).decode() == text
    assert b"".join(middle.restored((bytes([b]) for b in joined.encode()), "psm")).decode() == text


def test_empty_table(spark, make_docs):
    assert middle.digests(make_docs([])).count() == 0 == middle.fill_in_middle(make_docs([])).count()
