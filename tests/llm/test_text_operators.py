"""Operators on texts against brute force, on odd rows and on generated ones."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
from pyspark.sql import functions as F
import xxhash

from caselume.llm import bpe, license, repeats, sequences, simhash

TOKENIZER, RANKS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_multi_50k.tiktoken")


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def generated(n, seed=1):
    draw = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "mit", "license", "apache", "general", "public", "naïve", "42", "the", "of"]
    passage = " ".join(draw.choice(words) + str(draw.randint(0, 99)) for _ in range(60))
    out = []
    for i in range(n):
        parts = [" ".join(draw.choice(words) + (str(draw.randint(0, 999)) if draw.random() < 0.6 else "") for _ in range(draw.randint(0, 120)))]
        if draw.random() < 0.3:
            parts.insert(draw.randint(0, 1), passage[draw.randint(0, 60) :])
        if draw.random() < 0.1:
            parts.append(draw.choice(["ab", "xyz ", "ü!"]) * draw.randint(50, 400))
        text = "\n".join(parts)
        out.append((i, text))
        if draw.random() < 0.1:
            out.append((n + i, text))
    return out


# --- sequence files -----------------------------------------------------------------------------

def test_sequences_round_trip(spark, make_docs, odd_rows, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    given = [r for r in odd_rows if r[0] is not None] + [(20 + i, t) for i, t in generated(40)]
    manifest = sequences.write_sequences(make_docs(given), f"file://{tmp_path}/s", TOKENIZER, length=64, batch=4, parts=3).cache()
    got = rows(sequences.read_documents(manifest), "doc_id", "n_tokens", "ids_crc32")
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t in given}
    assert got == sorted(((i, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for i, t in given), key=repr)
    by_start = sorted((r.start, r.doc_id, r.n_tokens) for r in sequences.read_documents(manifest).collect())
    assert [d for _, d, _ in by_start] == sorted(i for i, _ in given)
    assert all(a[0] + a[2] == b[0] for a, b in zip(by_start, by_start[1:])) and by_start[0][0] == 0
    # Any sequence can be read by itself, as a view; ids of the file's sequences in order are its documents.
    for part in manifest.collect():
        s = sequences.Sequences(part["file"].removeprefix("file://"))
        stream = np.concatenate([s[i][0][s[i][1]] for i in range(len(s))])
        assert len(stream) == part["tokens"] and all(len(s[i][0]) == 64 for i in range(len(s)))
        assert not s[0][0].flags.owndata
        with pytest.raises(IndexError):
            s[len(s)]
    manifest.unpersist()


def test_sequences_of_an_empty_table(spark, make_docs, tmp_path):
    manifest = sequences.write_sequences(make_docs([]), f"file://{tmp_path}/e", TOKENIZER)
    assert sequences.read_documents(manifest).count() == 0


def test_chunked_encoding_is_encoding_whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    draw = random.Random(2)
    alphabet = "ab A. ,\n\t '’s1é!? 　\xa0日<|endoftext|>\0_"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 50))) for _ in range(3000)]
    want = [np.array(e.ids, np.uint16).tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sequences.Encoder(TOKENIZER).encode(texts) == want


# --- byte-level BPE ------------------------------------------------------------------------------

def test_bpe_against_the_library(spark, make_docs, odd_rows):
    codec = bpe.encoding(RANKS, public.PATTERN)
    given = odd_rows + generated(30, 3)
    got = rows(bpe.encode_documents(make_docs(given), RANKS, public.PATTERN, size=50), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")
    want = []
    for i, t in given:
        ids = np.array(codec.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), bytearray(ids)))
    assert got == sorted(want, key=repr)
    assert bpe.encode_documents(make_docs([]), RANKS, public.PATTERN).count() == 0


def test_bpe_replaces_clashing_columns_and_decodes_raw_bytes(spark, make_docs):
    df = make_docs([(1, "x y")]).withColumn("n_tokens", F.lit("old"))
    out = bpe.encode_documents(df, RANKS, public.PATTERN, keep_text=True)
    assert out.first()["n_tokens"] == 2 and out.first()["text"] == "x y"
    codec = bpe.encoding(RANKS, public.PATTERN)
    ids = bpe.encode("é", codec)
    assert b"".join(bpe.decode(ids[:1], codec)) == "é".encode()[: len(codec.decode_bytes(ids[:1].tolist()))]


# --- SimHash -------------------------------------------------------------------------------------

def slow_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_components(spark, make_docs, odd_rows):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 6
    given = odd_rows + [(100 + i, base + "x" * i) for i in range(5)]
    given = [(i, t) for i, t in given if i is not None]
    prints = {i: slow_fingerprint(t, 3) for i, t in given}
    groups = slow_components(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    got = rows(simhash.near_duplicates(make_docs(given)), "doc_id", "fingerprint", "component_id")
    assert got == sorted(((i, f"{prints[i]:016x}", groups[i]) for i, _ in given), key=repr)
    assert simhash.near_duplicates(make_docs([])).count() == 0
    alone = simhash.near_duplicates(make_docs([(None, "no id"), (3, None)])).collect()
    assert {(r.doc_id, r.component_id) for r in alone} == {(None, None), (3, 3)}


@pytest.mark.parametrize("large", [4096, 3])
@pytest.mark.parametrize("budget", [0, 1, 2])
def test_trie_finds_every_link(spark, large, budget):
    draw = random.Random(4)
    values = set()
    for _ in range(20):
        base = draw.getrandbits(64)
        for _ in range(25):
            v = base
            for bit in draw.sample(range(64), draw.choice([0, 1, 2, 3])):
                v ^= 1 << bit
            values.add(v - (1 << 64) if v >> 63 else v)
    values = sorted(values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {(r.a, r.b, r.bits) for r in simhash.fingerprint_links(df, budget, True, large).collect()}
    apart = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1")
    assert got == {(b, a, apart(a, b)) for i, a in enumerate(values) for b in values[:i] if apart(a, b) <= budget}


def test_similar_texts_leave_one(spark, make_docs, odd_rows):
    draw = random.Random(5)
    given = []
    for g in range(12):
        words = [f"w{draw.randint(0, 10**6)}" for _ in range(200)]
        given.append((10 * g, " ".join(words)))
        for c in range(1, 4):
            copy = list(words)
            for at in draw.sample(range(200), c):
                copy[at] = "changed"
            given.append((10 * g + c, " ".join(copy)))
    given += [(1000 + i, " ".join(f"u{draw.randint(0, 10**6)}" for _ in range(50))) for i in range(20)]
    kept = {r.doc_id for r in simhash.without_near_duplicates(make_docs(given)).collect()}
    assert kept == {10 * g for g in range(12)} | {1000 + i for i in range(20)}
    odd = simhash.without_near_duplicates(make_docs(odd_rows))
    assert odd.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    # 2, 3, 4 and the null row have no words, 1 and 9 are equal, 5 and 6 similar, 8 is repeated.
    assert sorted((r.doc_id for r in odd.collect()), key=str) == sorted([1, 2, 5, 7, 8, 10, None], key=str)


@pytest.mark.parametrize("block", [100_000, 5_000])
def test_edits_of_one_text_are_linked_as_by_brute_force(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(simhash, "IN_BLOCK", block)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base)]
    for _ in range(300):  # J of 0.8 to 0.85 to the base, about 0.7 to one another
        words = list(base)
        for at in draw.sample(range(0, 300, 6), 6):
            words[at] = f"x{draw.random()}"
        texts.append(" ".join(words))
    passage = [f"p{i}" for i in range(210)]
    for i in range(40):  # pairs with a common passage: all in the same groups, similar in twos
        end = [f"q{i}.{j}" for j in range(90)]
        texts += [" ".join(passage + end), " ".join(passage + end[:-14] + [f"r{i}.{j}" for j in range(14)])]
    sets = [set(simhash.shingles(t, 5).tolist()) for t in texts]
    want = slow_components(list(range(len(texts))), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    roots = set(want.values())
    assert len(roots) == 41
    kept = rows(simhash.without_near_duplicates(make_docs(list(enumerate(texts)))), "doc_id")
    assert sorted(r[0] for r in kept) == sorted(roots)


# --- repeats -------------------------------------------------------------------------------------

def slow_removal(given, k=200):
    raw = [(i, (t or "").encode()) for i, t in given]
    seen = Counter(b[p : p + k] for _, b in raw for p in range(len(b) - k + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - k + 1):
            if seen[b[p : p + k]] > 1:
                gone[p : p + k] = b"\1" * k
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("large", [20_000, 1])
def test_repeats_against_brute_force(spark, make_docs, odd_rows, large):
    short = [(i, t[:3000] if t else t) for i, t in odd_rows]
    given = short + [(1000 + i, t) for i, t in generated(150, 6)]
    got = rows(repeats.remove_repeats(make_docs(given), large=large), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == slow_removal(given)
    assert sum(r[2] for r in got) > 10_000


def test_repeats_of_nothing_and_kept_texts(spark, make_docs):
    assert repeats.remove_repeats(make_docs([])).count() == 0
    shared = "é".join(str(i) for i in range(150))
    given = [(1, "A unique beginning. " + shared), (2, shared + " and a unique end."), (3, "short"), (4, None)]
    out = {r.doc_id: r for r in repeats.without_repeats(make_docs(given)).collect()}
    assert out[1].text == "A unique beginning. " and out[2].text == " and a unique end." and out[3].text == "short" and out[4].text is None
    assert out[1].n_chars == len(out[1].text) and out[3].n_chars == 5


def test_intervals_are_all_maximal_groups():
    words = sorted(["banana", "bandana", "band", "ban", "can", "candy", "cane", "dog"])
    prefix = np.array([len(__import__("os").path.commonprefix([a, b])) for a, b in zip(words, words[1:])])
    got = {(d, tuple(words[a : z + 1])) for d, a, z in repeats.intervals(prefix) if d}
    want = set()
    for d in range(1, 7):
        for head in {w[:d] for w in words}:
            group = tuple(w for w in words if w.startswith(head))
            if len(group) > 1 and len(__import__("os").path.commonprefix(list(group))) == d:
                want.add((d, group))
    assert got == want


# --- licences ------------------------------------------------------------------------------------

def test_licence_counts(spark, make_docs, odd_rows):
    given = odd_rows + generated(80, 7) + [
        (500, "MIT License and the Apache-License; the GNU General Public License, version 3."), (501, "Licensed under CC BY-NC 4.0."), (502, "mit licenses. permit license"), (503, "All rights reserved"),
        (504, "mit license " * 30), (505, "Émit license mité license"),
    ]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = []
    for i, t in given:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
        found = [(p, label) for phrase, label in license.BASE for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        places = [p for p, _ in found]
        want.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))))
    out = license.scan(make_docs(given)).cache()
    assert rows(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[500].labels == "apache,gpl,mit" and by_id[501].labels == "cc-by-nc" and by_id[503].labels == "proprietary" and by_id[502].labels == ""
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in by_id.values())
    assert license.scan(make_docs([])).count() == 0
    out.unpersist()
