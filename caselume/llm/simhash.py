"""Near-duplicates by SimHash: fingerprints, and a binary trie joined with itself.

Two fingerprints of 64 bits that differ in at most two of them agree on two of four
blocks of 16 bits at least. So the trie is dealt out by its shared paths: a fingerprint goes to six
tries, one for each pair of blocks, under the 32 bits of that pair, which both sides of a link
have in common. In every such trie the pairs of nodes are walked down together over
the other 32 bits; a pair is dropped once its differing bits exceed the budget.
Tries of very many fingerprints are dealt out again in the same way over
those 32 bits, which leaves tries of 16 bits and so of 65,536 leaves at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import scratch
from ..session import ship_package
from .common import components, give_back, group_bounds, small_batches, stage, trimmed, whole_groups

#: Fingerprints in a trie above which it is dealt out once more.
LARGE_TRIE = 1024
#: Pairs of nodes that a task may hold at a time, by an upper bound.
PAIRS_AT_ONCE = 400_000


def shingles(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words; of a shorter text as a whole; none without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, "<u8")
    line, digest = b" ".join(parts), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(parts))
    runs = zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.array([digest(line[a:b], 42) for a, b in runs], "<u8")


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint as an unsigned integer; 0 for a text without words.

    Words are what ASCII white space separates, with A-Z in lower case. Every run of
    ``words`` of them counts, repeats included; a shorter text is one run.
    """
    hashes = shingles(text, words)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, words: int = 3, text: str = "text") -> DataFrame:
    """Adds ``fingerprint`` as a signed long. Null and empty texts have fingerprint 0."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, words) for t in texts], "<u8").view("<i8"))
        give_back()

    return docs.withColumn("fingerprint", of(text))


def trie_links(codes: np.ndarray, groups: list[int], bits: int, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joins each group's trie with itself: positions (i, j) and differing bits of all links.

    ``codes`` hold the ``bits`` lowest bits that matter, sorted and distinct within each
    group; ``groups`` are the groups' starts and the end. A node is a range of positions;
    all pairs of nodes of one level are walked down at once.
    """
    lo = np.array(groups[:-1], np.int64)
    hi = np.array(groups[1:], np.int64)
    keep = hi - lo > 1
    a = np.stack([lo[keep], hi[keep]])
    b, err = a.copy(), np.zeros(a.shape[1], np.int8)
    for level in range(bits - 1, -1, -1):
        if not a.shape[1]:
            break
        ones = np.concatenate(([0], np.cumsum(codes >> np.uint64(level) & np.uint64(1)).astype(np.int64)))

        def split(node):
            middle = node[1] - (ones[node[1]] - ones[node[0]])
            return np.stack([node[0], middle]), np.stack([middle, node[1]])

        (a0, a1), (b0, b1) = split(a), split(b)
        own = a[0] == b[0]  # a node with itself: its two halves meet once
        a = np.concatenate([a0, a1, a0, a1[:, ~own]], axis=1)
        b = np.concatenate([b0, b1, b1, b0[:, ~own]], axis=1)
        err = np.concatenate([err, err, err + 1, err[~own] + 1]).astype(np.int8)
        keep = (a[1] > a[0]) & (b[1] > b[0]) & (err <= budget)
        keep &= ~((a[0] == b[0]) & (a[1] - a[0] < 2))
        a, b, err = a[:, keep], b[:, keep], err[keep]
    return a[0], b[0], err


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` positions the smallest position that links lead to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _pack(x, blocks: list[int], width: int):
    """Column expression: the given blocks of ``width`` bits, side by side."""
    out = F.lit(0).cast("long")
    for b in blocks:
        out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned(x, b * width).bitwiseAND(F.lit((1 << width) - 1)))
    return out


def _deal(rows: DataFrame, code: str, width: int, key: list) -> DataFrame:
    """Each row once for every pair of four blocks: the pair's bits join the key, the others stay."""
    x = F.col(code)
    ways = [
        F.struct(F.lit(n).alias("way"), _pack(x, list(pair), width).alias("path"), _pack(x, [i for i in range(4) if i not in pair], width).alias("rest"))
        for n, pair in enumerate(combinations(range(4), 2))
    ]
    return rows.select(*key, "fp", F.explode(F.array(*ways)).alias("w")).select(*key, "fp", "w.*")


def _portions(bounds: list[int], bits: int, budget: int):
    """Runs of groups whose pairs of nodes fit in memory; a leaf has as many partners as codes lie near it."""
    near = sum(math.comb(bits, e) for e in range(budget + 1))
    start = total = 0
    for g in range(len(bounds) - 1):
        n = bounds[g + 1] - bounds[g]
        cost = min(n * n, n * near)
        if total and total + cost > PAIRS_AT_ONCE:
            yield bounds[start : g + 1]
            start, total = g, 0
        total += cost
    if len(bounds) > 1:
        yield bounds[start:]


def _within(budget: int, bits: int, keys: list[str], every_link: bool):
    """Task: tries of whole groups, sorted by ``keys``, ``rest``."""

    def run(batches):
        for t in whole_groups(batches, keys):
            cols = [t.column(k).to_numpy() for k in keys]
            fp, rest = t.column("fp").to_numpy(), t.column("rest").to_numpy().view("<u8")
            bounds = group_bounds(*cols)
            for some in _portions(bounds, bits, budget):
                i, j, err = trie_links(rest, some, bits, budget)
                if not every_link:
                    # Links of a trie as a forest: as many rows as fingerprints at most, and the same components.
                    first = some[0]
                    root = forest(some[-1] - first, i - first, j - first)
                    i = np.flatnonzero(root != np.arange(len(root)))
                    i, j, err = i + first, root[i] + first, np.zeros(len(i), np.int8)
                yield pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j]), pa.array(err.astype(np.int32))], names=["a", "b", "bits"])

    return run


def fingerprint_links(fingerprints: DataFrame, budget: int = 2, every_link: bool = False, large: int = LARGE_TRIE) -> DataFrame:
    """Links between the distinct values of ``fp``: rows ``a``, ``b``, ``bits``.

    With ``every_link`` all pairs at ``budget`` (0 to 2) or fewer differing bits, once
    each. Otherwise a forest of every trie: fewer rows, the same components (``bits`` is 0).
    """
    if not 0 <= budget <= 2:
        raise ValueError("the tries are dealt out for budgets of 0 to 2 bits")
    ship_package(fingerprints.sparkSession)
    distinct = fingerprints.select("fp").filter(F.col("fp").isNotNull()).distinct()
    dealt = _deal(distinct, "fp", 16, [])
    sizes = dealt.groupBy("way", "path").agg(F.count("*").alias("n")).filter("n > 1")
    found = stage(dealt.join(sizes, ["way", "path"]))
    out = None
    for part, keys, bits in (
        (found.filter(F.col("n") <= large).drop("n"), ["way", "path"], 32),
        (_deal_again(found.filter(F.col("n") > large)), ["way0", "path0", "way", "path"], 16),
    ):
        links = (
            part.repartition(*keys).sortWithinPartitions(*keys, "rest").mapInArrow(trimmed(_within(budget, bits, keys, every_link)), "a long, b long, bits int")
        )
        out = links if out is None else out.union(links)
    if every_link:
        out = out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "bits").distinct()
    return out


def _deal_again(rows: DataFrame) -> DataFrame:
    renamed = rows.select(F.col("way").alias("way0"), F.col("path").alias("path0"), "fp", "rest")
    dealt = _deal(renamed, "rest", 8, ["way0", "path0"])
    keys = ["way0", "path0", "way", "path"]
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return dealt.join(sizes.drop("n"), keys)


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2, text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that chains of links (``budget`` or fewer
    differing bits) reach, the row's own included. Null or empty texts have fingerprint
    zero and are linked like any other; a null ``doc_id`` is never smallest, unless all of a
    component are null. Repeated rows stay; other columns are not read. Copies meet in
    one fingerprint before any join, so the work grows with different fingerprints.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        marked = stage(with_fingerprint(docs.select("doc_id", text), words, text).select("doc_id", F.col("fingerprint").alias("fp")))
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(marked, budget)).withColumnsRenamed({"node": "fp"})
    linked = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = stage(linked)
    whole = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(whole, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Views of a text for texts that are similar, not almost equal, and shingles in each.
VIEWS, IN_VIEW = 12, 3
#: Shingles of a block of texts that is compared with others at once.
IN_BLOCK = 100_000


def view_fingerprints(text: str | None, words: int = 5, views: int = VIEWS) -> list[int]:
    """Fingerprints of ``views`` small selections of the text's shingles, as signed integers, and of the whole.

    A selection is the three different shingles that come first in an order of its own, so that texts with
    a share J of common shingles have the same one with probability about J cubed; at 0.8 or more they agree
    in one of twelve with 99.98 %. A text without words has fingerprint 0 alone.
    """
    hashes = shingles(text, words)
    if not len(hashes):
        return [0]
    whole = np.array([fingerprint(text, words)], "<u8")
    different = np.unique(hashes)
    out = []
    for v in range(views):
        mixed = different ^ np.uint64((v + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(32)
        first = np.sort(np.partition(mixed, IN_VIEW - 1)[:IN_VIEW] if len(mixed) > IN_VIEW else mixed)
        first *= np.uint64(0xD6E8FEB86659FD93)  # the smallest have few high bits; the tries need all bits alike
        first ^= first >> np.uint64(32)
        first *= np.uint64(0xD6E8FEB86659FD93)
        a, b, c = (first[min(i, len(first) - 1)] for i in range(3))
        out.append((a & b) | (a & c) | (b & c))
    return np.concatenate([whole, np.array(out, "<u8")]).view("<i8").tolist()


def similar_links(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``key`` of every row, and verified links (``a``, ``b``) between keys of similar texts.

    Texts whose fingerprints of the whole are linked by the tries, or of a selection equal, are compared: first each text of such
    a group with two of it, chosen by a hash, then (``_links_between``) all texts of the group that are not yet in one component, so that
    chains of links join what all pairs of the group would. A link holds if the exact Jaccard similarity of their sets of
    shingles is ``similarity`` or more.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.unhex(F.md5("text")))

    @F.pandas_udf("array<long>")
    def views(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: view_fingerprints(t, words))
        give_back()

    with small_batches(spark):
        marked = stage(rows.select("doc_id", "key", views("text").alias("views")))
    flat = stage(marked.select("key", F.posexplode("views").alias("view", "fp")).distinct())
    # The whole texts' fingerprints are linked by the tries. Those of selections are equal or have nothing in common.
    roots = components(fingerprint_links(flat.filter("view = 0").select("fp"), 2)).withColumnsRenamed({"node": "fp"})
    grouped = stage(flat.join(roots, "fp", "left").select("key", F.coalesce("root", "fp").alias("g")).distinct())
    # First and last in an order of the group's own, so that a text meets others in every group that it is in.
    place = F.struct(F.xxhash64("key", "g").alias("h"), "key")
    ends = grouped.groupBy("g").agg(F.min(place)["key"].alias("first"), F.max(place)["key"].alias("last")).filter("first != last")
    pairs = grouped.join(ends, "g").select("key", F.explode(F.array("first", "last")).alias("other")).filter("key != other")
    pairs = stage(pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct())
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    texts = stage(rows.select("key", "text").join(wanted, "key", "left_semi").dropDuplicates(["key"]))

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        def share(p, q):
            p, q = np.unique(shingles(p, words)), np.unique(shingles(q, words))
            common = len(np.intersect1d(p, q, assume_unique=True))
            return common >= similarity * (len(p) + len(q) - common)

        return pd.Series([share(p, q) for p, q in zip(x, y)], dtype=bool)

    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("key").alias("b"), F.col("text").alias("y")), "b")
    with small_batches(spark, 128):
        links = stage(both.select("a", "b", alike("x", "y").alias("ok")).filter("ok").select("a", "b"))
    return marked.select("doc_id", "key"), links.union(_links_between(rows, grouped, links, words, similarity))


def _links_between(rows: DataFrame, grouped: DataFrame, links: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links (``a``, ``b``) that join components of ``links`` which meet in a group: every pair of texts of a group is
    compared, but those in one component already. Work grows with the texts of a group outside its largest
    component times all of the group; it is dealt out by pairs of blocks of about ``IN_BLOCK`` shingles.
    """
    spark = rows.sparkSession
    roots = components(links).withColumnsRenamed({"node": "key"})
    named = grouped.join(roots, "key", "left").select("key", "g", F.coalesce("root", "key").alias("c"))
    parts = named.groupBy("g", "c").agg(F.count("*").alias("n"))
    main = parts.groupBy("g").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "c"))["c"].alias("main"))
    main = main.filter("parts > 1 and n > 3").select("g", "main")  # of three texts all pairs have been compared
    apart = stage(named.join(main, "g").select("key", "g", "c", (F.col("c") == F.col("main")).alias("in_main")))

    @F.pandas_udf("binary")
    def shingle_set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: np.unique(shingles(t, words)).tobytes())
        give_back()

    with small_batches(spark):
        texts = rows.select("key", "text").join(apart.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
        sets = stage(texts.select("key", shingle_set("text").alias("set")).withColumn("size", F.octet_length("set") / 8 + 1))
    sized = apart.join(sets.select("key", "size"), "key")

    def blocks(of: Column) -> Column:
        return F.ceil(F.coalesce(F.sum(F.when(of, F.col("size"))), F.lit(0)) / IN_BLOCK).cast("int")

    count = sized.groupBy("g").agg(blocks(~F.col("in_main")).alias("others"), blocks(F.col("in_main")).alias("mains"))
    salt = F.xxhash64("key", "g")
    own = F.when(F.col("in_main"), F.col("others") + F.pmod(salt, "mains")).otherwise(F.pmod(salt, "others")).cast("int")
    last = F.when(F.col("in_main"), F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    dealt = apart.join(count, "g").select("key", "g", "c", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("with"))
    dealt = dealt.join(sets.select("key", "set"), "key").select("g", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "key", "c", "set")
    with small_batches(spark):
        met = dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(trimmed(_between(similarity)), "a binary, b binary")
        return stage(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _between(similarity: float):
    """Task: whole pairs of blocks; a forest of links between their components."""

    def run(batches):
        for t in whole_groups(batches, ["g", "i", "j"], 512):
            bounds = group_bounds(*[t.column(k).to_numpy() for k in ("g", "i", "j")])
            a, b = [], []
            for start, end in zip(bounds, bounds[1:]):
                some = t.slice(start, end - start)
                keys, own = some.column("key").to_pylist(), some.column("own").to_numpy()
                _, part = np.unique(np.array([c.hex() for c in some.column("c").to_pylist()]), return_inverse=True)
                for x, y in joined_parts([np.frombuffer(s, "<u8") for s in some.column("set").to_pylist()], own, part, similarity):
                    a.append(keys[x])
                    b.append(keys[y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def joined_parts(sets: list[np.ndarray], own: np.ndarray, part: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Pairs of similar sets that join different parts, one for each join. Sets of two blocks are compared across, of one block all."""
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    part, low = part.copy(), own.min()
    across = bool((own != low).any())
    owner, marks = np.repeat(np.arange(len(sets)), sizes), np.zeros(len(ids), bool)
    for x in np.flatnonzero(own == low):
        other = part != part[x]
        if across:
            other &= own != low
        if not other.any():
            continue
        mine = ids[starts[x] : starts[x + 1]]
        marks[mine] = True
        common = np.bincount(owner[marks[ids]], minlength=len(sets))
        marks[mine] = False
        hits = np.flatnonzero(other & (common >= similarity * (sizes[x] + sizes - common)))
        joined, first = np.unique(part[hits], return_index=True)
        yield from ((x, y) for y in hits[first])
        part[np.isin(part, joined)] = part[x]


def without_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of equal or similar texts: that with the smallest ``doc_id`` (null ids last), unchanged.

    Groups are what chains of links join. Of repeated rows with that id one stays.
    """
    with scratch(docs.sparkSession) as last:
        marked, links = similar_links(docs, words, similarity)
        least = marked.groupBy("key").agg(F.min("doc_id").alias("least"))
        roots = components(links).withColumnsRenamed({"node": "key"})
        grouped = least.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        kept = grouped.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "key")).alias("m"))
        kept = last(kept.select(F.col("m.key").alias("__key"), F.col("m.least").alias("__id")))
    keyed = docs.withColumn("__key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    out = keyed.join(kept, "__key").filter(F.col("doc_id").eqNullSafe(F.col("__id")))
    return out.dropDuplicates(["__key"]).drop("__key", "__id")
