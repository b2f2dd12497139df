"""Benchmark decontamination by template windows.

Texts and benchmark items are brought to templates: numbers, names and units become typed
placeholders, so that a question with other parameters has the same template. Windows of template words
are hashed and joined. Matches that stand at the same relative place of a text and an item
form an alignment, and it counts if it covers enough of the item and its slots are consistent: one
value of the item always stands for one value of the text. A run of windows with the item's own values counts by itself,
whatever the other slots hold.
Built-in functions only, from the table to the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import scratch
from .common import stage

#: Words of a window; an item of fewer words is one window.
WINDOW = 8
#: An alignment counts from this share of an item's windows on, or from so many windows (13 words in a row).
COVERED, IN_A_ROW = 0.5, 6
#: A window of placeholders alone says nothing: so many of its words must be plain, or else its values must be the item's own
#: and its words so many.
PLAIN = 4
#: Places of benchmark windows that are broadcast at once; more are taken in blocks, each against all texts.
BLOCK = 1_000_000

#: Units that follow a number.
UNITS = "km cm mm m kg g mg lb lbs oz l ml s sec min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years mile miles metre metres meter meters foot feet inch inches dollar dollars euro euros cent cents percent degree degrees".split()
#: Marks put before a name, a number, a unit; the placeholders of templates.
MARKS, SLOTS = ("\x01", "\x02", "\x03"), ("<name>", "<num>", "<unit>")


def with_template(rows: DataFrame, text: str = "text") -> DataFrame:
    """Replaces ``text`` by ``m``, its words joined by spaces with a mark before names, numbers and units, and
    adds ``t``, the array of template words (empty for a null or empty text).

    A name is a capitalised word within a sentence; figures with points or commas are one number.
    """
    name, number, unit = MARKS
    # One step after the other, each under a name: an expression that is used twice is computed once. Patterns begin with
    # what is rare, and look back from there.
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = reduce(Column.__or__, [F.contains(whole, F.lit(m)) for m in MARKS])
    steps = [
        F.when(marked, F.translate(whole, "".join(MARKS), "   ")).otherwise(whole),
        F.regexp_replace("m", r"[.,](?<=[0-9].)(?=[0-9])", ""),
        F.regexp_replace("m", r"\p{Lu}(?<=[\p{Ll}0-9],? .)\p{Ll}+(?![\p{L}\p{N}])", f"{name}$0"),
        F.trim(F.regexp_replace("m", rf"[^a-zA-Z0-9\p{{L}}\p{{N}}{name}]+", " ")),
        F.regexp_replace("m", r"[0-9](?<![^ ].)[0-9]*+(?![^ ])", f"{number}$0"),
    ]
    for step in steps:
        rows = rows.withColumn("m", step)
    units = F.regexp_replace("m", rf"(?i)(?<={number}[0-9]{{1,40}} )({'|'.join(UNITS)})(?![^ ])", f"{unit}$0")
    rows = rows.withColumn("m", F.when(F.col("m").contains(number), units).otherwise(F.col("m"))).withColumn("t", F.lower("m"))
    for mark, slot in zip(MARKS, SLOTS):
        rows = rows.withColumn("t", F.when(F.col("t").contains(mark), F.regexp_replace("t", f"{mark}[^ ]*", slot)).otherwise(F.col("t")))
    whole = F.when(F.col("m") == "", F.array().cast("array<string>")).otherwise(F.split("t", " ", -1))
    return rows.drop(text).withColumn("t", whole)


#: The words of ``m`` as they are, without marks.
LITERAL = f"split(lower(translate(m, '{''.join(MARKS)}', '')), ' ', -1)"


def _sections(sizes: list[int], literal: list[int]) -> list[tuple[int, bool]]:
    """What a text's windows are hashed as, in order: by size, of template words and, where such are wanted, of words as they are."""
    return [(n, own) for n in sizes for own in ((False, True) if n in literal else (False,))]


def _with_windows(rows: DataFrame, sizes: list[int], literal: list[int]) -> DataFrame:
    """A row for each window of a text, of all sizes in one pass: ``key``, ``at``, ``window``.

    Words are hashed once, windows are hashes of these; the hash of an array is that of its elements one after the other, so
    an item's windows are hashed as slices. The text itself is not carried into the rows. Windows of the words as they are are only formed where a window can have fewer than ``PLAIN`` plain words.
    """
    marks = F.expr("regexp_count(m, '[" + "".join(f"\\u{ord(m):04x}" for m in MARKS) + "]')") if literal else F.lit(0)
    hashed = "transform({}, x -> xxhash64(x))"
    least = min((n - min(PLAIN, n) for n in literal), default=0)
    rows = rows.withColumn("marks", marks).withColumn("w", F.expr(hashed.format("t")))
    own = F.expr(hashed.format(LITERAL)) if literal else F.lit(None)
    rows = rows.withColumn("l", F.when(F.col("marks") >= least, own).cast("array<bigint>")).select("key", "marks", "w", "l")
    parts = []
    for n, as_is in _sections(sizes, literal):
        array, tag = ("l", -n) if as_is else ("w", n)
        # An edge of a copy may be marked in one of the two alone.
        fits = f"size(w) >= {n}" + (f" and marks >= {n - min(PLAIN, n)} and size(l) >= {n}" if as_is else "")
        words = ", ".join(f"get({array}, i + {k})" for k in range(n))
        parts.append(f"case when {fits} then transform(sequence(0, size({array}) - {n}), i -> xxhash64({tag}, {words})) else cast(array() as array<bigint>) end")
    # The outer form: a filter on the array would be pushed down to the scan, where its expressions would be computed again.
    rows = rows.select("key", F.explode_outer(F.expr(f"array({', '.join(parts)})")).alias("windows"))
    return rows.select("key", F.posexplode_outer("windows").alias("at", "window"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, covered: float = COVERED, block: int = BLOCK) -> DataFrame:
    """Texts that hold a benchmark item, as rows ``doc_id``, ``item_id``, ``at`` (where the item's first word is
    or would be), ``coverage``, ``exact``.

    ``coverage`` is the share of the item's windows found at one alignment, the best one for each text
    and item. ``exact``: the values of all its slots are the item's own; otherwise the question has other
    parameters. Windows with fewer than ``PLAIN`` plain words are found with the item's own values alone; with other parameters
    coverage is that of the other windows, if these span enough of the item. A null or empty text or item matches nothing, nor does
    an item of fewer than ``PLAIN`` words that are not all plain. A
    repeated row gives its rows once; ``doc_id`` may be null, and so may ``item_id``: such items are looked for like others, and their
    rows have a null. Of a very long text no more than its words and hashes is held at once; other columns are not read.
    """
    with scratch(docs.sparkSession) as last:
        best = last(_leaks(docs, benchmark, size, covered, block))
    # Few texts hold an item: they are found by their keys before rows are told apart.
    found = docs.select("doc_id", _key().alias("key")).join(best.select("key").distinct(), "key", "left_semi").distinct()
    return found.join(best, "key").select(
        "doc_id", "item_id", (-F.col("b.back")).alias("at"), F.col("b.coverage").alias("coverage"), F.col("b.exact").alias("exact")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, unchanged."""
    with scratch(docs.sparkSession) as last:
        gone = last(_leaks(docs, benchmark, WINDOW, COVERED, BLOCK).select(F.col("key").alias("__key")).distinct())
    return docs.withColumn("__key", _key()).join(gone, "__key", "left_anti").drop("__key")


def _key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _items(benchmark: DataFrame, size: int) -> DataFrame:
    """Templates of the items: ``item``, ``item_id``, ``own`` (words with marks), ``t``, ``m``, ``n`` (words of a window)."""
    items = stage(with_template(benchmark.select("item_id", "text"))).select("item_id", "m", F.split("m", " ", -1).alias("own"), "t")
    # Each item with its names as placeholders and as they are: a text in capitals shows no names.
    as_they_are = F.expr(f"transform(t, (x, i) -> case when x = '{SLOTS[0]}' then lower(substring(own[i], 2)) else x end)")
    items = items.union(items.withColumn("t", as_they_are)).dropDuplicates(["item_id", "own", "t"])
    # Items of fewer words than a window are looked for whole.
    return items.withColumn("item", F.xxhash64("item_id", "own", "t")).withColumn("n", F.least(F.size("t"), F.lit(size))).filter("n > 0")


def _wanted(items: DataFrame) -> DataFrame:
    """A row for each window of an item: ``window``, ``n``, ``literal``, ``item``, ``item_at``. Windows of few plain words are looked for by
    the words as they are, and not at all if the whole item has fewer than ``PLAIN`` words."""
    slots = ", ".join(f"'{s}'" for s in SLOTS)
    hashed = items.withColumn("w", F.expr("transform(t, x -> xxhash64(x))")).withColumn("l", F.expr(f"transform({LITERAL}, x -> xxhash64(x))"))
    windows = hashed.select("item", "n", F.expr(
        f"inline(transform(sequence(0, size(t) - n), i -> named_struct('item_at', i, 'literal', size(filter(slice(t, i + 1, n), x -> x not in ({slots}))) < least({PLAIN}, n), "
        "'plain', xxhash64(n, slice(w, i + 1, n)), 'own', xxhash64(-n, slice(l, i + 1, n)))))"
    ))
    windows = windows.filter(f"not literal or n >= {PLAIN}")
    return windows.select(F.when(F.col("literal"), F.col("own")).otherwise(F.col("plain")).alias("window"), "n", "literal", "item", "item_at")


def _leaks(docs: DataFrame, benchmark: DataFrame, size: int, covered: float, block: int) -> DataFrame:
    """The leaks of each text: ``key``, ``item_id``, ``b`` (the best alignment)."""
    slots = ", ".join(f"'{s}'" for s in SLOTS)
    items = stage(_items(benchmark, size))
    wanted = stage(_wanted(items))
    kinds = wanted.groupBy("n", "literal").agg(F.count("*").alias("places")).collect()  # a few sizes
    sizes, literal = sorted({r["n"] for r in kinds}), sorted({r["n"] for r in kinds if r["literal"]})
    if not kinds:  # no item has a window: nothing matches
        kind = dict(benchmark.dtypes)["item_id"]
        none = F.struct(F.lit(0.0).alias("coverage"), F.lit(True).alias("exact"), F.lit(0).alias("back"))
        return docs.limit(0).select(_key().alias("key"), F.lit(None).cast(kind).alias("item_id"), none.alias("b"))
    texts = docs.select(_key().alias("key"), "text")
    windows = _with_windows(with_template(texts), sizes, literal)
    blocks, parts = -(-sum(r["places"] for r in kinds) // block), []
    for b in range(blocks):
        asked = F.broadcast(wanted.filter(F.pmod(F.xxhash64("window", "item", "item_at"), F.lit(blocks)) == b))  # about ``block`` rows at most
        parts.append(windows.join(asked, "window").select("key", "item", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "literal"))
    # For each text and alignment: the windows of one item bound what is collected.
    aligned = reduce(DataFrame.union, parts).groupBy("key", "item", "shift").agg(F.collect_set(F.struct("item_at", "literal")).alias("places"))
    aligned = stage(aligned)
    # The words of the texts that are left, which are few.
    held = texts.join(aligned.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    held = stage(with_template(held).select("key", F.split("m", " ", -1).alias("spelt")))
    # The item's windows that are looked for by their templates: their number, or none if they span too little of it.
    plain = F.expr(f"size(filter(sequence(0, size(t) - n), a -> size(filter(slice(t, a + 1, n), x -> x not in ({slots}))) >= least({PLAIN}, n)))")
    plain = F.when(plain + F.col("n") - 1 >= covered * F.size("t"), plain).otherwise(0)
    aligned = aligned.join(items.select("item", "item_id", "own", F.col("t").alias("form"), "n", plain.alias("plain")), "item").join(held, "key")
    aligned = aligned.withColumn("parts", F.expr("transform(places, p -> named_struct('item_at', p.item_at, 'literal', p.literal, 'words', slice(spelt, shift + p.item_at + 1, n)))"))
    marks = "".join(MARKS)
    pairs = F.expr(
        "array_distinct(flatten(transform(parts, p -> filter(transform(p.words, (x, i) -> named_struct("
        f"'form', get(form, p.item_at + i), 'own', lower(translate(get(own, p.item_at + i), '{marks}', '')), 'new', lower(translate(x, '{marks}', '')))), s -> s.form in ({slots})))))"
    )
    own = f"forall(transform(p.words, (x, i) -> get(form, p.item_at + i) not in ({slots}) or lower(translate(get(own, p.item_at + i), '{marks}', '')) = lower(translate(x, '{marks}', ''))), x -> x)"
    # The longest run of windows that follow one another, all with the item's own values.
    verbatim = F.expr(
        f"aggregate(array_sort(transform(filter(parts, p -> {own}), p -> p.item_at)), named_struct('last', -2, 'run', 0, 'best', 0), "
        "(a, x) -> named_struct('last', x, 'run', if(x = a.last + 1, a.run + 1, 1), 'best', greatest(a.best, if(x = a.last + 1, a.run + 1, 1))), a -> a.best)"
    )
    checked = aligned.withColumn("slots", pairs).withColumn("windows", F.size("parts")).select(
        "key", "item_id", "shift", "windows", F.greatest(
            F.col("windows") / (F.size("form") - F.col("n") + 1), F.coalesce(F.expr("try_divide(size(filter(parts, p -> not p.literal)), plain)"), F.lit(0.0))
        ).alias("coverage"),
        F.expr("forall(slots, s -> s.own = s.new)").alias("exact"),
        F.expr("size(array_distinct(transform(slots, s -> struct(s.form, s.own)))) = size(slots)").alias("consistent"), verbatim.alias("verbatim"),
    )
    kept = checked.filter((F.col("consistent") & ((F.col("coverage") >= covered) | (F.col("windows") >= IN_A_ROW))) | (F.col("verbatim") >= IN_A_ROW))
    return kept.groupBy("key", "item_id").agg(F.max(F.struct("coverage", "exact", (-F.col("shift")).alias("back"))).alias("b"))
