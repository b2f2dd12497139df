"""Licence scan by a positional index of rare words.

Templates are word sequences with key phrases that must be there. Of the words that occur
in any template, a text keeps the positions (all others only count). Document
frequencies over the whole table say which word of its key phrases is a template's rarest. A
text looks up the rare words that it has; their postings (template, place in it) propose alignments:
template and relative position. All words vote for an alignment, and it counts if every key
phrase stands at its place. As a template can't stand in a text that lacks its rare word, only texts with
one are split into words. Built-in functions only, from the table to the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


#: Usual notices, and the phrases without which they are not meant.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use", "source and binary forms")),
    Template("bsd", "released under the bsd license", ("bsd license",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("proprietary", "all rights reserved", ("all rights reserved",)),
)
#: Phrases whose places are counted, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Share of a template's words that must be in place.
ENOUGH = 0.5

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _phrase_starts(phrase: str) -> Column:
    """Positions at which the phrase's words follow each other; ``hits`` is sorted by position."""
    first, *rest = phrase.split()
    tests = [f"h.word = '{first}'"] + [f"get(hits, i + {k}).word = '{w}' and get(hits, i + {k}).pos = h.pos + {k}" for k, w in enumerate(rest, 1)]
    return F.expr(f"transform(filter(hits, (h, i) -> {' and '.join(tests)}), h -> h.pos)")


def _either(words) -> str:
    return "|".join(sorted(words))


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE, text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: the counts of the base phrases, the labels and a score.

    ``n_words``, ``n_base`` (all places of base phrases), ``first_word`` and ``last_word`` (their smallest
    and largest start, else null), ``base_labels``, ``labels`` (the templates' too; both sorted and
    joined by commas, empty if none) and ``score``: the best template's share of words in place, 1 where a
    base phrase stands in full. Null and empty texts have no words. Repeated rows stay, ``doc_id`` may be null,
    and other columns are not read. Equal texts are looked up once.
    """
    texts = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    phrases = {t: [p.split() for p in x.phrases] for t, x in enumerate(templates)}
    telling = {w for ps in phrases.values() for p in ps for w in p} | {w for p, _ in base for w in p.split()}
    telling_pattern = rf"(?<![0-9a-z\x{{80}}-\x{{10FFFF}}])(?:{_either(telling)})(?![0-9a-z\x{{80}}-\x{{10FFFF}}])"
    scanned = stage(
        texts.withColumn("low", ascii_lower(F.col("text"))).select(
            "doc_id", F.unhex(F.md5("text")).alias("key"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
            F.array_distinct(F.regexp_extract_all("low", F.lit(telling_pattern), 0)).alias("telling"),
        )
    )
    # Document frequencies over all rows, one for each word of a phrase: bounded by the templates.
    df = {r["word"]: r["n"] for r in scanned.select(F.explode("telling").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}

    def rarest(words: list[str]) -> str:
        return min(words, key=lambda w: (df.get(w, 0), -len(w), w))

    # A template's posting is its rarest key word: a text without it cannot hold the template.
    posted = {t: rarest([w for p in ps for w in p]) for t, ps in phrases.items()}
    index = set(posted.values()) | {rarest(p.split()) for p, _ in base}
    held = {w for x in templates for w in x.text.split()} | telling
    quoted = ", ".join(f"'{w}'" for w in sorted(held))
    found = texts.withColumn("low", ascii_lower(F.col("text"))).filter(F.col("low").rlike(f"(?<![0-9a-z])(?:{_either(index)})(?![0-9a-z])"))
    found = stage(
        found.select(
            F.unhex(F.md5("text")).alias("key"),
            F.expr(f"filter(transform(filter(split(regexp_replace(low, '{NOT_WORD.replace(chr(92), chr(92) * 2)}', ' '), ' ', -1), x -> x != ''), "
                   f"(x, i) -> named_struct('pos', cast(i as long), 'word', x)), s -> s.word in ({quoted}))").alias("hits"),
        ).dropDuplicates(["key"])
    )
    counted = found.select("key", *[_phrase_starts(p).alias(f"p{i}") for i, (p, _) in enumerate(base)])
    every = F.concat(*[F.col(f"p{i}") for i in range(len(base))])
    named = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(base)]))
    counted = counted.select(
        "key", F.size(every).cast("long").alias("n_base"), F.array_min(every).alias("first_word"), F.array_max(every).alias("last_word"), named.alias("base_labels")
    ).filter("n_base > 0")
    matched = counted.join(_matches(found, templates, posted), "key", "full")
    out = scanned.select("doc_id", "key", "n_words").join(stage(matched), "key", "left")
    none = F.array().cast("array<string>")
    labels = F.array_union(F.coalesce("base_labels", none), F.coalesce("labels", none))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(F.coalesce("base_labels", none)), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _places(words: list[str], phrase: list[str]) -> list[int]:
    at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return list(range(at, at + len(phrase)))


def _matches(found: DataFrame, templates, posted: dict[int, str]) -> DataFrame:
    """``key``, ``labels``, ``best`` for the texts in which a template is found."""
    spark = found.sparkSession
    cells = ", ".join(
        f"struct({t} as template, {i} as place, '{w}' as word, {str(w == posted[t]).lower()} as rare)" for t, x in enumerate(templates) for i, w in enumerate(x.text.split())
    )
    postings = F.broadcast(spark.range(1).select(F.expr(f"inline(array({cells}))")))  # as large as the templates
    places = found.select("key", F.inline("hits"))
    proposed = places.join(postings.filter("rare"), "word").select("key", "template", (F.col("pos") - F.col("place")).alias("at")).distinct()
    # Positions of all words vote for the proposed alignments; one row for each text, template and place.
    voted = places.join(postings, "word").select("key", "template", (F.col("pos") - F.col("place")).alias("at"), "place")
    votes = voted.join(proposed, ["key", "template", "at"], "left_semi").groupBy("key", "template", "at").agg(F.collect_set("place").alias("in_place"))
    sizes = F.create_map(*[F.lit(v) for t, x in enumerate(templates) for v in (t, len(x.text.split()))])
    names = F.create_map(*[F.lit(v) for t, x in enumerate(templates) for v in (t, x.label)])
    complete = F.lit(False)
    for t, x in enumerate(templates):
        need = [i for p in x.phrases for i in _places(x.text.split(), p.split())]
        complete = complete | ((F.col("template") == t) & (F.size(F.array_except(F.array(*map(F.lit, need)), "in_place")) == 0))
    kept = votes.withColumn("share", F.size("in_place") / sizes[F.col("template")]).filter((F.col("share") >= ENOUGH) & complete)
    return kept.groupBy("key").agg(F.collect_set(names[F.col("template")]).alias("labels"), F.max("share").alias("best"))
