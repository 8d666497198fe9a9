r"""License scan: an exact set-similarity search of license templates in the texts, over line ends.

DataFrames only. Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text in lower case; line ends
separate words like any other white space, so a wrapped notice is found. A template of ``m`` words
is looked for in blocks of ``2 m`` words that begin at every multiple of ``m``: each run of ``m``
words lies in one of them, and no block is longer than twice the template. A block matches if it
holds ``PERCENT`` of the template's distinct words or more, its naming words among them.

The words of all templates are ordered by their frequency in the whole corpus, rarest first, and
the usual filters follow, each of which keeps every match:

* prefix: a matching block holds one of the template's ``n - need + 1`` rarest words, so texts and
  blocks without any of these words are not looked at again;
* length: it holds at least ``need`` words of the templates' vocabulary;
* position: from the first prefix word that both hold, enough words must follow on both sides.

What is left is verified by intersection. The template table is small and fixed, so it goes into
the expression; documents are neither shuffled nor exploded, a hot source costs no more than its
bytes, and a text costs in proportion to its length, however many notices it holds. Beside the
templates, phrases are counted where their words stand consecutively.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENT = 80

PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}


class Template(NamedTuple):
    """A notice, and the words without which it names something else."""

    label: str
    text: str
    naming: tuple[str, ...] = ()


#: Notices as they stand in files and pages.
TEMPLATES = (
    Template("apache", "licensed under the apache license version 2 0", ("apache",)),
    Template("mit", "released under the mit license", ("mit",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
                    "software and associated documentation files"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are "
                    "permitted provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc", "nc")),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international "
                      "license", ("commons", "attribution")),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the "
                    "terms of the gnu general public license as published by the free software "
                    "foundation", ("gnu",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla",)),
    Template("public-domain", "this is free and unencumbered software released into the public domain",
             ("unencumbered", "domain")),
)

_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> list[str]:
    return list(dict.fromkeys(text.split()))


def _need(words: list[str], percent: int) -> int:
    return -(-len(words) * percent // 100)


def flat(text: Column) -> Column:
    """Words in lower case with one space before, between and after them.

    ``lower`` changes letters outside ASCII too, which moves no word boundary and makes no
    phrase: none has a letter that one of them becomes.
    """
    spaced = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.regexp_replace(spaced, _OTHER, " ")


def _array(values: list[str]) -> Column:
    return F.split(F.lit(" ".join(values)), " ")


def _holds(text: Column, phrase: str) -> Column:
    return F.contains(text, F.lit(f" {phrase} "))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _count(text: Column) -> Column:
    """Words of a flat text, or of a piece of one."""
    inner = F.trim(text)
    spaces = F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit("")))
    return F.when(inner == "", F.lit(0)).otherwise(spaces + 1)


def word_order(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """The templates' words by the number of documents that hold them, rarest first.

    One row reaches the driver.
    """
    vocabulary = sorted({w for t in templates for w in _words(t.text)})
    texts = docs.select(flat(F.col("text")).alias("flat"))
    found = texts.agg(
        *[F.count_if(_holds(F.col("flat"), w)).alias(f"n{k}") for k, w in enumerate(vocabulary)]
    ).first()
    by_word = {w: found[f"n{k}"] for k, w in enumerate(vocabulary)}
    return sorted(vocabulary, key=lambda w: (by_word[w], w))


def _prefix_of(template: Template, order: list[str], percent: int) -> list[str]:
    words = sorted(_words(template.text), key=order.index)
    return words[: len(words) - _need(words, percent) + 1]


def _containment(block: Column, words: list[str], percent: int) -> Column:
    """Share of ``words`` (in global order) that ``block`` (likewise) holds, 0 if below the need."""
    need = _need(words, percent)
    prefix = words[: len(words) - need + 1]
    first = F.get(F.array_intersect(block, _array(prefix)), F.lit(0))
    after_here = F.size(block) - F.array_position(block, first) + 1
    after_there = len(words) - F.array_position(_array(words), first) + 1
    fits = (
        (F.size(block) >= need)
        & F.arrays_overlap(block, _array(prefix))
        & (after_here >= need)
        & (after_there >= need)
    )
    both = F.size(F.array_intersect(block, _array(words)))
    return F.when(fits & (both >= need), both / F.lit(len(words))).otherwise(F.lit(0.0))


def _likeness(template: Template, order: list[str], percent: int) -> Column:
    """The best containment of a template in the blocks of a row's ``words``."""
    length = len(template.text.split())
    words = sorted(_words(template.text), key=order.index)
    prefix = _prefix_of(template, order, percent)

    def containment(start: Column) -> Column:
        run = F.slice("words", start * length + 1, F.lit(2 * length))
        named = F.arrays_overlap(run, _array(prefix))
        for word in template.naming:
            named = named & F.array_contains(run, word)
        block = F.array_intersect(_array(order), run)
        return F.when(named, _containment(block, words, percent)).otherwise(F.lit(0.0))

    starts = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / length).cast("int"))
    here = _any([_holds(F.col("flat"), w) for w in prefix])
    for word in template.naming:
        here = here & _holds(F.col("flat"), word)
    return F.when(here, F.array_max(F.transform(starts, containment))).otherwise(F.lit(0.0))


def _phrase(phrase: str) -> Column:
    """(count, first, last): places of a phrase in ``flat``, by the words before and behind them.

    Its words are looked for with two spaces between all words, so that places may adjoin.
    """
    length = len(phrase.split())
    doubled = F.concat(F.lit(" "), F.replace(F.trim("flat"), F.lit(" "), F.lit("  ")), F.lit(" "))
    parts = F.split(doubled, " " + "  ".join(phrase.split()) + " ", -1)

    def words_of(part: Column) -> Column:
        return F.size(F.filter(F.split(part, " "), lambda w: w != ""))

    found = F.transform(
        F.array(parts),
        lambda p: F.struct(
            (F.size(p) - 1).cast("bigint").alias("count"),
            words_of(F.element_at(p, 1)).cast("bigint").alias("first"),
            (F.col("n") - length - words_of(F.element_at(p, -1))).cast("bigint").alias("last"),
        ),
    )
    return F.when(_holds(F.col("flat"), phrase), F.get(found, F.lit(0)))


def scan(docs: DataFrame, templates=TEMPLATES, phrases=None, percent: int = PERCENT) -> DataFrame:
    """doc_id, counts, places and labels of each row of ``docs`` (doc_id, text).

    Null, empty and wordless texts have no words, no labels and score 0. Ids may be null or
    repeated; other columns are ignored. ``score`` is the best containment of a template in a block
    that matches it, and 1 where a phrase stands.
    """
    phrases = PHRASES if phrases is None else phrases
    order = word_order(docs, templates)
    rows = docs.select("doc_id", flat(F.col("text")).alias("flat"))
    rows = rows.select("doc_id", "flat", _count(F.col("flat")).alias("n"))
    rare = {w for t in templates for w in _prefix_of(t, order, percent)}
    some = _any([_holds(F.col("flat"), w) for w in sorted(rare)])
    rows = rows.withColumn("words", F.when(some, F.split(F.trim("flat"), " ")))
    rows = rows.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_words"),
        *[_phrase(p).alias(f"at{k}") for k, p in enumerate(phrases)],
        *[_likeness(t, order, percent).alias(f"like{k}") for k, t in enumerate(templates)],
    )
    at = [F.col(f"at{k}") for k in range(len(phrases))]
    base = [F.when(a.isNotNull(), F.lit(label)) for a, label in zip(at, phrases.values(), strict=True)]
    like = [F.col(f"like{k}") for k in range(len(templates))]
    more = [F.when(x > 0, F.lit(t.label)) for x, t in zip(like, templates, strict=True)]
    joined = lambda found: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*found)))), ",")
    counts = [F.coalesce(a["count"], F.lit(0).cast("bigint")) for a in at]
    return rows.select(
        "doc_id",
        "n_words",
        reduce(lambda a, b: a + b, counts).alias("n_base"),
        F.array_min(F.array_compact(F.array(*[a["first"] for a in at]))).alias("first_word"),
        F.array_max(F.array_compact(F.array(*[a["last"] for a in at]))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(base + more).alias("labels"),
        F.greatest(F.when(_any([a.isNotNull() for a in at]), F.lit(1.0)).otherwise(F.lit(0.0)), *like).alias(
            "score"
        ),
    )


def oracle_sql(templates=TEMPLATES, percent: int = PERCENT) -> str:
    """The same in DuckDB over ``documents``, every block against every template, unfiltered."""
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    kinds = ", ".join(
        f"('{t.label}', {quoted(_words(t.text))}, {quoted(t.naming) if t.naming else '[]::VARCHAR[]'},"
        f" {len(t.text.split())})"
        for t in templates
    )
    sayings = ", ".join(f"('{label}', {quoted(p.split())})" for p, label in PHRASES.items())
    return f"""WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, list_filter(string_split(regexp_replace(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS words
  FROM documents),
places AS (
  SELECT row, label, unnest(list_filter(range(len(words) - len(phrase) + 1),
    lambda i: words[i + 1 : i + len(phrase)] = phrase)) AS place
  FROM texts, (VALUES {sayings}) p(label, phrase)),
base AS (
  SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    list(DISTINCT label) AS found FROM places GROUP BY row),
blocks AS (
  SELECT row, label, known, naming, words[start * size + 1 : start * size + 2 * size] AS block
  FROM texts, (VALUES {kinds}) t(label, known, naming, size), range(0, len(words) // size + 1) g(start)
  WHERE start * size < len(words)),
shares AS (
  SELECT row, label, len(list_intersect(list_distinct(block), known)) AS held, len(known) AS n FROM blocks
  WHERE list_has_all(block, naming)),
matches AS (
  SELECT row, list(DISTINCT label) AS found, max(held / n) AS score
  FROM shares WHERE 100 * held >= {percent} * n GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.found, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.found, []),
    coalesce(matches.found, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1e0 ELSE coalesce(matches.score, 0e0) END AS score
FROM texts LEFT JOIN base USING (row) LEFT JOIN matches USING (row)"""
