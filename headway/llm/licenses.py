"""License scans: phrases by place, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import query, table
from headway.session import written

# Phrase words and their label
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public license notices; the words of a template are its set of tokens
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-header": "you may not use this file except in compliance with the license",
    "bsd-3-clause": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "cc0-1.0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-header": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
# share of a template's tokens that a block must hold, in percent
CONTAINMENT_PERCENT = 80

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _literal(strings) -> Column:
    return F.array(*[F.lit(s) for s in strings])


def needed(template: str, percent: int) -> int:
    """How many tokens of a template a block must hold."""
    return max(1, math.ceil(len(set(template.split())) * percent / 100))


def scanned(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES,
            percent: int = CONTAINMENT_PERCENT) -> DataFrame:
    """Phrase places and license labels of every row of `docs` (doc_id, text).

    Words are runs of ASCII letters and digits and of all other characters above 127; letter case does not
    matter. Base places are those where a phrase's words stand consecutively, over line ends too. A block is
    a line; a template's label is added where a block holds at least `percent` of its distinct tokens.
    Null and empty texts have no words: counts 0, first_word and last_word null, labels empty, score 0.
    Score is 1 with a base place, else the greatest share of a template in a block that reached the limit.
    Phrases and templates are parameters, so everything derived from them alone is bounded. Returns row_id,
    doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; other columns are not read.
    """
    vocabulary = sorted({t for text in templates.values() for t in text.split()})
    rows = written(_rows(docs, phrases, vocabulary), "license-rows")
    found = _contained(rows, templates, percent, vocabulary)
    out = rows.drop("blocks").join(found.withColumnRenamed("row_id", "_row"), F.col("row_id") == F.col("_row"), "left").drop("_row")
    both = F.array_sort(F.array_union("base", F.coalesce("added", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select(
        "row_id", "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"), score.alias("score"))


def _rows(docs: DataFrame, phrases: dict[str, str], vocabulary: list[str]) -> DataFrame:
    """One scan: counts and places of the phrases, and each line's tokens that occur in some template."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id",
        F.concat(F.lit(" "), F.trim(F.regexp_replace(text, _GAP, " ")), F.lit(" ")).alias("flat"),
        F.split(F.regexp_replace(text, _GAP_IN_LINE, " "), "\n").alias("lines"),
    )
    counts, firsts, lasts, names = [], [], [], []
    for phrase, label in phrases.items():
        n = F.regexp_count("flat", F.lit(f"(?i) {phrase}(?= )"))
        counts.append(n)
        firsts.append(F.when(n > 0, _blanks(F.regexp_extract("flat", f"(?is)^(.*?) {phrase}(?= )", 1))))
        lasts.append(F.when(n > 0, _blanks(F.regexp_extract("flat", f"(?is)^(.*) {phrase}(?= )", 1))))
        names.append(F.when(n > 0, F.lit(label)))
    null = F.lit(None).cast("int")
    known = F.transform("lines", lambda line: F.array_intersect(F.split(F.lower(line), " "), _literal(vocabulary)))
    return df.select(
        "row_id", "doc_id",
        F.when(F.length("flat") <= 2, 0).otherwise(_blanks(F.col("flat")) - 1).cast("long").alias("n_words"),
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts, null, null).cast("long").alias("first_word"), F.greatest(*lasts, null, null).cast("long").alias("last_word"),
        F.array_distinct(F.array_compact(F.array(*names))).alias("base"), F.filter(known, lambda block: F.size(block) > 0).alias("blocks"))


def _contained(rows: DataFrame, templates: dict[str, str], percent: int, vocabulary: list[str]) -> DataFrame:
    """Set-similarity join: row_id, the labels whose template some block contains, and the greatest share.

    Tokens are ordered by the number of blocks that hold them, rarest first. A block can only contain a
    template if it holds one of the template's first size - needed + 1 tokens (prefix), at least `needed`
    known tokens (length), and enough of both lists is left after the first common token (position).
    """
    blocks = rows.select("row_id", F.posexplode("blocks").alias("block", "tokens"))
    # one row per template token: bounded by the templates
    held = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    order = {t: 0 for t in vocabulary} | {r["token"]: r["n"] for r in held.collect()}
    place = {t: i for i, t in enumerate(sorted(order, key=lambda t: (order[t], t)))}
    prefixes, names, least = [], sorted(templates), min(needed(t, percent) for t in templates.values())
    for number, name in enumerate(names):
        tokens, must = sorted(place[t] for t in set(templates[name].split())), needed(templates[name], percent)
        prefixes += [(token, number, at, len(tokens), must) for at, token in enumerate(tokens[:len(tokens) - must + 1])]
    names_of = ("token", "template", "at", "size", "must")
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names_of, row)]) for row in prefixes]
    probe = F.broadcast(rows.sparkSession.range(1).select(F.inline(F.array(*structs))))
    whole = _literal_sets([sorted(place[t] for t in set(templates[n].split())) for n in names])
    to_place = F.create_map(*[F.lit(x) for item in place.items() for x in item])
    sets = blocks.where(F.size("tokens") >= least).select(
        "row_id", "block", F.array_sort(F.transform("tokens", lambda t: to_place[t])).alias("own"))
    first = sets.select("row_id", "block", "own", F.posexplode(F.slice("own", 1, F.size("own") - least + 1)).alias("pos", "token"))
    can = 1 + F.least(F.col("size") - F.col("at") - 1, F.size("own") - F.col("pos") - 1)
    pairs = first.join(probe, "token").where((F.size("own") >= F.col("must")) & (can >= F.col("must")))
    shared = F.size(F.array_intersect("own", F.element_at(whole, F.col("template") + 1)))
    hits = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("must"))
    label = F.element_at(_literal(names), F.col("template") + 1)
    # a pair that meets in several prefix tokens gives the same label and share each time
    return hits.groupBy("row_id").agg(F.collect_set(label).alias("added"), F.max(F.col("shared") / F.col("size")).alias("share"))


def _literal_sets(sets: list[list[int]]) -> Column:
    return F.array(*[F.array(*[F.lit(x) for x in s]) for s in sets])


def _sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    double = {p: "  ".join(p.split()) for p in PHRASES}
    count = {p: f"((len(flat) - len(replace(flat, ' {d} ', ''))) // {len(d) + 2})" for p, d in double.items()}
    first = {p: f"CASE WHEN {count[p]} > 0 THEN (len(left(flat, strpos(flat, ' {d} ') - 1)) - len(replace(left(flat, strpos(flat, ' {d} ') - 1), ' ', ''))) END"
             for p, d in double.items()}
    tail = {p: f"right(flat, strpos(reverse(flat), reverse(' {d} ')) + {len(d) + 1})" for p, d in double.items()}
    last = {p: f"CASE WHEN {count[p]} > 0 THEN (len(flat) - len(replace(flat, ' ', ''))) - (len({tail[p]}) - len(replace({tail[p]}, ' ', ''))) END" for p in double}
    names = ", ".join(f"CASE WHEN {count[p]} > 0 THEN '{label}' END" for p, label in PHRASES.items())
    sets = ", ".join(f"('{n}', {sorted(set(t.split()))}, {needed(t, CONTAINMENT_PERCENT)})" for n, t in TEMPLATES.items())
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS low, lower(coalesce(text, '')) AS folded FROM documents),
w AS (
  SELECT rid, doc_id, folded, trim(regexp_replace(low, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) AS plain FROM t),
f AS (
  SELECT rid, doc_id, folded, CASE WHEN plain = '' THEN 0 ELSE len(plain) - len(replace(plain, ' ', '')) + 1 END AS n_words,
         ' ' || replace(plain, ' ', '  ') || ' ' AS flat FROM w),
b AS (
  SELECT rid, doc_id, n_words, {' + '.join(count.values())} AS n_base, least({', '.join(first.values())}) // 2 AS first_word,
         greatest({', '.join(last.values())}) // 2 AS last_word, list_filter([{names}], lambda x: x IS NOT NULL) AS base FROM f),
lines AS (
  SELECT rid, list_distinct(string_split(regexp_replace(line, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ')) AS own
  FROM (SELECT rid, unnest(string_split(folded, chr(10))) AS line FROM t)),
sets(name, tokens, must) AS (VALUES {sets}),
hits AS (
  SELECT rid, name, max(len(list_intersect(own, tokens))::DOUBLE / len(tokens)) AS share
  FROM lines, sets WHERE len(list_intersect(own, tokens)) >= must GROUP BY rid, name),
added AS (SELECT rid, list(name) AS names, max(share) AS share FROM hits GROUP BY rid)
SELECT doc_id, n_words::BIGINT AS n_words, n_base::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(names, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM b LEFT JOIN added USING (rid)
"""


@query("op10_licenses", _sql())
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents")).drop("row_id")
