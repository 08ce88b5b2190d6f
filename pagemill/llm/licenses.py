"""License scans: base phrases and template containment.  DataFrame functions only.

Words are the runs of letters, digits and characters beyond ASCII; A-Z count as a-z.  *Base* finds every
place where a fixed phrase's words stand one after the other.  The *method* is an exact set-similarity
join between text blocks and license templates: a pair qualifies when the block holds at least ``threshold``
of the template's distinct words.

Blocks take no notice of lines, so a notice is found however it is wrapped or set off as a comment.  For
templates of up to L words (L a power of two, 8 at least) they are stretches of 2 L words that begin at every
L-th word: each stretch of L words lies whole in one of them, and they cover the text.

Tokens are ordered by how many documents of the whole table hold them, rarest first.  Only tokens of a
template can make an overlap, so blocks are cut to those.  With ``need = ceil(threshold * size)``:

* prefix filter: block and template must share one of the template's ``size - need + 1`` rarest tokens, so
  only blocks around such a word are looked at;
* length filter: the block must hold ``need`` template tokens;
* positional filter: with the shared token at positions i and j, ``1 + min(tokens after i, tokens after j)``
  must reach ``need`` for the first token that is shared;
* the pairs that are left are compared whole.

Blocks are made within a document's row and joined with the templates by token, so nothing but the results is
shuffled.  The templates are a parameter and bounded by ``MAX_TEMPLATE_TOKENS``; that bound covers what is broadcast.

Defined results: null and empty texts have no words, null positions, empty labels and score 0; rows that repeat
a doc_id, null ones too, each get a row of their own text; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
import math
import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Own labels: distinctive sentences of well-known licence notices.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit-release": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
THRESHOLD = 0.8
MAX_TEMPLATE_TOKENS = 50_000
#: Characters that are no word's, and those that are.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def phrase_pattern(phrase: str) -> str:
    """Finds the phrase's words in a text that isn't lower-cased; (?i) alone takes A-Z only."""
    return rf"(?<!{WORD}){f'{GAP}++'.join(phrase.split())}(?!{WORD})"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"{WORD}++")).cast("long")


def words_in(text: Column) -> Column:
    """A text's words in lower case, in order."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), rf"{GAP}+"), "")


def with_base(rows: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """Adds n_base, first_word, last_word and base_labels to rows with text and words."""
    if not phrases:
        none = F.lit(None).cast("long")
        return rows.withColumns({"n_base": F.lit(0).cast("long"), "first_word": none, "last_word": none, "base_labels": F.array().cast("array<string>")})
    anywhere = "(?i)(?:" + "|".join(phrase_pattern(p) for p in phrases) + ")"
    # a plain search first: few texts hold all words of a phrase anywhere
    lower = F.lower("text")
    likely = reduce(or_, [reduce(and_, [F.contains(lower, F.lit(w)) for w in p.split()]) for p in phrases])
    # cut before each place; the line feed in front adds no word and keeps the first cut from the start
    parts = F.when(likely & F.col("text").rlike(anywhere), F.split(F.concat(F.lit("\n"), "text"), rf"(?={anywhere})")).otherwise(F.array(F.lit("")))
    rows = rows.withColumn("parts", parts)  # a column, so that it is computed once
    found = F.size("parts") > 1
    labels = [F.when(found & F.col("text").rlike("(?i)" + phrase_pattern(p)), F.lit(label)) for p, label in phrases.items()]
    return rows.withColumns({
        "n_base": (F.size("parts") - 1).cast("long"),
        "first_word": F.when(found, n_words(F.element_at("parts", 1))),
        "last_word": F.when(found, F.size("words") - n_words(F.element_at("parts", -1))),
        "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }).drop("parts")


def block_words(n: int) -> int:
    """The class of a template of ``n`` words: the power of two that holds them."""
    return max(8, 1 << (n - 1).bit_length())


def token_order(docs: DataFrame, text_col: str, tokens: list[str]) -> list[str]:
    """Template tokens, those that the fewest documents of the whole table hold first; ties by the token."""
    held = F.array_intersect(words_in(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), F.array(*map(F.lit, tokens)))
    # one row a template token
    count = {r.token: r.n for r in docs.select(F.explode(held).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(tokens, key=lambda t: (count.get(t, 0), t))


def literal_rows(spark, rows: list[dict], schema: str) -> DataFrame:
    """Few rows that the driver made, as a plan without Python."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _blocks(words: Column, wide: int, order: list[str], places: Column) -> Column:
    """(wide, held) of the blocks of a class that hold one of the given places; held: their template tokens, rarest first."""
    numbers = F.array_distinct(F.flatten(F.transform(places, lambda i: F.array((i / wide).cast("int"), (i / wide).cast("int") - 1))))
    ranked = F.array(*map(F.lit, order))
    held = lambda b: F.array_intersect(ranked, F.slice(words, b * wide + 1, F.lit(2 * wide)))
    return F.transform(F.filter(numbers, lambda b: b >= 0), lambda b: F.struct(F.lit(wide).alias("wide"), held(b).alias("held")))


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    whole = {label: words_of(t) for label, t in (TEMPLATES if templates is None else templates).items()}
    whole = {label: words for label, words in whole.items() if words}
    if sum(map(len, whole.values())) > MAX_TEMPLATE_TOKENS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_TOKENS} tokens; scan them in groups")
    tokens = sorted(set().union(*whole.values())) if whole else []
    order = token_order(docs, text_col, tokens) if whole else []
    place = {t: i for i, t in enumerate(order)}
    postings = []
    for label, words in whole.items():
        ranked = sorted(set(words), key=place.__getitem__)
        need = math.ceil(threshold * len(ranked) - 1e-9)
        postings += [{"wide": block_words(len(words)), "token": t, "label": label, "i": i, "need": need, "words": ranked} for i, t in enumerate(ranked[: len(ranked) - need + 1])]
    posted = literal_rows(docs.sparkSession, postings, "wide:int,token:string,label:string,i:int,need:int,words:array<string>")
    prefix = sorted({p["token"] for p in postings})
    least = min((p["need"] for p in postings), default=1)

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), words_in(text).alias("words"))
    found = F.filter(F.transform("words", lambda w, i: F.when(w.isin(prefix), i)), lambda i: i.isNotNull())
    none = F.array().cast("array<int>")
    # a plain look first: texts without any such word are passed over
    places = F.when(F.arrays_overlap("words", F.array(*map(F.lit, prefix))), found).otherwise(none) if prefix else none
    base = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    rows = with_base(rows, PHRASES if phrases is None else phrases).withColumns({"n_words": F.size("words").cast("long"), "places": places})
    blocks = [_blocks(F.col("words"), wide, order, F.col("places")) for wide in sorted({p["wide"] for p in postings})]
    near = F.filter(F.concat(*blocks), lambda b: F.size(b["held"]) >= least) if blocks else F.array().cast("array<struct<wide:int,held:array<string>>>")
    one = rows.select(*base, F.explode_outer(near).alias("b")).select(*base, F.col("b.wide").alias("b_wide"), F.col("b.held").alias("held"))
    n_held = F.size("held")
    two = one.select(*base, "b_wide", "held", F.posexplode_outer(F.slice("held", F.lit(1), n_held - least + 1)).alias("j", "b_token"))
    # MAX_TEMPLATE_TOKENS rows at most
    meets = (F.col("b_token") == F.col("token")) & (F.col("b_wide") == F.col("wide")) & (n_held >= F.col("need")) & (1 + F.least(F.size("words") - 1 - F.col("i"), n_held - 1 - F.col("j")) >= F.col("need"))
    hit = two.join(F.broadcast(posted), meets, "left").withColumn("overlap", F.size(F.array_intersect("held", "words")))
    enough = F.col("overlap") >= F.col("need")
    per = hit.groupBy(*base).agg(F.collect_set(F.when(enough, F.col("label"))).alias("own"), F.max(F.when(enough, F.col("overlap") / F.size("words"))).alias("similar"))
    return per.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base_labels", "own")), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)), F.coalesce("similar", F.lit(0.0))).alias("score"),
    )
