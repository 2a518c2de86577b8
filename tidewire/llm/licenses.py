"""License scans with a positional rare-token index.

Templates are indexed by word: (word, template, position). A file's licence words look the templates
up; only postings that agree on the relative position (place in the file less place in the template)
make a template a candidate. Of its words in the file those with the highest IDF then vote by
relative position, and the mandatory key phrase of what was voted for is verified last. No Python
workers take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Phrases whose places are counted, and their labels (fixed values of the contract).
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: label, template words, mandatory key phrase. Templates are the running text of notices and licences, as words.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "permission is hereby granted free of charge"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and or distribute this software"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", "gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "redistribution and use in source and binary forms"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", "mozilla public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "any person or organization obtaining a copy of the software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all rights to the work worldwide under copyright law", "dedicated the work to the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means without the prior written permission of the publisher", "all rights reserved"),
)
#: Template words too common to look up.
COMMON = frozenset("a all an and any are as at be been but by can do each either for from has have if in into is it its may must no not of on one or other part so such that the this to under use was were which who whom will with work you your 0 2 4 v".split())
#: Words looked up for each file and template, and those that must agree on a relative position.
LOOKED_UP, MIN_AGREEING = 8, 2
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

VOCABULARY = sorted({w for _, words, _ in TEMPLATES for w in words.split()} - COMMON)
#: How postings are packed into a long: template, relative position (shifted to be positive), word.
WORD_BITS, PLACE_BITS, SHIFT = 9, 32, 1 << 12


def postings() -> dict[str, list[int]]:
    """For each licence word its places in the templates, packed; a file's position, shifted by ``WORD_BITS``, is added to them."""
    found: dict[str, list[int]] = {w: [] for w in VOCABULARY}
    for t, (_, words, _) in enumerate(TEMPLATES):
        for at, w in enumerate(words.split()):
            if w in found:
                found[w].append((t << PLACE_BITS + WORD_BITS) + (SHIFT - at << WORD_BITS) + VOCABULARY.index(w))
    return found


def lookups(words: str) -> int:
    """How many words of a template are looked up at most."""
    return min(LOOKED_UP, len(set(words.split()) - COMMON))


def spaced_words(text: Column) -> Column:
    """A-Z lower-cased, words joined by single spaces."""
    # lower() maps KELVIN SIGN, alone outside ASCII, to an ASCII letter as a whole; it must stay a foreign letter
    lower = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))
    return F.btrim(F.regexp_replace(lower, WORD_GAP, " "))


def aligned_templates(looked_up: Column) -> Column:
    """Templates of which two different words stand at one relative position, from a file's sorted packed postings."""
    place = lambda c: F.shiftright(c, WORD_BITS)
    # equal postings stand together, so two words of one place are neighbours somewhere
    pairs = F.arrays_zip(F.slice(looked_up, 1, F.greatest(F.size(looked_up) - 1, F.lit(0))).alias("a"), F.slice(looked_up, 2, F.greatest(F.size(looked_up) - 1, F.lit(0))).alias("b"))
    agree = F.filter(pairs, lambda p: (place(p["a"]) == place(p["b"])) & (p["a"] != p["b"]))
    return F.array_distinct(F.transform(agree, lambda p: F.shiftright(p["a"], PLACE_BITS + WORD_BITS).cast("int")))


def word_scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and, from each whole text, its word count, phrase places and licence words; where the index gives candidate templates, these, the hits and the words too."""
    kept = [F.col(f"`{c}`") for c in keep]
    norm, words = F.col("__norm"), F.col("__words")
    a = docs.select(*kept, spaced_words(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__norm"))
    a = a.select(*kept, "__norm", F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " ")).alias("__words"))
    vocabulary = F.array(*map(F.lit, VOCABULARY))
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos"))), lambda s: s["word"].isin(VOCABULARY))
    a = a.select(*kept, F.size(words).cast("long").alias("n_words"), padded.alias("__padded"), F.array_intersect(words, vocabulary).alias("__seen"), "__words")
    a = a.select(*kept, "n_words", "__padded", "__seen", F.when(F.size("__seen") >= MIN_AGREEING, hits).alias("__hits"))
    index = F.create_map(*[x for w, found in postings().items() for x in (F.lit(w), F.array(*map(F.lit, found)).cast("array<bigint>"))])
    looked_up = F.sort_array(F.flatten(F.transform("__hits", lambda h: F.transform(index[h["word"]], lambda p: p + F.shiftleft(h["pos"].cast("long"), WORD_BITS)))))
    a = a.select("*", looked_up.alias("__looked_up"))
    padded, phrases = F.col("__padded"), []
    for k, (phrase, _) in enumerate(PHRASES):
        pieces = F.when(F.contains(padded, F.lit(f" {phrase} ")), F.split(padded, f"(?<= ){phrase}(?= )", -1))
        phrases.append(pieces.alias(f"__p{k}"))
    a = a.select(*kept, "n_words", "__padded", "__seen", "__hits", aligned_templates(F.col("__looked_up")).alias("__templates"), *phrases)
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    found, first, last = [], [], []
    for k, (phrase, _) in enumerate(PHRASES):
        p = F.col(f"__p{k}")
        found.append(F.coalesce(F.size(p) - 1, F.lit(0)))
        first.append((spaces(F.get(p, F.lit(0))) - 1).cast("long"))
        # after the last place stand as many words as spaces, less one
        last.append((F.col("n_words") - spaces(F.element_at(p, -1)) + 1 - len(phrase.split())).cast("long"))
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.col(f"__p{k}").isNotNull(), F.lit(label)) for k, (_, label) in enumerate(PHRASES)]))))
    total = found[0]
    for n in found[1:]:
        total = total + n
    candidate = lambda c: F.when(F.size("__templates") > 0, F.col(c)).alias(c)
    return a.select(*kept, "n_words", total.cast("long").alias("n_base"), F.least(*first).alias("first_word"), F.greatest(*last).alias("last_word"), labels.alias("__base"), "__seen", *map(candidate, ("__templates", "__hits", "__padded")))


def template_votes(scanned: DataFrame, row: str) -> DataFrame:
    """(row, template, agreeing): for each file and candidate template the most of its rarest words in the file at one relative position."""
    spark = scanned.sparkSession
    places = [(w, t, i) for t, (_, words, _) in enumerate(TEMPLATES) for i, w in enumerate(words.split()) if w not in COMMON]
    index = spark.createDataFrame(places, "word string, template int, at int")
    # document frequencies: one row for each vocabulary word at most; as N is the same for all words, the order by IDF is that by frequency
    df = scanned.where(F.size("__seen") > 0).select(F.explode("__seen").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    ranked = index.select("template", "word").distinct().join(F.broadcast(df), "word").groupBy("template").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("__ranked"))
    each = scanned.where(F.size("__templates") > 0).select(row, F.explode("__templates").alias("template"), "__seen", "__hits").join(F.broadcast(ranked), "template")
    chosen = F.slice(F.filter(F.transform("__ranked", lambda r: r["word"]), lambda w: F.array_contains("__seen", w)), 1, LOOKED_UP)
    rare = each.select(row, "template", "__hits", chosen.alias("__chosen")).select(row, "template", F.explode(F.filter("__hits", lambda h: F.array_contains("__chosen", h["word"]))).alias("h")).select(row, "template", "h.word", "h.pos")
    aligned = rare.join(F.broadcast(index), ["template", "word"]).groupBy(row, "template", (F.col("pos") - F.col("at")).alias("offset")).agg(F.count_distinct("word").alias("agreeing"))
    return aligned.groupBy(row, "template").agg(F.max("agreeing").alias("agreeing"))


def scan_licenses(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, n_base, first_word, last_word, base_labels, labels and score for each row.

    The score is the largest share of a template's looked-up words found in place, over templates
    with their key phrase; a base label alone scores 0.5. Null and empty texts have no words and no
    labels. Repeated rows are scanned each; an empty table gives an empty result; extra columns are
    ignored, and kept ones that clash with a result column give way to it.
    """
    new = {"n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"}
    keep = [c for c in dict.fromkeys(keep) if c not in new]
    scanned = written(word_scan(docs, keep, text).withColumn("__file", F.monotonically_increasing_id()), "licenses")
    size = F.create_map(*[F.lit(x) for t, (_, words, _) in enumerate(TEMPLATES) for x in (t, lookups(words))])
    label = F.create_map(*[F.lit(x) for t, (name, _, _) in enumerate(TEMPLATES) for x in (t, name)])
    votes = template_votes(scanned, "__file").where(F.col("agreeing") >= MIN_AGREEING)
    # a file has as many voted templates as there are templates at most
    found = votes.groupBy(F.col("__file").alias("__f")).agg(F.collect_list(F.struct("template", "agreeing")).alias("__votes"))
    phrase = F.array(*[F.lit(f" {key} ") for _, _, key in TEMPLATES])
    out = scanned.join(found, F.col("__file") == F.col("__f"), "left")
    out = out.withColumn("__votes", F.filter("__votes", lambda v: F.contains(F.col("__padded"), phrase[v["template"]]))).drop("__padded", "__hits")
    out = out.withColumns({"__labels": F.transform("__votes", lambda v: label[v["template"]]), "__score": F.array_max(F.transform("__votes", lambda v: v["agreeing"] / size[v["template"]]))})
    base = F.col("__base")
    return out.select(
        *[F.col(f"`{c}`") for c in keep], "n_words", "n_base", "first_word", "last_word",
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("__labels", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(F.coalesce("__score", F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"),
    )
