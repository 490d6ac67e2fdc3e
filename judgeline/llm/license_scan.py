"""Licence scans with a positional index of rare licence words.

Each document is cut into words once; the words that occur in any licence
template are kept with their places ("hits", one long each).  Document
frequencies of the licence words over all documents give their IDF.  A template
is indexed under the rarest word of its mandatory key phrases, which every
alignment that counts must have in place; a template without key phrases under as
many rare words as leave too little IDF in the others.  Where a document has such
a word, its place minus the word's place in the template proposes an alignment, and intersecting the
template's postings, shifted there, with the document's hits tells which of its
words stand where they should.  An alignment counts when the matched words carry
enough IDF and every mandatory key phrase stands complete.

The licence vocabulary is bounded by the templates, which are a parameter; the
rows of documents never leave the executors.

Defined cases: a null text counts as empty (no words, no labels, score 0); equal
alignments count once; repeated rows are scanned one by one; an empty table gives
an empty result.  Columns other than doc_id and text are not read.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import constant, lower_ascii
from judgeline.session import cut_lineage

LICENCE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_MATCH = 0.75          # share of a template's IDF that must match in place

#: Phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Fixed values: (label, passage of a public licence or of its usual notice,
#: key phrases that must stand complete).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("permission is hereby granted free of charge",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("apache-2", "you may obtain a copy of the license at http www apache org licenses license 2 0",
     ("apache org licenses license 2",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license",
     ("attribution noncommercial",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license",
     ("attribution sharealike",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("attribution 4 0",)),
    ("cc0", "creative commons cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license version 3",)),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license",
     ("gnu general public license", "version 3")),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license",
     ("gnu general public license", "version 2")),
    ("lgpl-3", "gnu lesser general public license as published by the free software foundation either version 3",
     ("lesser general public license", "version 3")),
    ("agpl-3", "gnu affero general public license as published by the free software foundation either version 3",
     ("affero general public license", "version 3")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source and binary forms",)),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     ("permission to use copy modify and or distribute",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
)


def _vocabulary(templates, phrases) -> list[str]:
    texts = [t for _, t, _ in templates] + [p for p, _ in phrases]
    return sorted({w for t in texts for w in t.split()})


def _hits(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n_words, hits: (word's number << 32) + place, by place."""
    words = F.regexp_extract_all(lower_ascii(F.coalesce(docs["text"], F.lit(""))), F.lit(LICENCE_WORD), F.lit(0))
    d = docs.select(docs["doc_id"].alias("doc_id"), words.alias("w"))
    known = F.array(*[F.lit(w) for w in vocabulary])
    placed = F.filter(F.transform("w", lambda x, i: F.when(x.isin(vocabulary), F.struct(x.alias("x"), i.alias("i")))),
                      lambda h: h.isNotNull())
    code = F.transform(placed, lambda h: F.shiftleft(F.array_position(known, h["x"]), 32) + h["i"].cast("long"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_words"), code.alias("hits"))


def _idf(hits: DataFrame, n: int) -> list[float]:
    """IDF by word number (from 1); the vocabulary bounds what is collected."""
    numbers = F.array_distinct(F.transform("hits", lambda h: F.shiftright(h, 32)))
    counted = hits.select(F.explode(numbers).alias("word")).groupBy("word").count().collect()
    found, total = {r["word"]: r["count"] for r in counted}, hits.count()
    return [math.log((total + 1) / (found.get(i, 0) + 1)) + 1e-6 for i in range(1, n + 1)]


def _prepared(templates, vocabulary, idf, min_match) -> tuple[list[dict], dict[int, list[int]]]:
    """Templates as numbers, and the index: word number -> alignment seeds."""
    number = {w: i for i, w in enumerate(vocabulary, 1)}
    out, index = [], {}
    for t, (label, text, phrases) in enumerate(templates):
        words = text.split()
        places = [(number[w] << 32) + q for q, w in enumerate(words)]
        keys = []
        for phrase in phrases:
            p = phrase.split()
            q = next(q for q in range(len(words)) if words[q:q + len(p)] == p)
            keys += places[q:q + len(p)]
        out.append({"label": label, "codes": places, "keys": sorted(set(keys)),
                    "weight": sum(idf[number[w] - 1] for w in words)})
        weigh = lambda q: (-idf[number[words[q]] - 1], words[q], q)
        first = {code & (2**32 - 1) for code in keys}
        if first:
            seeds = [min(first, key=weigh)]
        else:       # places, rarest words first, until the others cannot be enough
            order, left, seeds = sorted(range(len(words)), key=weigh), out[-1]["weight"], []
            while len(seeds) < len(order) and left >= min_match * out[-1]["weight"] * (1 - 1e-9):
                seeds.append(order[len(seeds)])
                left -= idf[number[words[seeds[-1]]] - 1]
        for q in seeds:     # seed + place of the hit = (template << 32) + 2**20 + offset
            index.setdefault(number[words[q]], []).append((t << 32) + 2**20 - q)
    return out, index


def _phrase_places(phrase: str, number: dict[str, int]):
    """Places (array<long>) where a phrase's words stand one after the other."""
    def starts(k: int, word: int):
        own = F.filter("hits", lambda h: F.shiftright(h, 32) == word)
        return F.transform(own, lambda h: h.bitwiseAND(F.lit(2**32 - 1)) - k)

    every = [starts(k, number[w]) for k, w in enumerate(phrase.split())]
    return reduce(F.array_intersect, every)


def scan(docs: DataFrame, templates=TEMPLATES, base_phrases=BASE_PHRASES,
         min_match: float = MIN_MATCH) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    and ``matches``: (label, place, share of IDF matched) of each alignment."""
    vocabulary = _vocabulary(templates, base_phrases)
    number = {w: i for i, w in enumerate(vocabulary, 1)}
    hits = cut_lineage(_hits(docs, vocabulary))
    idf = _idf(hits, len(vocabulary))
    known, index = _prepared(templates, vocabulary, idf, min_match)

    rare = sorted(index)
    seeds = constant([index.get(i, []) for i in range(1, len(vocabulary) + 1)], "array<array<bigint>>")
    weights = constant(idf, "array<double>")
    texts = constant(known, "array<struct<label:string,codes:array<bigint>,keys:array<bigint>,weight:double>>")
    place = F.lit(2**32 - 1)
    proposed = F.array_distinct(F.flatten(F.transform(
        F.filter("hits", lambda h: F.shiftright(h, 32).isin(rare)),
        lambda h: F.transform(F.element_at(seeds, F.shiftright(h, 32).cast("int")),
                              lambda s: s + h.bitwiseAND(place)))))

    def aligned(c):
        t = F.element_at(texts, (F.shiftright(c, 32) + 1).cast("int"))
        offset = c.bitwiseAND(place) - 2**20
        found = F.array_intersect(F.transform(t["codes"], lambda x: x + offset), F.col("hits"))
        keys = F.transform(t["keys"], lambda x: x + offset)
        matched = F.aggregate(found, F.lit(0.0), lambda a, x: a + F.element_at(weights, F.shiftright(x, 32).cast("int")))
        return F.struct(t["label"].alias("label"), offset.alias("place"),
                        F.least(F.lit(1.0), matched / t["weight"]).alias("share"),
                        (F.size(F.array_except(keys, found)) == 0).alias("keys"))

    base = [(label, _phrase_places(p, number)) for p, label in base_phrases]
    d = hits.select("doc_id", "n_words", proposed.alias("proposed"), "hits",
                    *[places.alias(f"base_{i}") for i, (_, places) in enumerate(base)])
    accepted = F.filter(F.transform("proposed", aligned), lambda m: m["keys"] & (m["share"] >= min_match))
    every = F.concat(*[F.col(f"base_{i}") for i in range(len(base))])
    d = d.select("doc_id", "n_words", every.alias("places"), F.transform(
        accepted, lambda m: F.struct(m["label"].alias("label"), m["place"].alias("place"), m["share"].alias("share"))
        ).alias("matches"), F.array_compact(F.array(*[F.when(F.size(f"base_{i}") > 0, F.lit(label))
                                                       for i, (label, _) in enumerate(base)])).alias("base"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.array_max(F.transform("matches", lambda m: m["share"]))
    return d.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.transform("matches", lambda m: m["label"]))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
        "matches")
