"""Operator 7: licence scan with a positional rare-token index, DataFrame functions only.

Words of a text are cut once. Over all documents each licence word gets its IDF; the index holds, for each
template, its words by falling IDF with their positions. In each file the licence words of highest IDF are
looked up: for a template they are taken from the rarest on until a match without any of them could no
longer reach ``min_share`` (so with these seeds no match is lost, however many notices a file has).
Templates whose words in the file weigh too little for a match are left out at once. The postings of the
seeds are intersected by relative position (place in the file minus place in the template); at each
distance that a seed gives, the share is the IDF of all template words that stand at that distance.
Last, a template counts if the file has its mandatory key phrases. Base phrases give base labels
whatever the index says.

The first pass writes ids, counts and, only for files with a core licence word (each key phrase has
one), their words to the shared folder; everything later is one projection over that, without a shuffle:
index and IDF have a size fixed by the templates and stand in the plan as constants.

Edge cases: null and empty texts have no words: null places, empty labels, score 0. Repeated rows each
get a row; ties between equal IDFs go by the word; an empty table gives an empty result; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castwright.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels (fixed values).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Templates: label, key phrases, words of the notice (fixed values: public licence notices).
TEMPLATES = [
    ("mit", ["mit license"], "released under the mit license"),
    ("mit", ["permission is hereby granted"], "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", ["apache license"], "licensed under the apache license version 2 0"),
    ("gpl", ["general public license"], "this work is licensed under the gnu general public license version 3"),
    ("gpl", ["gnu general public license"], "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", ["lesser general public license"], "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", ["affero general public license"], "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("bsd", ["redistribution and use in source"], "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", ["mozilla public license"], "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", ["licensed under cc by 4 0"], "licensed under cc by 4 0"),
    ("cc-by-sa", ["cc by sa"], "licensed under cc by sa 4 0"),
    ("cc-by-nc", ["cc by nc"], "licensed under cc by nc 4 0"),
    ("isc", ["permission to use copy modify"], "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", ["permission is hereby granted"], "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", ["apache license"], "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", ["gnu general public license"], "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
]
LABELS = sorted({label for label, _, _ in TEMPLATES})
#: Words of which each key phrase and base phrase has one.
CORE = ["license", "licensed", "permission", "redistribution", "cc"]
MIN_SHARE = 0.6
#: Weights are sums of doubles; what is left out must be short of the share by more than this.
CLOSE = 1e-9


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, A-Z lower-cased; null: none."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP)
    return F.array_remove(cut, "")


def _words(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def vocabulary() -> list[str]:
    """The distinct words of all templates."""
    return sorted({w for _, _, text in TEMPLATES for w in text.split()})


def _places(phrase: str, label: str) -> Column:
    """(start, label) of each place where the words of a phrase stand one after another."""
    wanted = phrase.split()

    def here(i: Column) -> Column:
        fits = F.get("words", i) == wanted[0]
        for k, w in enumerate(wanted[1:], 1):
            fits = fits & (F.get("words", i + k) == w)
        return F.coalesce(fits, F.lit(False))

    starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), here)
    return F.transform(starts, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))


def index_words(docs: DataFrame) -> DataFrame:
    """rid, doc_id, n_words, found (distinct licence words) and, with a core word, the words."""
    cut = docs.select("doc_id", words_of(F.col("text")).alias("all_words"))
    kept = F.when(F.arrays_overlap("all_words", _words(CORE)), F.col("all_words"))
    out = cut.select("doc_id", F.size("all_words").cast("long").alias("n_words"), F.array_intersect("all_words", _words(vocabulary())).alias("found"), kept.alias("words"))
    return materialize(out.withColumn("rid", F.monotonically_increasing_id()), "licence-words")


def idf(indexed: DataFrame) -> DataFrame:
    """word, idf of the licence words, over all documents."""
    n = indexed.count()
    df = indexed.select(F.explode("found").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return df.select("word", F.log1p(F.lit(n) / F.col("df")).alias("idf"))


def base_places(words: Column) -> Column:
    """The sorted (start, label) places of the base phrases in the array ``words``."""
    found = [_places(phrase, label) for phrase, label in PHRASES.items()]
    return F.when(F.array_contains(words, "license"), F.array_sort(F.flatten(F.array(*found))))


def index(weights: dict[str, float]) -> list[tuple[list[str], list[str], dict[str, float]]]:
    """For each template: its words in order, its distinct words by falling IDF, the weight of each (IDF
    times its places in the template)."""
    made = []
    for _, _, text in TEMPLATES:
        order = text.split()
        rare = sorted(set(order), key=lambda w: (-weights.get(w, 0.0), w))
        made.append((order, rare, {w: weights.get(w, 0.0) * order.count(w) for w in rare}))
    return made


def _template_share(order: list[str], rare: list[str], weight: dict[str, float], idf_of: dict[str, float], min_share: float) -> Column:
    """The best share of a template in a file with ``words`` and ``found``; null if below ``min_share``."""
    whole = sum(idf_of.get(w, 0.0) for w in order)
    if not whole:
        return F.lit(None).cast("double")
    entries = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(weight[w]).alias("weight"), F.array(*[F.lit(i) for i, x in enumerate(order) if x == w]).alias("tpos")) for w in rare])
    held = F.filter(entries, lambda e: F.array_contains("found", e["w"]))

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda s, e: s + e["weight"])

    present = total(held)
    # a match without the seeds weighs at most what is present less what they weigh
    seeds = F.filter(held, lambda e, i: present - total(F.slice(held, F.lit(1), i)) >= F.lit(min_share * whole - CLOSE))

    def starts(e: Column) -> Column:
        spots = F.filter(F.transform("words", lambda w, i: F.when(w == e["w"], i)), lambda i: i.isNotNull())
        return F.flatten(F.transform(e["tpos"], lambda at: F.transform(spots, lambda i: i - at)))

    aligned = F.array_distinct(F.flatten(F.transform(seeds, starts)))
    notice = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(idf_of.get(w, 0.0)).alias("idf"), F.lit(i).alias("at")) for i, w in enumerate(order)])

    def share(start: Column) -> Column:
        stands = lambda e: F.when((start + e["at"] >= 0) & (F.get("words", start + e["at"]) == e["w"]), e["idf"]).otherwise(0.0)
        return F.aggregate(notice, F.lit(0.0), lambda s, e: s + F.coalesce(stands(e), F.lit(0.0))) / F.lit(whole)

    best = F.least(F.array_max(F.transform(aligned, share)), F.lit(1.0))
    return F.when(present >= F.lit(min_share * whole - CLOSE), F.when(best >= min_share, best))


def with_matches(indexed: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """``indexed`` with matches: (template, share) of the templates whose words are aligned for at least
    ``min_share`` of their weight and whose key phrases the file has."""
    idf_of = {r["word"]: r["idf"] for r in materialize(idf(indexed), "licence-idf").collect()}  # at most the templates' words
    shares = [_template_share(*t, idf_of, min_share).alias(f"s{k}") for k, t in enumerate(index(idf_of))]
    searched = indexed.withColumn("shares", F.when(F.col("words").isNotNull(), F.struct(*shares)))
    text = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    verified = [F.when(F.col(f"shares.s{k}").isNotNull(), F.when(_all_in(text, phrases), F.struct(F.lit(k).alias("template"), F.col(f"shares.s{k}").alias("share"))))
                for k, (_, phrases, _) in enumerate(TEMPLATES)]
    return searched.withColumn("matches", F.array_compact(F.array(*verified))).drop("shares")


def template_matches(indexed: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """rid, template, share of every match."""
    return with_matches(indexed, min_share).select("rid", F.inline("matches"))


def _all_in(text: Column, phrases: list[str]) -> Column:
    out = F.lit(True)
    for p in phrases:
        out = out & F.contains(text, F.lit(f" {p} "))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, places (start, label), matches (label, share) of each row."""
    names = F.array(*[F.lit(label) for label, _, _ in TEMPLATES])
    met = with_matches(index_words(docs))
    best = [F.array_max(F.transform(F.filter("matches", lambda m: F.get(names, m["template"]) == label), lambda m: m["share"])) for label in LABELS]
    matches = F.array_compact(F.array(*[F.when(b.isNotNull(), F.struct(F.lit(label).alias("label"), b.alias("share"))) for label, b in zip(LABELS, best)]))
    empty = "array<struct<start: bigint, label: string>>", "array<struct<label: string, share: double>>"
    return met.select("doc_id", "n_words", F.coalesce(base_places(F.col("words")), F.array().cast(empty[0])).alias("places"), F.coalesce(matches, F.array().cast(empty[1])).alias("matches"))
