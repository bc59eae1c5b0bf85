"""Licence scans by a positional rare-token index. Spark functions only.

Base labels come from phrases whose words stand consecutively. The method adds labels of licence texts: the
positions of template words in every document are indexed; the RARE words of a file with the highest
inverse document frequency over the corpus are looked up in the templates' postings, and beside them, for each template whose
mandatory phrases are all in the file, the RARE rarest of its own words there, so that no text crowds out another; postings that
agree on a template and a relative position vote for it; a template with MIN_VOTES is taken if its mandatory
phrases are all in the document.

A null or empty text has no words and no labels, score 0. Equal rows get equal results, one each; ids may
repeat or be null. A score is 1 with a base label, else the best accepted template's share of aligned words.
"""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.llm.texts import alnum_words, row_key, same_key, stage

# Phrases and labels of the contract.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: A word each base phrase needs.
HEADS = {"gnu general public license": "gnu", "apache license": "apache", "cc by": "cc", "mit license": "mit"}

# Openings of public licence texts and notices, and phrases a copy must have.
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license version 2 0",),
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    "cc-by-4.0": (
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international",),
    ),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ("licensed under cc by nc",)),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        ("terms of the gnu general public license", "free software foundation"),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    "lgpl-notice": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    "mit-notice": ("released under the mit license", ("under the mit license",)),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("terms of the mozilla public license v 2 0",),
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software released into the public domain",),
    ),
}
RARE, MIN_VOTES, MIN_LETTERS = 8, 2, 2
KEY = ["doc_id", "_k1", "_k2"]


def template_postings() -> list[tuple[str, str, int]]:
    """(word, template, position) of template words that tell licences from prose: short words are left out."""
    return [
        (w, name, i)
        for name, (text, _) in TEMPLATES.items()
        for i, w in enumerate(text.split())
        if len(w) > MIN_LETTERS and not re.fullmatch("the|and|this|that|are|you|can|for|with|from|not|any|all|may", w)
    ]


def template_sizes() -> dict[str, int]:
    return {name: min(RARE, len({w for w, n, _ in template_postings() if n == name})) for name in TEMPLATES}


def starts_of(phrase: str, words: Column) -> Column:
    """Positions where a phrase's words stand consecutively; looked for only in texts with its rare word."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    at = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + k) == w for k, w in enumerate(parts)])
    none = F.array().cast("array<int>")
    return F.when((last >= 0) & F.array_contains(words, HEADS[phrase]), F.filter(F.sequence(F.lit(0), last), at)).otherwise(none)


def key_phrases(words: Column) -> Column:
    """Which mandatory phrases of the templates a document has."""
    wanted = sorted({p for _, phrases in TEMPLATES.values() for p in phrases})
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    found = F.array(*[F.when(F.contains(joined, F.lit(f" {p} ")), F.lit(p)) for p in wanted])
    some = F.arrays_overlap(words, F.array(*[F.lit(w) for w in ("license", "licensed", "permission", "redistribution", "software")]))
    return F.when(some, F.array_compact(found)).otherwise(F.array().cast("array<string>"))


def base_scan(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Document key, n_words, base places and mandatory phrases of every row."""
    words = docs.select(*row_key(doc_id, text), alnum_words(F.col(text)).alias("words"))
    places = words.select(*KEY, "words", *[starts_of(p, F.col("words")).alias(label) for p, label in PHRASES.items()])
    every = F.concat(*[F.col(f"`{label}`") for label in PHRASES.values()])
    labels = F.array_sort(F.array_compact(F.array(*[F.when(F.size(F.col(f"`{x}`")) > 0, F.lit(x)) for x in PHRASES.values()])))
    return places.select(
        *KEY, F.size("words").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        labels.alias("base_labels"), key_phrases(F.col("words")).alias("phrases"),
    )


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The index: (document key, pos, word) of all template words in all documents."""
    words = docs.select(*row_key(doc_id, text), F.posexplode(alnum_words(F.col(text))).alias("pos", "word"))
    return words.filter(F.col("word").isin(sorted({w for w, _, _ in template_postings()})))


def known_postings(index: DataFrame) -> DataFrame:
    """(word, template, at): the templates' postings as a table."""
    rows = [F.struct(F.lit(w).alias("word"), F.lit(t).alias("template"), F.lit(p).alias("at")) for w, t, p in template_postings()]
    return index.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def rare_words(index: DataFrame, n_docs: int) -> DataFrame:
    """(document key, word, template): by IDF, ties by the word, the RARE rarest template words of each file for any
    template (null) and the RARE rarest words of each template in each file."""
    own = index.select(*KEY, "word").distinct()
    idf = own.groupBy("word").agg(F.log((F.lit(n_docs) + 1.0) / (F.count(F.lit(1)) + 1.0)).alias("idf"))
    scored = own.join(F.broadcast(idf), "word")  # idf: a row per template word at most
    templates = known_postings(index).groupBy("word").agg(F.array_distinct(F.concat(F.array(F.lit(None).cast("string")), F.collect_list("template"))).alias("templates"))
    each = scored.join(F.broadcast(templates), "word").select(*KEY, "idf", "word", F.explode("templates").alias("template"))
    ranked = each.groupBy(*KEY, "template").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("idf")).alias("order"), "word"))), 1, RARE).alias("top")
    )
    return ranked.select(*KEY, "template", F.explode("top.word").alias("word"))


def template_votes(index: DataFrame, rare: DataFrame) -> DataFrame:
    """(document key, template, votes): most distinct rare words that agree on one relative position."""
    keyed = rare.groupBy(*[F.col(k).alias(f"r{k}") for k in KEY], F.col("word").alias("rword")).agg(
        F.collect_set("template").alias("wanted"), F.bool_or(F.col("template").isNull()).alias("any")
    )
    same = F.col("doc_id").eqNullSafe(F.col("rdoc_id")) & (F.col("_k1") == F.col("r_k1")) & (F.col("_k2") == F.col("r_k2"))
    own = index.join(keyed, same & (F.col("word") == F.col("rword"))).select(*KEY, "pos", "word", "wanted", "any")
    mine = F.array_contains("wanted", F.col("template")).alias("mine")
    voting = own.join(F.broadcast(known_postings(index)), "word")
    aligned = voting.select(*KEY, "template", (F.col("pos") - F.col("at")).alias("shift"), "word", "any", mine).filter("any or mine")
    votes = aligned.distinct().groupBy(*KEY, "template", "shift").agg(F.greatest(F.count_if("any"), F.count_if("mine")).alias("votes"))
    return votes.groupBy(*KEY, "template").agg(F.max("votes").alias("votes")).filter(F.col("votes") >= MIN_VOTES)


def licence_labels(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, counts, base_labels, labels (arrays) and score."""
    index = stage(occurrences(docs, doc_id, text), "licence-words")
    votes = template_votes(index, rare_words(index, docs.count()))
    per_doc = votes.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("template", "votes"))).alias("votes"))
    joined = base_scan(docs, doc_id, text).alias("a").join(per_doc.alias("b"), same_key("a", "b"), "left")
    sizes = template_sizes()
    accepted = [
        F.when(
            reduce(lambda a, b: a & b, [F.array_contains("a.phrases", p) for p in phrases]) & F.col("b.votes")[name].isNotNull(),
            F.struct(F.lit(name).alias("label"), F.least(F.lit(1.0), F.col("b.votes")[name] / sizes[name]).alias("share")),
        )
        for name, (_, phrases) in TEMPLATES.items()
    ]
    found = joined.select("a.*", F.array_compact(F.array(*accepted)).alias("added"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_distinct(F.concat("base_labels", F.col("added.label")))).alias("labels"),
        F.when(F.size("base_labels") > 0, 1.0).otherwise(F.coalesce(F.array_max("added.share"), F.lit(0.0))).alias("score"),
    )
