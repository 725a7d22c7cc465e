"""License scans by exact set containment, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import plain_words, stored

# Phrases whose words name a license, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notices as the licenses themselves word them, and the labels the scan adds.
TEMPLATES = {
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the software without restriction"
    ),
    "mit-release": "Released under the MIT License",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0; you may not use this file except in "
        "compliance with the License"
    ),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
}
# Words without which a template is not meant, as they tell it from others, and words
# that tell others from it.
TELLING = {
    "mit-release": ["mit"],
    "apache-2.0-notice": ["apache", "2"],
    "apache-2.0-line": ["apache", "2"],
    "gpl-notice": ["general", "public"],
    "gpl-3.0-line": ["general", "public", "3"],
    "mpl-2.0": ["mozilla", "2"],
    "cc-by-nc-4.0": ["cc", "by", "nc", "4"],
    "cc-by-4.0": ["creative", "commons", "attribution", "4"],
}
BARRED = {
    "gpl-notice": ["affero", "lesser", "library"],
    "gpl-3.0-line": ["affero", "lesser", "library"],
    "cc-by-nc-4.0": ["nd", "sa"],
    "cc-by-4.0": ["noncommercial", "noderivatives", "sharealike"],
}
THRESHOLD = 0.8


def shapes(
    templates: dict[str, str],
    telling: dict[str, list[str]],
    barred: dict[str, list[str]],
    threshold: float,
) -> dict[str, tuple[list[str], int, int, list[str], list[str]]]:
    """Of each template with words: its distinct words, how many of them are needed, the words of a
    block, telling and barred words.

    A block is as wide as the template would be if the words that may lack stood beside it.
    """
    found = {}
    for label, own in template_words(templates).items():
        if own:
            plain = "".join(c if c.isalnum() else " " for c in templates[label].lower())
            need = math.ceil(threshold * len(own) - 1e-9)
            width = math.floor(len(plain.split()) / threshold + 1e-9)
            found[label] = (own, need, width, telling.get(label, []), barred.get(label, []))
    return found


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    """Distinct words of each template, in the form the documents' words have."""
    found = {}
    for label, text in templates.items():
        plain = "".join(c if c.isalnum() else " " for c in text.lower())
        found[label] = sorted(set(plain.split()))
    return found


def _places(phrases: dict[str, str]) -> Column:
    """`start, label` of each place where a phrase's words stand in a row, from `words`."""
    def found(words: list[str], label: str) -> Column:
        def here(i: Column) -> Column:
            same = F.lit(True)
            for j, word in enumerate(words):
                same = same & F.coalesce(F.get("words", i + j) == word, F.lit(False))
            return same

        starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), here)
        return F.transform(
            starts, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))
        )

    return F.concat(*(found(phrase.split(" "), label) for phrase, label in phrases.items()))


def _table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    def value(x) -> Column:
        return _words(x) if isinstance(x, list) else F.lit(x)

    structs = [F.struct(*(value(x).alias(n) for n, x in zip(names, row, strict=True))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _words(items: list[str]) -> Column:
    return F.array(*map(F.lit, items)).cast("array<string>")


def _verified(pairs: DataFrame) -> DataFrame:
    """`row_id, label, start, containment` of the templates that stand in a block of the text."""
    seen = F.filter(
        "hits", lambda x: F.array_contains("own", x["word"]) | F.array_contains("barred", x["word"])
    )
    begun = F.transform(
        "seen",
        lambda x, i: F.struct(
            x["at"].alias("start"),
            F.array_distinct(
                F.transform(
                    F.filter(
                        F.slice("seen", i + 1, F.col("width")),
                        lambda y: y["at"] < x["at"] + F.col("width"),
                    ),
                    lambda y: y["word"],
                )
            ).alias("held"),
        ),
    )
    fits = F.filter(
        "blocks",
        lambda b: (F.size(F.array_intersect(b["held"], "own")) >= F.col("needed"))
        & (F.size(F.array_except("telling", b["held"])) == 0)
        & (F.size(F.array_intersect("barred", b["held"])) == 0),
    )
    common = F.transform("fits", lambda b: F.size(F.array_intersect(b["held"], "own")))
    checked = pairs.withColumn("seen", seen).withColumn("blocks", begun).withColumn("fits", fits)
    return checked.where(F.size("fits") > 0).select(
        "row_id",
        "label",
        F.array_min("fits.start").alias("start"),
        (F.array_max(common) / F.size("own")).alias("containment"),
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    phrases: dict[str, str] | None = None,
    telling: dict[str, list[str]] | None = None,
    barred: dict[str, list[str]] | None = None,
) -> DataFrame:
    """License phrases and templates in each document.

    Phrases are found where their words stand in a row. Templates are found by an exact set join: a text
    block is a run of words, whatever lines it goes over, that begins with a word of the template and is as long
    as the template divided by `threshold`. It matches if it holds `threshold` of the template's distinct words, all that are `telling`, and none that is `barred`.

    Template words are ordered by the number of texts that hold them, rarest first. Of o words needed of
    t, one must be among the template's first t - o + 1; a text with fewer than o template words, or whose
    positions leave fewer than o common words possible, is passed over; what remains is looked through
    block by block, over the places of template words only.

    One row for each row of `docs`: `row_id, doc_id, n_words, starts` (of phrases), `base_labels`, `matches` (`label`,
    `start` of the first block that matches, in words, and largest `containment`) and `score` (largest containment
    matched, else 0). Templates without words match nothing; without templates nothing is looked for. Null and blank
    texts have no words; an empty table gives no rows.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    known = shapes(
        templates, TELLING if telling is None else telling, BARRED if barred is None else barred, threshold
    )
    spark = docs.sparkSession
    vocabulary = sorted({w for shape in known.values() for w in (*shape[0], *shape[4])})
    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    # Without the flag for Unicode, (?i) folds A-Z only.
    hint = "(?i)" + "|".join(p.replace(" ", gap) for p in phrases)
    none = F.array().cast("array<struct<start:int,label:string>>")
    no_matches = F.array().cast("array<struct<label:string,start:int,containment:double>>")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        docs["doc_id"].alias("doc_id"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    rows = rows.select(
        "row_id",
        "doc_id",
        plain_words(F.col("text")).alias("words"),
        F.col("text").rlike(hint).alias("hint") if phrases else F.lit(False).alias("hint"),
    ).withColumn("held", F.array_intersect(_words(vocabulary), "words"))
    likely = F.lit(False)
    for own, need, _, tell, _ in known.values():
        enough = F.size(F.array_intersect("held", _words(own))) >= need
        likely = likely | (enough & (F.size(F.array_except(_words(tell), "held")) == 0))
    hits = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
        lambda x: F.array_contains("held", x["word"]),
    )
    rows = stored(
        rows.select(
            "row_id",
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.when(F.col("hint"), _places(phrases)).otherwise(none).alias("places") if phrases else none.alias("places"),
            "held",
            F.when(likely, hits).alias("hits"),
        ),
        "scanned",
    )
    found = rows.select("row_id", "doc_id", "n_words", "places").withColumn("matches", no_matches)
    if known:
        matched = _matches(spark, rows, known, vocabulary)
        found = rows.join(stored(matched, "matched"), "row_id", "left").withColumn(
            "matches", F.coalesce("matches", no_matches)
        )
    return found.select(
        "row_id",
        "doc_id",
        "n_words",
        F.col("places.start").alias("starts"),
        F.array_sort(F.array_distinct("places.label")).alias("base_labels"),
        "matches",
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("score"),
    )


def _matches(
    spark: SparkSession, rows: DataFrame, known: dict[str, tuple], vocabulary: list[str]
) -> DataFrame:
    """`row_id, matches` of texts that hold a template."""
    # As many rows as the templates have words.
    words = rows.select(F.explode("held").alias("word"))
    often = {r["word"]: r["n"] for r in words.groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    prefixes, wholes = [], []
    for label, (words, need, width, tell, bar) in known.items():
        own = [w for w in order if w in set(words)]
        wholes.append((label, own, need, width, tell, bar))
        prefixes += [(w, label, i, len(own), need) for i, w in enumerate(own[: len(own) - need + 1])]
    # Both hold the templates' words and nothing of the documents, so they go to every task.
    index = F.broadcast(_table(spark, ["word", "label", "t_at", "t_size", "need"], prefixes))
    names = ["label", "own", "needed", "width", "telling", "barred"]
    sets = F.broadcast(_table(spark, names, wholes))
    least = min(need for _, need, *_ in known.values())
    texts = rows.where("hits is not null").select(
        "row_id", F.array_intersect(_words(order), "held").alias("held")
    )
    # The text's own prefix: with `least` words in common, one is among its first.
    probes = texts.withColumn("size", F.size("held")).select(
        "row_id",
        "size",
        F.posexplode(F.slice("held", F.lit(1), F.col("size") - (least - 1))).alias("at", "word"),
    )
    possible = (
        F.least("at", "t_at")
        + 1
        + F.least(F.col("size") - F.col("at") - 1, F.col("t_size") - F.col("t_at") - 1)
    )
    pairs = (
        probes.join(index, "word")
        .where((F.col("size") >= F.col("need")) & (possible >= F.col("need")))
        .select("row_id", "label")
        .distinct()
    )
    own = rows.where("hits is not null").select("row_id", "hits")
    return (
        _verified(pairs.join(sets, "label").join(own, "row_id"))
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("label", "start", "containment"))).alias("matches"))
    )
