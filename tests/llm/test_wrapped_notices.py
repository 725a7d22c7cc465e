"""Notices that are wrapped over several lines."""

from __future__ import annotations

import random
import re
import textwrap

from tidegauge.llm import license


def test_wrapped_notices_match(spark, documents):
    names = ["mit-grant", "gpl-notice", "bsd", "apache-2.0-notice"]
    rows = []
    for i, name in enumerate(names):
        body = textwrap.wrap(license.TEMPLATES[name], 40)
        rows.append((2 * i, "first line\n\n" + "\n".join(body) + "\nlast line"))
        rows.append((2 * i + 1, "# first\r\n" + "".join(f" * {line}\r\n" for line in body)))
    # The words are there, but far from each other.
    rows.append((8, ("\n" + "other words between them " * 5).join(license.TEMPLATES["bsd"].split())))
    found = {r["doc_id"]: {m["label"]: m for m in r["matches"]} for r in license.scan(documents(rows)).collect()}
    for i, name in enumerate(names):
        assert found[2 * i][name]["containment"] == found[2 * i + 1][name]["containment"] == 1
        assert found[2 * i][name]["start"] == 2 and found[2 * i + 1][name]["start"] == 1
    assert not found[8]


def labels(documents, texts):
    found = license.scan(documents(list(enumerate(texts)))).collect()
    return {r["doc_id"]: [m["label"] for m in r["matches"]] for r in found}


def test_words_that_name_another_license(spark, documents):
    """Most of a template's words without those that tell it from others, or far apart."""
    gnu = "This work is licensed under the GNU General Public License, version"
    lesser = license.TEMPLATES["gpl-notice"].replace("GNU General", "GNU Lesser General")
    rng = random.Random(1)
    scattered = [f"w{rng.randrange(10**6)}" for _ in range(10_000)]
    for at, word in zip(range(500, 10_000, 1500), ["Released", "under", "the", "MIT", "License"]):
        scattered[at] = word
    texts = [
        "Released under the Apache License",
        "Licensed under CC BY 4.0",
        f"{gnu} 2",
        "the report was released yesterday under licence; he took the license",
        " ".join(scattered),
        lesser,
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "", None,
    ]
    assert not any(labels(documents, texts).values())


def test_names_and_small_changes_still_match(spark, documents):
    texts = [
        "released  under the M.I.T.? No: under the MIT license.",
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under the GNU General Public License, version 3 or later",
        "It is licensed\nunder the Apache\nLicense, Version 2.0.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction',
    ]
    found = labels(documents, texts)
    assert found == {0: ["mit-release"], 1: ["cc-by-nc-4.0"], 2: ["gpl-3.0-line"], 3: ["apache-2.0-line"], 4: ["mit-grant"]}


def test_own_templates(spark, documents):
    docs = documents([(1, "a b c d e"), (2, "mit license"), (3, None)])
    none = {r["doc_id"]: r for r in license.scan(docs, templates={}).collect()}
    assert none[2]["base_labels"] == ["mit"] and not any(r["matches"] for r in none.values())
    assert not any(r["starts"] for r in license.scan(docs, phrases={}).collect())
    own = license.scan(docs, templates={"x": "e d c b a", "y": "..."}, threshold=1.0, phrases={"c d": "cd"}).collect()
    assert {r["doc_id"]: ([m["label"] for m in r["matches"]], r["starts"]) for r in own} == {
        1: (["x"], [2]), 2: ([], []), 3: ([], []),
    }


def test_scan_equals_all_blocks(spark, documents):
    """Every run of words of every text against every template, one by one."""
    rng = random.Random(12)
    shapes = license.shapes(license.TEMPLATES, license.TELLING, license.BARRED, license.THRESHOLD)
    pool = sorted({w for own, *_ in shapes.values() for w in own}) + ["x", "lesser", "noncommercial"]
    texts = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += rng.choices(pool, k=rng.randint(0, 15))
            body = license.TEMPLATES[rng.choice(list(license.TEMPLATES))].split()
            words += [w for w in body if rng.random() > 0.12]
        texts.append(rng.choice([" ", "\n", ", "]).join(words))
    want = {}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        best = {}
        for label, (own, need, width, tell, bar) in shapes.items():
            for at in (i for i, word in enumerate(words) if word in own):
                held = set(words[at : at + width])
                if len(held & set(own)) >= need and set(tell) <= held and not held & set(bar):
                    best[label] = max(best.get(label, 0), len(held & set(own)) / len(own))
        want[i] = best
    found = license.scan(documents(list(enumerate(texts)))).collect()
    assert {r["doc_id"]: {m["label"]: m["containment"] for m in r["matches"]} for r in found} == want
    assert sum(map(len, want.values())) > 100
