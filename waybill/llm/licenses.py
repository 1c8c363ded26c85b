"""Licence scans: sparse TF-IDF cosine of runs of words to licence templates, then inheritance along directories.

A text is a row of words whatever its line breaks and comment marks, so a notice
may be wrapped, stand inside a longer line or in a text without lines. Every run
of words of up to ``LONGEST`` times a template's words that starts and ends with a
word of the template is compared with it (a run that does not has a shorter one
with a higher cosine). Weights are term frequency times inverse document
frequency; words outside the templates weigh like a word of a single document. A
run whose cosine reaches ``THRESHOLD`` is a notice. Of notices that overlap in a
text the one with the highest cosine stays.

Near templates share most of their words, so a run must also pass on the words by
which they differ: it may not hold more of another licence's own words than of its
template's, it must hold the first number that tells the template apart, and after
an SPDX tag the whole name. A negation that the template lacks, in the run or in the
``DENIED_WITHIN`` words before it, denies the notice.

Runs are first narrowed down without loss. By the Cauchy-Schwarz inequality the
words of a template that a run holds must have the threshold's share of its
length; a text without them is out, then a place without them within reach, then
a run whose dot product is too small for the least its own length can be.

A document whose notices make up ``FILE_SHARE`` of its words, or with a notice and
a name like LICENSE or COPYING, is a licence file of its directory; otherwise the
notice is a header of the document alone. A document without a licence of its own
takes the one of the nearest directory above it that has a licence file, found by
joining ancestors of the distinct directories. DataFrame functions only.

Defined results: null and empty texts have no notices but inherit. A null path is
a directory of its own without ancestors. Of several licences in a document the
highest cosine wins, then the smallest name; of several files in a directory
likewise, then the smallest id. Repeated rows give repeated results, an empty
table no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Notices of public licences: fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    # The usual headers and titles: without them a run over wrapped lines would take one version for another.
    ("GPL-2.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Names that follow an SPDX tag: fixed values.
SPDX_TAG = "SPDX-License-Identifier:"
SPDX_NAMES = ["AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense"]
TEMPLATES += [(name, f"{SPDX_TAG} {name}") for name in SPDX_NAMES]
#: Words that deny a notice, as they are left when marks are taken out; and how many words before it they reach.
DENIALS = ["not", "never", "cannot", "isn", "aren", "wasn", "weren"]
DENIED_WITHIN = 4
#: Templates of different licences whose words, all weighing the same, have this cosine are told apart by the words they differ in.
NEAR = 0.6
THRESHOLD = 0.8
FILE_SHARE = 0.25
#: Words of the longest run compared with a template, in words of the template.
LONGEST = 1.5
#: Names of licence files, in lower case.
FILE_NAMES = "^(un)?(licen[cs]e|copying)s?([._-].*)?$"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _template_words(text: str) -> list[str]:
    kept = "".join(c if c.isalnum() else " " for c in text.lower())
    return kept.split()


def inverse_frequency(rows: int, documents: int) -> float:
    """Weight of a word that ``documents`` of ``rows`` rows have."""
    return math.log((1 + rows) / (1 + documents)) + 1


def _weights(text: str, idf: dict[str, float]) -> dict[str, float]:
    found: dict[str, float] = {}
    for word in _template_words(text):
        found[word] = found.get(word, 0.0) + idf[word]
    norm = math.sqrt(sum(w * w for w in found.values()))
    return {word: w / norm for word, w in found.items()}


def deciding_words(weights: list[dict[str, float]], threshold: float) -> list[str]:
    """Words such that a line with none of them has a cosine below the threshold to every template."""
    found: set[str] = set()
    for own in weights:
        light = 0.0
        for word, weight in sorted(own.items(), key=lambda item: (item[1], item[0])):
            light += weight * weight
            if math.sqrt(light) >= threshold - 1e-9:
                found.add(word)
    return sorted(found)


def telling_words(templates: list[tuple[str, str]], near: float = NEAR) -> list[tuple[list[str], list[tuple[list[str], list[str]]]]]:
    """Per template the words that a run of it must hold, and for each near template of another licence the words that only
    the one and only the other has."""
    rows = [_template_words(text) for _, text in templates]
    bags = [set(row) for row in rows]
    tag = _template_words(SPDX_TAG)
    found = []
    for (license, _), row, own in zip(templates, rows, bags, strict=True):
        others = [
            other
            for (name, _), other in zip(templates, bags, strict=True)
            if name != license and own and other and len(own & other) >= near * math.sqrt(len(own) * len(other))
        ]
        numbers = [w for w in row if w.isdigit() and any(w not in other for other in others)]
        must = row[len(tag) :] if row[: len(tag)] == tag else numbers[:1]
        found.append((sorted(set(must)), sorted({(tuple(sorted(own - o)), tuple(sorted(o - own))) for o in others})))
    return [(must, [(list(a), list(b)) for a, b in pairs]) for must, pairs in found]


def _told_apart(held: Column, must: Column, pairs: Column) -> Column:
    share = lambda wanted: F.size(F.array_intersect(held, wanted)) / F.greatest(F.lit(1), F.size(wanted))
    return (F.size(F.array_except(must, held)) == 0) & F.forall(pairs, lambda p: share(p["other"]) <= share(p["own"]))


def license_notices(df: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(row, n_words, license, score) of every notice in ``df`` (row, text), none of them overlapping."""
    spark = df.sparkSession
    vocabulary = sorted({w for _, text in templates for w in _template_words(text)})
    listed = F.array(*map(F.lit, vocabulary))
    # As many rows as the templates have words, whatever the corpus.
    counted = df.select(F.explode(F.array_intersect(words(F.col("text")), listed)).alias("word")).groupBy("word").count()
    frequency = {row["word"]: row["count"] for row in counted.collect()}
    rows = df.count()
    idf = {w: inverse_frequency(rows, frequency.get(w, 0)) for w in vocabulary}
    rare = inverse_frequency(rows, 1)
    weights = [_weights(text, idf) for _, text in templates]
    deciding = deciding_words(weights, threshold)
    reach = [int(LONGEST * len(_template_words(text))) for _, text in templates]
    table = spark.createDataFrame(
        [(k, license, word, idf[word], weight, reach[k]) for k, ((license, _), own) in enumerate(zip(templates, weights, strict=True)) for word, weight in own.items()],
        "template int, license string, word string, idf double, weight double, reach int",
    )
    telling = spark.createDataFrame(
        [(k, must, pairs, [w for w in DENIALS if w not in weights[k]]) for k, (must, pairs) in enumerate(telling_words(templates))],
        "template int, must array<string>, pairs array<struct<own: array<string>, other: array<string>>>, denials array<string>",
    )
    known = spark.createDataFrame([(w, idf[w]) for w in vocabulary], "word string, idf double")
    enough = threshold * threshold - 1e-9

    # Texts that hold enough of a template, with those templates.
    # The explodes of one value keep Spark from working the words out anew wherever they are named.
    texts = df.select("row", F.explode(F.array(words(F.col("text")))).alias("words")).where(F.arrays_overlap("words", F.array(*map(F.lit, deciding))))
    texts = texts.select("row", "words", F.explode(F.array(F.array_intersect("words", listed))).alias("held"))
    masses = F.array(
        *(
            F.struct(F.lit(k).alias("k"), F.array(*(F.struct(F.lit(w).alias("w"), F.lit(x * x).alias("m")) for w, x in own.items())).alias("own"))
            for k, own in enumerate(weights)
        )
    )
    held = lambda t: F.aggregate(t["own"], F.lit(0.0), lambda s, x: s + F.when(F.array_contains(F.col("held"), x["w"]), x["m"]).otherwise(0.0))
    fits = F.transform(F.filter(masses, lambda t: held(t) >= enough), lambda t: t["k"])
    texts = texts.select("row", "words", F.explode(F.array(fits)).alias("fits")).where(F.size("fits") > 0)
    texts = staged(texts.select("row", "words", "fits").dropDuplicates(["row"]), "license-texts")

    # Words of a template in place; ``load`` is the least squared length that the text has up to there.
    places = texts.select("row", "fits", F.posexplode("words").alias("pos", "word")).join(F.broadcast(known), "word")
    order = "PARTITION BY row ORDER BY pos"
    places = places.withColumn(
        "load", F.expr(f"sum(idf * idf) OVER ({order}) + (pos + 1 - row_number() OVER ({order})) * {rare * rare!r}D")
    ).drop("idf")
    placed = places.join(F.broadcast(table), "word").where(F.array_contains("fits", F.col("template")))
    placed = placed.select(
        "row", "template", "license", "pos", "load", "reach", (F.col("idf") * F.col("weight")).alias("dot"),
        (F.col("weight") * F.col("weight")).alias("mass"), (F.col("idf") * F.col("idf")).alias("own"), (F.col("pos") / F.col("reach")).alias("scaled"),
    )
    ahead = "OVER (PARTITION BY row, template ORDER BY scaled RANGE BETWEEN CURRENT ROW AND 1D FOLLOWING)"
    upto = "sum(dot) OVER (PARTITION BY row, template ORDER BY scaled)"
    placed = placed.withColumns({"near": F.expr(f"sum(mass) {ahead}"), "dots": F.expr(upto)})
    # Only few places have enough of the template ahead; they look at the ends within reach.
    placed = placed.withColumn("ends", F.expr(f"collect_list(struct(pos, load, dots)) {ahead}")).where(F.col("near") >= enough)
    runs = placed.select(
        "row", "template", "license", "reach", F.col("pos").alias("start"), (F.col("load") - F.col("own")).alias("load0"), (F.col("dots") - F.col("dot")).alias("dots0"),
        F.explode("ends").alias("end"),
    ).where("end.pos < start + reach")
    runs = runs.where((F.col("end.dots") - F.col("dots0") + 1e-9) >= threshold * F.sqrt(F.col("end.load") - F.col("load0")))
    per_row = runs.groupBy("row").agg(F.collect_list(F.struct("template", "license", "start", F.col("end.pos").alias("stop"))).alias("runs"))
    cut = texts.join(per_row, "row").select("row", "words", F.explode("runs").alias("run"))
    begin = F.greatest(F.lit(0), F.col("run.start") - DENIED_WITHIN)
    cut = cut.select(
        "row", "run.*", F.slice("words", F.col("run.start") + 1, F.col("run.stop") - F.col("run.start") + 1).alias("words"),
        F.slice("words", begin + 1, F.col("run.stop") + 1 - begin).alias("around"),
    ).join(F.broadcast(telling), "template")
    # Words of the run tell templates apart; a denial may stand before it as well.
    cut = cut.where(~F.arrays_overlap("around", "denials") & _told_apart(F.col("words"), F.col("must"), F.col("pairs")))
    cut = cut.select("row", "template", "license", "start", "stop", "words")
    cut = staged(cut.withColumn("id", F.xxhash64("words")), "license-runs")

    # Distinct contents once: a notice that a third of the corpus carries is scored once per task and then once.
    contents = cut.groupBy("id").agg(F.first("words").alias("words"))
    terms = contents.select("id", F.explode("words").alias("word")).groupBy("id", "word").agg(F.count("*").alias("tf"))
    norms = (
        terms.join(F.broadcast(known), "word", "left")
        .groupBy("id")
        .agg(F.sqrt(F.sum((F.col("tf") * F.coalesce("idf", F.lit(rare))) ** 2)).alias("norm"))
    )
    dots = (
        terms.join(F.broadcast(table), "word")
        .groupBy("id", "template")
        .agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    )
    scored = dots.join(norms, "id").withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= threshold)
    found = cut.select("row", "template", "license", "start", "stop", "id").join(scored.select("id", "template", "score"), ["id", "template"])
    # Per licence and start the best; then, in each stretch of overlapping notices, the best of all goes first and bars what it meets.
    rank = F.struct((-F.col("score")).alias("minus"), (F.col("start") - F.col("stop")).alias("shorter"), "license", "start", "stop")
    best = found.groupBy("row", "license", "start").agg(F.min(rank).alias("notice")).select("row", "notice")
    before = "OVER (PARTITION BY row ORDER BY notice.start, notice.license ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    best = best.withColumn("fresh", F.expr(f"CASE WHEN notice.start > max(notice.stop) {before} THEN 1 ELSE 0 END"))
    best = best.withColumn("stretch", F.expr("sum(fresh) OVER (PARTITION BY row ORDER BY notice.start, notice.license)"))
    kind = best.schema["notice"].dataType.simpleString()
    taken = F.aggregate(
        F.array_sort(F.collect_list("notice")),
        F.array().cast(f"array<{kind}>"),
        lambda kept, x: F.when(F.exists(kept, lambda k: (k["start"] <= x["stop"]) & (x["start"] <= k["stop"])), kept).otherwise(F.concat(kept, F.array(x))),
    )
    kept = best.groupBy("row", "stretch").agg(taken.alias("kept")).select("row", F.explode("kept").alias("x"))
    return kept.select("row", (F.col("x.stop") - F.col("x.start") + 1).alias("n_words"), "x.license", (-F.col("x.minus")).alias("score"))


def scan_licenses(
    df: DataFrame,
    id_column: str = "doc_id",
    path_column: str = "path",
    text_column: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    file_share: float = FILE_SHARE,
) -> DataFrame:
    """Per row: its id, path, ``license`` (or null), ``score``, ``origin`` (header, file, inherited or none),
    ``from_id``, the row that holds the licence, and ``licenses``, the names found in its own text."""
    text = F.coalesce(df[text_column], F.lit(""))
    docs = df.select(
        df[id_column].alias("id"), df[path_column].alias("path"), text.alias("text"), F.xxhash64(df[id_column], df[path_column], text).alias("row")
    )
    found = staged(license_notices(docs.select("row", "text"), templates, threshold), "license-notices")
    own = found.groupBy("row").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"),
        F.sum("n_words").alias("license_words"),
        F.array_sort(F.collect_set("license")).alias("licenses"),
    )
    counted = docs.select("id", "path", "row", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.size(words(F.col("text"))).alias("n_words"))
    named = F.lower(F.regexp_extract("path", "([^/]*)$", 1)).rlike(FILE_NAMES)
    marked = staged(counted.join(own, "row", "left"), "license-rows").withColumn(
        "is_file", F.coalesce((F.col("license_words") >= file_share * F.col("n_words")) | (F.col("best").isNotNull() & named), F.lit(False))
    )
    files = (
        marked.where("is_file AND path IS NOT NULL")
        .groupBy("dir")
        .agg(F.min(F.struct(F.col("best.minus").alias("minus"), F.col("best.license").alias("license"), "id")).alias("held"))
    )
    # Ancestors of the distinct directories, nearest last; a directory is its own ancestor.
    parts = F.split("dir", "/")
    dirs = marked.where("path IS NOT NULL").select("dir").distinct()
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.when(k == 0, "").otherwise(F.array_join(F.slice(parts, 1, k), "/")))).alias("ancestor"))
    nearest = (
        above.join(files.withColumnRenamed("dir", "ancestor"), "ancestor")
        .groupBy("dir")
        .agg(F.max_by("held", F.length("ancestor")).alias("held"))
    )
    joined = marked.join(nearest, "dir", "left")
    has_own = F.col("best").isNotNull()
    inherits = ~has_own & F.col("held").isNotNull() & F.col("path").isNotNull()
    origin = F.when(has_own & F.col("is_file"), "file").when(has_own, "header").when(inherits, "inherited").otherwise("none")
    return joined.select(
        F.col("id").alias(id_column),
        F.col("path").alias(path_column),
        F.when(has_own, F.col("best.license")).when(inherits, F.col("held.license")).alias("license"),
        F.when(has_own, -F.col("best.minus")).when(inherits, -F.col("held.minus")).alias("score"),
        origin.alias("origin"),
        F.when(has_own, F.col("id")).when(inherits, F.col("held.id")).alias("from_id"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
    )
