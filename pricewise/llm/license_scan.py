"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from directories.

DataFrame operations only. The units of a file are its lines, its paragraphs of several lines
and the sentences of both, which are compared with statements and headers, and the paragraphs
and the whole text without copyright lines, which are compared with whole licence texts. A unit and a template are sparse
vectors of words, (1 + ln tf) * idf, with idf from the document frequencies of all files. The
templates are a fixed list, so their words, weights and idf are a small table of fixed size;
words outside it count with the idf of a word that no file holds. Of every template the heaviest
words are its *anchors*: so many that a unit without any of them can't reach the threshold. A
unit is compared only with the templates of whose anchors it holds one, by a sum over its own
words in its row; texts are read, cut and compared in one stage, and only units that reach a
threshold are shuffled.

A file's licence is that of its best unit, if the cosine reaches ``THRESHOLD``, or
``FULL_THRESHOLD`` for a whole text, which goes before a statement in it. The unit must hold the
words that tell the licence from its neighbours (version, Lesser, Affero, ShareAlike). A file is a
*licence file* of its directory if it is named as one, or if that unit is at least half of its
words. Files without a licence of their own take that of the nearest directory above them that
has one: directories are joined with their ancestors' paths, once for each directory.

Defined cases: a null or empty text has no unit; rows with the same path are one file; a null
path is the empty path; of equal cosines the first template in order wins, of a directory's
licence files the one with the largest cosine, then the smallest path; extra columns of the
files are handed on, except names of the result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .license_templates import COPYRIGHT_LINE, FILE_RULES, FIRST, FULL, FULL_RULES, MORE, RULES

THRESHOLD = 0.6
FULL_THRESHOLD = 0.8
STATEMENT, BODY = range(2)
LICENCE_FILE_SHARE = 0.5
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
SENTENCE_END = r"(?<=[.!?])[\"')]*[\s#*/;%!-]+(?=[\"'(]*[A-Z])"
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([.\-_].*)?$"

#: Licence statements and standard file headers by licence; ``license_templates``
#: has the others.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions:"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
     "or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
     "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
     "License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying of this file is prohibited."),
]


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def _tf(n: float) -> float:
    return 1.0 + math.log(n)


def vocabulary(templates: list[tuple[str, str]]) -> list[str]:
    return sorted({w for _, t in templates for w in words_of(t)})


def inverse_frequencies(files: DataFrame, templates: list[tuple[str, str]]) -> tuple[dict[str, float], float]:
    """idf of the templates' words over all files, and that of a word no file holds. The
    driver gets one row for each word of the templates."""
    known = vocabulary(templates)
    table = files.sparkSession.createDataFrame([(w,) for w in [*known, ""]], "word string")
    held = F.array_append(F.array_distinct(words(F.col("text"))), F.lit(""))
    found = files.select(F.explode(held).alias("word")).join(F.broadcast(table), "word") \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    n = {r["word"]: r["n"] for r in found.collect()}
    total = n.get("", 0)
    return {w: math.log((1 + total) / (1 + n.get(w, 0))) + 0.1 for w in known}, math.log(1 + total) + 0.1


def template_weights(templates: list[tuple[str, str]], idf: dict[str, float]) -> list[dict[str, float]]:
    """Unit vectors of the templates."""
    out = []
    for _, text in templates:
        own = words_of(text)
        w = {x: _tf(own.count(x)) * idf[x] for x in set(own)}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.append({x: v / norm for x, v in w.items()})
    return out


def anchors_of(weights: list[dict[str, float]], threshold: float,
               order: dict[str, float] | None = None) -> list[str]:
    """The heaviest words of each template, or those first in ``order``, until the rest alone
    can't reach ``threshold``."""
    out: set[str] = set()
    for w in weights:
        rest = 1.0
        for word, v in sorted(w.items(), key=lambda x: (-(order[x[0]] if order else x[1]), x[0])):
            if math.sqrt(max(0.0, rest)) < threshold * (1 - 1e-9):
                break
            out.add(word)
            rest -= v * v
    return sorted(out)


def _of(kind: int, parts: Column) -> Column:
    return F.transform(parts, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("content")))


def units_of(text: Column) -> Column:
    """(kind, content): as statements the lines and the paragraphs of several lines, as bodies the
    same paragraphs and the whole text without copyright lines. ``sentences`` adds to them."""
    paragraphs = F.filter(F.split(text, r"\n[ \t\r]*\n\s*"), lambda p: F.contains(p, F.lit("\n")))
    bodies = F.transform(F.array_append(paragraphs, text), lambda p: F.regexp_replace(p, COPYRIGHT_LINE, ""))
    return F.concat(_of(STATEMENT, F.concat(F.split(text, "\n"), paragraphs)), _of(BODY, bodies))


def sentences(unit: Column) -> Column:
    """A unit and, of a statement, its sentences if it has several."""
    cut = F.split(unit["content"], SENTENCE_END)
    several = (unit["kind"] == STATEMENT) & (F.size(cut) > 1)
    return F.concat(F.array(unit), F.when(several, _of(STATEMENT, cut)).otherwise(F.array().cast(
        "array<struct<kind: int, content: string>>")))


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column that is computed once: filters on it stay above the generator."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def rules_of(template: tuple[str, str], full: bool, by_file: bool) -> tuple:
    """(groups, lacks, file words, file lacks) of a template, see ``license_templates``."""
    licence, text = template
    own = set(words_of(text))
    groups, lacks = (FULL_RULES if full and licence in FULL_RULES else RULES).get(licence, ([], []))
    file_needs, file_lacks = FILE_RULES[licence] if by_file else ([], [])
    return [g for g in groups if own & set(g)], [x for x in lacks if x not in own], file_needs, file_lacks


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in sorted(words)]).cast("array<string>")


def least_words(weights: dict[str, float], threshold: float) -> int:
    """So many words of a template a unit must share at least to reach ``threshold``: its cosine is
    at most the length of the template's part that it shares."""
    need, n = threshold * threshold * (1 - 1e-9), 0
    for v in sorted(weights.values(), reverse=True):
        if need <= 0:
            break
        need -= v * v
        n += 1
    return n


def template_table(spark: SparkSession, templates: list[tuple[str, str]], weights: list[dict[str, float]],
                   rules: list[tuple], first_full: int, thresholds: list[float]) -> DataFrame:
    """One row a template: its words by weight, what a unit must share, and its rules."""
    rows = [(i, name, i >= first_full, thresholds[i], least_words(weights[i], thresholds[i]),
             sorted(weights[i]), [weights[i][w] for w in sorted(weights[i])], *rules[i])
            for i, (name, _) in enumerate(templates)]
    return spark.createDataFrame(
        rows, "id int, licence string, full boolean, least double, least_words int, t_words array<string>, "
              "t_weights array<double>, groups array<array<string>>, lacks array<string>, "
              "file_needs array<string>, file_lacks array<string>")


def squared_terms(words: Column) -> Column:
    """Sum of (1 + ln tf)^2 over the distinct words, in one pass over the sorted words."""
    def add(state: Column, n: Column) -> Column:
        return state + F.when(n > 0, F.pow(1.0 + F.log(n.cast("double")), 2)).otherwise(0.0)
    start = F.struct(F.lit("").alias("word"), F.lit(0).alias("n"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        F.array_sort(words), start,
        lambda s, w: F.when(s["word"] == w, F.struct(w.alias("word"), (s["n"] + 1).alias("n"), s["sum"].alias("sum")))
        .otherwise(F.struct(w.alias("word"), F.lit(1).alias("n"), add(s["sum"], s["n"]).alias("sum"))),
        lambda s: add(s["sum"], s["n"]))


def own_licences(files: DataFrame, templates: list[tuple[str, str]] | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """(path, licence, cosine, whole) of the files with a unit like a template; ``whole`` if
    the unit is at least half of the file's words. Files, units and templates are compared
    where the files are read; only units that reach a threshold are shuffled."""
    spark = files.sparkSession
    first, full = (FIRST, FULL) if templates is None else ([], [])
    short = [*first, *(TEMPLATES + MORE if templates is None else templates)]
    every = short + full
    idf, unknown = inverse_frequencies(files, every)
    weights = template_weights(every, idf)
    thresholds = [threshold] * len(short) + [FULL_THRESHOLD] * len(full)
    rules = [rules_of(t, i >= len(short), i < len(first)) for i, t in enumerate(every)]
    anchors = [set(anchors_of([w], x)) for w, x in zip(weights, thresholds)]
    short_anchors, full_anchors = (_strings(set().union(*part)) for part in (anchors[:len(short)], anchors[len(short):]))
    marks = _strings({w for groups, *others in rules for some in (*groups, *others) for w in some})
    near = F.when(F.col("u.kind") == BODY, F.arrays_overlap("words", full_anchors)) \
        .otherwise(F.arrays_overlap("words", short_anchors))

    # files, then units, then their sentences: each only if it holds an anchor
    some = once(files.select("path", "text"), "all", words(F.col("text"))) \
        .filter(F.arrays_overlap("all", short_anchors) | F.arrays_overlap("all", full_anchors)) \
        .select("path", "text", F.size("all").alias("file_words"), F.array_intersect("all", marks).alias("file_marks"))
    about = ["path", "file_words", "file_marks"]
    units = some.select(*about, F.posexplode(units_of(F.col("text"))).alias("unit", "u"))
    units = once(units, "words", words(F.col("u.content"))).filter(near) \
        .select(*about, "unit", F.posexplode(sentences(F.col("u"))).alias("part", "u"))
    units = once(units, "words", words(F.col("u.content"))).filter(near)

    # a unit's known words with frequency and idf, and the square of its length
    table = F.map_from_arrays(_strings(list(idf)), F.array(*[F.lit(idf[w]) for w in sorted(idf)]))
    kept = F.transform(F.array_intersect("words", _strings(list(idf))), lambda w: F.struct(
        w.alias("word"), (1.0 + F.log(F.size(F.filter("words", lambda x: x == w)).cast("double"))).alias("tf"),
        F.element_at(table, w).alias("idf")))
    units = once(units, "known", kept)
    length = F.lit(unknown * unknown) * (squared_terms(F.col("words")) - F.aggregate(
        "known", F.lit(0.0), lambda s, k: s + k["tf"] * k["tf"])) \
        + F.aggregate("known", F.lit(0.0), lambda s, k: s + F.pow(k["tf"] * k["idf"], 2))
    units = units.select(
        *about, "unit", "part", "u.kind", F.size("words").alias("unit_words"), "known",
        F.sqrt(F.greatest(F.lit(0.0), length)).alias("norm"), F.array_intersect("words", marks).alias("marks"),
        F.when(F.col("u.kind") == BODY, F.array_intersect("words", full_anchors))
        .otherwise(F.array_intersect("words", short_anchors)).alias("anchors"))

    # an anchor names the templates that a unit with it may be like
    named = sorted((w, int(i >= len(short)), i) for i, a in enumerate(anchors) for w in a)
    ids: dict[tuple[str, int], list[int]] = {}
    for w, kind, i in named:
        ids.setdefault((w, kind), []).append(i)
    by_anchor = [F.map_from_arrays(
        F.array(*[F.lit(w) for w, k in ids if k == kind]).cast("array<string>"),
        F.array(*[F.array(*[F.lit(i) for i in of]) for (_, k), of in ids.items() if k == kind])
        .cast("array<array<int>>")) for kind in (STATEMENT, BODY)]
    candidates = F.array_distinct(F.flatten(F.transform("anchors", lambda w: F.when(
        F.col("kind") == BODY, F.element_at(by_anchor[BODY], w)).otherwise(F.element_at(by_anchor[STATEMENT], w)))))
    pairs = units.select("*", F.explode(candidates).alias("id")) \
        .join(F.broadcast(template_table(spark, every, weights, rules, len(short), thresholds)), "id")  # a fixed list
    enough = F.size(F.array_intersect("t_words", F.transform("known", lambda k: k["word"]))) >= F.col("least_words")
    dot = F.aggregate("known", F.lit(0.0), lambda s, k: s + F.coalesce(
        k["tf"] * k["idf"] * F.get(F.col("t_weights"), (F.array_position("t_words", k["word"]) - 1).cast("int")),
        F.lit(0.0)))
    scores = once(pairs.filter(enough), "cosine", dot / F.col("norm")) \
        .filter(F.col("cosine") >= F.col("least"))
    allowed = scores.filter(
        F.forall("groups", lambda g: F.arrays_overlap(g, F.col("marks")))
        & ~F.arrays_overlap("lacks", "marks") & ~F.arrays_overlap("file_lacks", "file_marks")
        & (F.size(F.array_except("file_needs", "file_marks")) == 0))
    # of a unit the first of equal cosines; of a file a whole text before statements, and these
    # before rights reserved, which stand beside any licence
    best = allowed.groupBy("path", "unit", "part").agg(F.max_by(
        F.struct("licence", "cosine", "full", "unit_words", "file_words"),
        F.struct("full", F.round("cosine", 12), -F.col("id"))).alias("b")).select("path", "b.*")
    top = F.max_by(F.struct("licence", "cosine", "unit_words", "file_words"),
                   F.struct("full", F.col("licence") != "Proprietary", F.round("cosine", 9), "licence", "unit_words"))
    return best.groupBy("path").agg(top.alias("b")).select(
        "path", "b.licence", "b.cosine",
        (F.col("b.unit_words") >= LICENCE_FILE_SHARE * F.col("b.file_words")).alias("whole"))


def directory(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def ancestors(path: Column) -> Column:
    """(depth, directory) of a directory and all above it; the root has depth 0."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    lead = F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.concat(lead, F.array_join(F.slice(parts, 1, n), "/")).alias("above")))
    root = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above")))
    return F.when(F.size(parts) > 0, F.concat(root, up)).otherwise(root)


def inherit(files: DataFrame, own: DataFrame) -> DataFrame:
    """``files`` (with path) and their licence: their own, or that of the nearest directory
    above that has a licence file."""
    name = F.regexp_extract("path", "[^/]*$", 0)
    licensed = own.filter(F.col("whole") | name.rlike(LICENCE_NAME)) \
        .groupBy(directory(F.col("path")).alias("above")) \
        .agg(F.min_by(F.struct("licence", "cosine"),
                      F.struct(-F.round("cosine", 9), F.col("path"))).alias("b")) \
        .select("above", F.col("b.licence").alias("up_licence"), F.col("b.cosine").alias("up_cosine"))
    rows = files.withColumn("_dir", directory(F.col("path")))
    near = rows.select("_dir").distinct() \
        .select("_dir", F.explode(ancestors(F.col("_dir"))).alias("a")) \
        .select("_dir", "a.depth", "a.above").join(licensed, "above") \
        .groupBy("_dir").agg(F.max_by(F.struct("above", "up_licence", "up_cosine"), "depth").alias("_up"))
    mine = own.select("path", F.struct("licence", "cosine").alias("_own"))
    has = F.col("_own").isNotNull()
    return rows.join(mine, "path", "left").join(near, "_dir", "left").withColumns({
        "licence": F.coalesce("_own.licence", "_up.up_licence"),
        "cosine": F.round(F.coalesce("_own.cosine", "_up.up_cosine"), 6),
        "origin": F.when(has, "own").when(F.col("_up").isNotNull(), "directory").otherwise("none"),
        "licence_dir": F.when(~has, F.col("_up.above")),
    }).drop("_dir", "_own", "_up")


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (path, text, ...) without the text, with licence, cosine, origin (own,
    directory or none) and licence_dir. The templates are all of this module and
    ``license_templates``, or those given."""
    rows = files.withColumns({"path": F.coalesce(F.col("path").cast("string"), F.lit("")),
                              "text": F.col("text").cast("string")})
    own = own_licences(rows.select("path", "text"), templates, threshold)
    other = [c for c in files.columns if c not in ("text", "licence", "cosine", "origin", "licence_dir",
                                                   "_dir", "_own", "_up")]
    return inherit(rows.select(*[F.col(f"`{c}`") for c in other]), own)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files at source/lang/doc_id."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan(docs.select("doc_id", path.alias("path"), "text"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items: list) -> str:
    if items and isinstance(items[0], list):
        return "[" + ", ".join(map(_list, items)) + "]"
    return "[" + ", ".join(map(_quoted, items)) + "]::VARCHAR[]"


def _sql() -> str:
    """All templates and rules. RE2 has no look-around, so sentence ends are marked by chr(1)."""
    short = [*FIRST, *TEMPLATES, *MORE]
    every = short + FULL
    rows = []
    for i, (name, text) in enumerate(every):
        groups, lacks, needs, file_lacks = rules_of((name, text), i >= len(short), i < len(FIRST))
        rows.append(f"({i}, {_quoted(name)}, {i >= len(short)}, {_quoted(text)}, {_list(groups) if groups else '[]'}"
                    f"::VARCHAR[][], {_list(lacks)}, {_list(needs)}, {_list(file_lacks)})")
    values = ",\n        ".join(rows)
    copyright_line = _quoted(COPYRIGHT_LINE.replace("\\u00a9", "\u00a9"))
    end = _quoted(r"([.!?])[\"')]*[\s\x0b#*/;%!-]+([\"'(]*[A-Z])")
    return rf"""
WITH files AS (
    SELECT row_number() OVER () AS r, doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path,
           concat_ws('/', source, lang) AS dir, coalesce(text, '') AS text FROM documents),
templates AS (SELECT * FROM (VALUES
        {values}) t(id, licence, full_text, text, groups, lacks, file_needs, file_lacks)),
template_words AS (SELECT id, full_text, unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM templates),
file_words AS (SELECT r, regexp_extract_all(lower(text), '{WORD}') AS words FROM files),
held AS (SELECT r, unnest(list_distinct(words)) AS word FROM file_words),
idf AS (
    SELECT v.word, ln((1 + (SELECT count(*) FROM files)) / (1 + count(held.r))) + 0.1 AS idf
    FROM (SELECT DISTINCT word FROM template_words) v LEFT JOIN held ON held.word = v.word GROUP BY v.word),
raw AS (
    SELECT id, full_text, word, (1 + ln(count(*))) * any_value(idf) AS w FROM template_words JOIN idf USING (word)
    GROUP BY id, full_text, word),
vectors AS (SELECT id, full_text, word, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS t FROM raw),
parts AS (
    SELECT r, text, string_split(text, chr(10)) AS lines, list_filter(
        regexp_split_to_array(text, '\n[ \t\r]*\n\s*'), lambda p: contains(p, chr(10))) AS paragraphs FROM files),
statements AS (SELECT r, unnest(list_concat(lines, paragraphs)) AS unit FROM parts),
cut AS (SELECT r, string_split(regexp_replace(unit, {end}, '\1' || chr(1) || '\2', 'g'), chr(1)) AS sentences FROM statements),
units AS (
    SELECT r, false AS body, unit FROM statements
    UNION ALL SELECT r, false, unnest(sentences) FROM cut WHERE len(sentences) > 1
    UNION ALL SELECT r, true, regexp_replace(unnest(list_append(paragraphs, text)), {copyright_line}, '', 'g') FROM parts),
numbered AS (
    SELECT r, body, row_number() OVER () AS u, regexp_extract_all(lower(unit), '{WORD}') AS words FROM units),
unit_words AS (SELECT u, body, unnest(words) AS word FROM numbered),
unit_vectors AS (
    SELECT u, body, word, (1 + ln(count(*))) * coalesce(
        any_value(idf), ln(1 + (SELECT count(*) FROM files)) + 0.1) AS w
    FROM unit_words LEFT JOIN idf USING (word) GROUP BY u, body, word),
norms AS (SELECT u, sqrt(sum(w * w)) AS norm FROM unit_vectors GROUP BY u),
dots AS (
    SELECT u, id, sum(w * t) AS dot FROM unit_vectors v JOIN vectors t ON t.word = v.word AND t.full_text = v.body
    GROUP BY u, id),
cosines AS (
    SELECT u, id, dot / norm AS cosine FROM dots JOIN norms USING (u) JOIN templates USING (id)
    WHERE dot / norm >= CASE WHEN full_text THEN {FULL_THRESHOLD} ELSE {THRESHOLD} END),
allowed AS (
    SELECT n.r, u, len(n.words) AS n, id, t.licence, t.full_text, cosine
    FROM cosines JOIN templates t USING (id) JOIN numbered n USING (u) JOIN file_words f ON f.r = n.r
    WHERE len(list_filter(t.groups, lambda g: NOT list_has_any(g, n.words))) = 0 AND NOT list_has_any(t.lacks, n.words)
      AND NOT list_has_any(t.file_lacks, f.words) AND list_has_all(f.words, t.file_needs)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY full_text DESC, round(cosine, 12) DESC, id) AS first FROM allowed),
best AS (
    SELECT r, n, cosine, licence, row_number() OVER (PARTITION BY r ORDER BY full_text DESC, licence <> 'Proprietary' DESC,
           round(cosine, 9) DESC, licence DESC, n DESC) AS place FROM firsts WHERE first = 1),
own AS (
    SELECT f.r, f.dir, f.path, b.licence, b.cosine, b.n >= {LICENCE_FILE_SHARE} * len(w.words) AS whole
    FROM best b JOIN files f USING (r) JOIN file_words w USING (r) WHERE place = 1),
licensed AS (
    SELECT dir, licence, cosine, row_number() OVER (PARTITION BY dir ORDER BY round(cosine, 9) DESC, path) AS place
    FROM own WHERE whole)
SELECT f.doc_id, f.path, coalesce(o.licence, l.licence) AS licence,
       round(coalesce(o.cosine, l.cosine), 6) AS cosine,
       CASE WHEN o.r IS NOT NULL THEN 'own' WHEN l.dir IS NOT NULL THEN 'directory' ELSE 'none' END AS origin,
       CASE WHEN o.r IS NULL THEN l.dir END AS licence_dir
FROM files f LEFT JOIN own o ON o.r = f.r LEFT JOIN licensed l ON l.dir = f.dir AND l.place = 1
"""


#: The documents' paths have their files in source/lang only, so the nearest directory is that one.
OP8_SQL = _sql()
