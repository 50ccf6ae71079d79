"""Licence scan: TF-IDF cosine to templates, then directory inheritance.

Everything is DataFrame functions. A licence has several templates (titles and
sentences of its full text, its standard header, its SPDX tag, short
statements); of a text that speaks of licences, windows of as many neighbouring
words as a template has, across lines, are compared to it by the cosine of
their TF-IDF vectors. Windows lie where one of the template's rarest words
occurs in the text, at that word's place in the template. Weights come from the
templates (a word that no template has weighs most). Version numbers are words
(2.0 is 2): a window must hold those of the template, and of the words that
tell relatives apart (lesser, affero, nc, ...) exactly the template's. A
passage takes the template of the highest cosine of at least ``least``; a file
takes its best passage. A licence file, or a file with a statement that begins
in its first line when ``head_declares``, speaks for its directory. A file
without a statement of its own takes that of the nearest directory above it
that has one: distinct directories (not files) are expanded to their ancestors
and joined, so a directory that holds a third of all files costs one row, and
the files meet their own directory's result at the end.

Broadcast are only the templates' words, bounded by the ``templates`` argument.

Defined cases: a NULL or empty text states nothing; a NULL path names no file,
its row has no licence; rows with one path are one file, each keeps its row;
equal cosines go to the template, then the passage, that sorts first, in a
licence file to the passage that comes first; a GNU,
Apache, Mozilla or Creative Commons licence without a version, or with one that
no template has, is none; the opening shared by BSD-2-Clause and BSD-3-Clause
is BSD-3-Clause unless the text names the other; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Short statements by which the licences are commonly applied.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This work is released into the public domain.",
}
GNU = {"AGPL": ("GNU Affero General Public License", ("3.0",)), "GPL": ("GNU General Public License", ("1.0", "2.0", "3.0")),
       "LGPL": ("GNU Lesser General Public License", ("2.1", "3.0"))}
CC = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
      "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-SA": "Attribution-ShareAlike"}
TEXTS = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
             "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD 2-Clause", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD 3-Clause", "3-Clause BSD License", "BSD License", "New BSD License", "BSD-style license",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met",
                     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    "ISC": ["ISC License",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies"],
    "MIT": ["MIT License", "The MIT License (MIT)", "MIT licensed",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "Unlicense": ["The Unlicense", "Unlicense license", "This is free and unencumbered software released into the public domain",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means"],
}


def _all_templates() -> dict[str, list[str]]:
    out: dict[str, list[str]] = defaultdict(list)
    for name, texts in (*((n, [t]) for n, t in TEMPLATES.items()), *TEXTS.items()):
        out[name] += texts
    for short, (name, versions) in GNU.items():
        for full in versions:
            v = full.removesuffix(".0")
            out[f"{short}-{full}"] += [
                f"{name}, version {v}", f"{name} v{v}", f"{name} {v}", f"{short} {v}", f"{short} v{v}", f"{short}v{v}", f"{short} version {v}",
                f"{name} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version",
                f"{name} as published by the Free Software Foundation; version {v}", f"version {v} of the {name}"]
    for v in ("1.0", "1.1", "2.0"):
        out[f"Apache-{v}"] += [
            f"Apache License, Version {v}", f"Apache License {v}", f"Apache {v}", f"Apache Software License, Version {v}",
            f"Licensed under the Apache License, Version {v} (the \"License\"); you may not use this file except in compliance with the License"]
    for v in ("1.0", "1.1", "2.0"):
        out[f"MPL-{v}"] += [f"Mozilla Public License, version {v}", f"Mozilla Public License {v}", f"Mozilla Public License, v. {v}", f"MPL {v}"]
    for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        for short, name in CC.items():
            out[f"CC-{short}-{v}"] += [f"CC {short} {v}", f"Creative Commons {name} {v}", f"Creative Commons {name} License version {v}",
                                       f"creativecommons.org/licenses/{short}/{v}"]
    for name in out:
        out[name].append(f"SPDX-License-Identifier: {name}")
    return dict(out)


ALL_TEMPLATES = _all_templates()
MARK = "(?i)licen[cs]e|spdx|copyright|public domain|redistribut|permission|gpl|creative ?commons|\\bcc[ -]by|\\bcc0|apache|mpl"
LICENCE_FILE = "(?i)(^|/)(licen[cs]e|copying|notice)([.-][^/]*)?$"
WORD = "[a-z]+|[0-9]+(?:\\.[0-9]+)*"
ZEROS = "(?<=[0-9])(?:\\.0)+(?![0-9]|\\.[0-9])"
APART = ("affero", "lesser", "nc", "nd", "noncommercial", "noderivatives", "noderivs", "sa", "sharealike")
COMMON = set("a all and any are as at be by for in is it its of on or that the this to under with license public software version "
             "work free source use copies copy".split())


def _words(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "licence", "license"), ZEROS, "")
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def _words_of(text: str) -> list[str]:
    return re.findall(WORD, re.sub(ZEROS, "", text.lower().replace("licence", "license")))


def _template_words(spark: SparkSession, templates: Mapping[str, str | Iterable[str]]) -> tuple[DataFrame, DataFrame, DataFrame, list[str], int, float]:
    """Seeds (word, template, license, before, size, needs), (template, word,
    weight over its length), (word, idf), seed words, longest template, idf of
    other words."""
    texts = sorted({(name, tuple(_words_of(t))) for name, given in templates.items() for t in ([given] if isinstance(given, str) else given)})
    texts = [(name, words) for name, words in texts if words]
    n = len(texts)
    idf = {w: math.log((n + 1) / (c + 1)) + 1 for w, c in Counter(w for _, words in texts for w in set(words)).items()}
    seeds, units = [], []
    for k, (name, words) in enumerate(texts):
        tf = Counter(words)
        length = math.sqrt(sum((c * idf[w]) ** 2 for w, c in tf.items()))
        units += [(k, w, c * idf[w] / length) for w, c in tf.items()]
        rare = [w for w in tf if w not in COMMON and not w[0].isdigit()] or list(tf)
        needs = [w for w in tf if w[0].isdigit() or w in APART]
        seeds += [(w, k, name, words.index(w), len(words), needs) for w in sorted(rare, key=lambda w: (-idf[w], -len(w), w))[:2]]
    return (spark.createDataFrame(seeds, "word string, template int, license string, before int, size int, needs array<string>"),
            spark.createDataFrame(units, "template int, word string, unit double"),
            spark.createDataFrame(list(idf.items()), "word string, idf double"),
            sorted({s[0] for s in seeds}), max((len(words) for _, words in texts), default=1), math.log(n + 1) + 1)


def statements(files: DataFrame, templates: Mapping[str, str | Iterable[str]], least: float) -> DataFrame:
    """files: path, text. (path, at, license, score) of every passage with a
    licence; ``at`` is the line in which it begins."""
    seeds, units, idf, seed_words, longest, other = _template_words(files.sparkSession, templates)
    words = F.flatten(F.transform(F.split("text", "\n"), lambda line, at: F.transform(_words(line), lambda w: F.struct(w.alias("word"), at.alias("at")))))
    found = F.filter(F.transform("words", lambda x, i: F.when(x["word"].isin(seed_words), i)), lambda i: i.isNotNull())
    marked = (files.where(F.col("path").isNotNull() & F.col("text").rlike(MARK))
              .select("path", F.xxhash64("text").alias("row"), words.alias("words"))
              .select("path", "row", "words", F.explode(found).alias("place")))
    first = F.greatest(F.col("place") - longest, F.lit(0))
    near = marked.select("path", "row", "place", (F.col("place") - first).alias("own"),
                         F.slice("words", first + 1, F.lit(2 * longest)).alias("words"))
    near = near.withColumn("word", F.element_at("words", F.col("own") + 1)["word"])
    begin = F.greatest(F.col("own") - F.col("before"), F.lit(0))
    window = F.slice("words", begin + 1, F.col("size") - (begin - (F.col("own") - F.col("before"))))
    held = F.transform("window", lambda x: x["word"])
    windows = (near.join(F.broadcast(seeds), "word")
               .select("path", "row", "place", "template", "before", "license", "needs", window.alias("window"))
               .select("path", "row", "place", "template", "before", "license", "needs", F.col("window")[0]["at"].alias("at"), held.alias("held"))
               .where((F.size(F.array_except("needs", "held")) == 0)
                      & (F.size(F.array_except(F.array_intersect("held", F.array(*map(F.lit, APART))), "needs")) == 0)))
    counted = F.transform(F.array_distinct("held"), lambda w: F.struct(w.alias("word"), F.size(F.filter("held", lambda x: x == w)).alias("tf")))
    terms = (windows.select("path", "row", "place", "template", "before", "license", "at", F.explode(counted).alias("term"))
             .select("path", "row", "place", "template", "before", "license", "at", "term.word", "term.tf")
             .join(F.broadcast(idf), "word", "left").join(F.broadcast(units), ["template", "word"], "left")
             .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other))))
    copies = F.count("*") / F.size(F.collect_set("word"))  # rows of equal path and text
    score = F.round(F.sum(F.col("w") * F.coalesce("unit", F.lit(0.0))) / F.sqrt(F.sum(F.col("w") * F.col("w")) * copies), 6)
    scored = (terms.groupBy("path", "row", "place", "template", "before", "license", "at").agg(score.alias("score"))
              .where(F.col("score") >= least))
    return (scored.groupBy("path", "at").agg(F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), "license")).alias("best"))
            .select("path", "at", "best.license", "best.score"))


def directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", templates: Mapping[str, str | Iterable[str]] | None = None,
         least: float = 0.7, head_declares: bool = False) -> DataFrame:
    """Per row of ``files``: path, license, score, origin (own, inherited or
    none), from_path (the file whose statement holds)."""
    rows = common.pick(files, path=path_col, text=text_col)
    found = common.stored(statements(rows, templates or ALL_TEMPLATES, least))
    early = F.when(F.col("path").rlike(LICENCE_FILE), F.col("at")).otherwise(0)  # a licence's title comes before others it names
    own = found.groupBy("path").agg(F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), early, "license", "at")).alias("own"))
    speaks = F.col("path").rlike(LICENCE_FILE)
    if head_declares:
        speaks = speaks | (F.col("at") == 0)
    declared = (found.where(speaks).groupBy(directory(F.col("path")).alias("above"))
                .agg(F.min_by(F.struct("license", "score", "path"), F.struct(-F.col("score"), early, "license", "path")).alias("given")))
    paths = rows.select("path").withColumn("dir", directory(F.col("path")))
    folders = F.when(F.col("dir") == "", F.array(F.lit("").cast("string"))).otherwise(F.split("dir", "/"))
    dirs = (paths.select("dir").where("dir is not null").distinct()
            .select("dir", F.when(F.col("dir") == "", F.lit(0)).otherwise(F.size(F.split("dir", "/"))).alias("depth"), folders.alias("f"))
            .select("dir", "f", F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("depth"))
            .select("dir", "depth", F.when(F.col("depth") == 0, "").otherwise(F.array_join(F.slice("f", F.lit(1), F.greatest("depth", F.lit(1))), "/"))
                    .alias("above")))
    nearest = (dirs.join(declared, "above").groupBy("dir").agg(F.max_by("given", "depth").alias("given")))
    out = paths.join(own, "path", "left").join(nearest, "dir", "left")
    return out.select(
        "path", F.coalesce("own.license", "given.license").alias("license"), F.coalesce("own.score", "given.score").alias("score"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("given.path")).alias("from_path"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: documents are laid out as source/thousands/
    hundreds/id, those divisible by 100 one level up, by 1000 two, as index
    files of what lies below; a row without an id is no file."""
    docs = common.documents(spark, sf_dir)
    i = F.col("doc_id")
    path = F.concat_ws("/", "source", F.when(F.pmod(i, F.lit(1000)) != 0, F.floor(i / 1000).cast("string")),
                       F.when(F.pmod(i, F.lit(100)) != 0, F.floor(i / 100).cast("string")), i.cast("string"))
    out = scan(docs.select(F.when(i.isNotNull(), path).alias("path"), "text"), head_declares=True)
    last = F.regexp_extract(F.col("path"), "([^/]*)$", 1).cast("long")
    return out.select(last.alias("doc_id"), "license", "score", "origin", F.regexp_extract("from_path", "([^/]*)$", 1).cast("long").alias("from_doc_id"))


OP9_SQL = """
WITH t(license, text) AS (VALUES %s),
tf AS (SELECT license, word, count(*) AS tf FROM (SELECT license, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM t) GROUP BY ALL),
idf AS (SELECT word, ln((%d + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY word),
tw AS (SELECT license, word, tf * idf AS w FROM tf JOIN idf USING (word)),
unit AS (SELECT license, word, w / sqrt(sum(w * w) OVER (PARTITION BY license)) AS unit FROM tw),
d AS (SELECT doc_id, text, concat_ws('/', source, CASE WHEN doc_id %% 1000 <> 0 THEN CAST(doc_id // 1000 AS VARCHAR) END,
        CASE WHEN doc_id %% 100 <> 0 THEN CAST(doc_id // 100 AS VARCHAR) END) AS dir FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
s AS (SELECT * FROM l WHERE regexp_matches(line, '(?i)licen[cs]e|spdx|copyright|public domain|redistribut')),
p AS (SELECT doc_id, pos, word, count(*) AS tf FROM (SELECT doc_id, pos, unnest(regexp_extract_all(lower(line), '[a-z]+')) AS word FROM s) GROUP BY ALL),
w AS (SELECT doc_id, pos, word, tf * coalesce(idf, ln(%d + 1) + 1) AS w FROM p LEFT JOIN idf USING (word)),
n AS (SELECT doc_id, pos, sqrt(sum(w * w)) AS length FROM w GROUP BY ALL),
c AS (SELECT doc_id, pos, license, round(sum(w * unit) / any_value(length), 6) AS score FROM w JOIN unit USING (word) JOIN n USING (doc_id, pos)
      GROUP BY doc_id, pos, license),
f AS (SELECT * FROM c WHERE score >= 0.7 QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY score DESC, license) = 1),
o AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license, pos) = 1),
g AS (SELECT d.dir, f.* FROM f JOIN d USING (doc_id) WHERE pos = 0
      QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY score DESC, license, d.dir || '/' || CAST(doc_id AS VARCHAR)) = 1),
a AS (SELECT DISTINCT dir, array_to_string(string_split(dir, '/')[1:k], '/') AS above, k
      FROM (SELECT DISTINCT dir, unnest(range(0, len(string_split(dir, '/')) + 1)) AS k FROM d)),
h AS (SELECT a.dir, g.doc_id, license, score FROM a JOIN g ON a.above = g.dir QUALIFY row_number() OVER (PARTITION BY a.dir ORDER BY k DESC) = 1)
SELECT d.doc_id, coalesce(o.license, h.license) AS license, coalesce(o.score, h.score) AS score,
       CASE WHEN o.doc_id IS NOT NULL THEN 'own' WHEN h.doc_id IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       coalesce(o.doc_id, h.doc_id) AS from_doc_id
FROM d LEFT JOIN o ON d.doc_id = o.doc_id LEFT JOIN h ON d.dir = h.dir
""" % (", ".join(f"('{k}', '{v}')" for k, v in sorted(TEMPLATES.items())), len(TEMPLATES), len(TEMPLATES))
