"""License scan: sparse TF-IDF cosine of word windows to licence templates, then inheritance from the nearest directory.

Line ends, comment marks and other signs don't count: a text is the sequence of its words. Every word that
holds a stem of the templates' anchor words is laid on each template's words of that stem, and the window
of as many words as the template has, so aligned, is a candidate. A notice is thus found whether it is wrapped,
follows other words in its line or stands in a text without line ends. A window's vector has
tf * (ln((N + 1) / (df + 1)) + 1) for the templates' terms, df and N over all documents, so that a term of every
document still counts; words outside the templates count as of df 0. It matches at a cosine of MIN_COSINE or more. A file's own licence is that of
its best window. A licence file is one with such a name, or of whose words the matching windows cover half
or more; the best licence file of a directory licenses it. A file without a licence inherits from its nearest
licensed ancestor directory: ancestors are made for distinct directories, not for files, and joined.
Whole licence texts are known by their headings and notices; there are no full-text templates.

Only DataFrame functions. Ties go to the least licence, then the least path. Null text has no lines. A null
path has no directory. Repeated rows are scanned each. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import ROW_KEY, documents, join_small, saved, with_row_key

MIN_COSINE = 0.6

#: Notices as they stand in files, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-only", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3"),
    ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
#: Headings of licence files and notices of several lines. The SQL, which scores single lines, doesn't have them.
HEADINGS = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0-only", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-2.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
#: Every template holds one of these.
ANCHORS = ("licen", "redistribution", "permission")
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"


def terms(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def _has_anchor(text: Column) -> Column:
    low, out = F.lower(text), F.lit(False)
    for a in ANCHORS:
        out = out | F.contains(low, F.lit(a))
    return out


def _stems(word: Column) -> Column:
    return F.filter(F.array(*map(F.lit, ANCHORS)), lambda a: F.contains(word, a))


def scan(files: DataFrame, path: Column, text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES + HEADINGS) -> DataFrame:
    """One row per row of files: row key, path, license, origin (own, inherited, none), cosine, from_dir."""
    spark = files.sparkSession
    known = spark.createDataFrame([(k, *t) for k, t in enumerate(templates)], "template int, license string, notice string")
    tf = known.select("template", "license", F.explode(terms(F.col("notice"))).alias("term")).groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))
    vocabulary = sorted({r[0] for r in tf.select("term").distinct().collect()})  # of the templates

    rows = with_row_key(files).select(*ROW_KEY, path.alias("path"), F.col(text_col).cast("string").alias("text"))
    n_docs = rows.count()
    present = rows.filter("text is not null").select(F.explode(F.array_intersect(terms(F.col("text")), F.array(*map(F.lit, vocabulary)))).alias("term"))
    df = present.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = saved(tf.select("term").distinct().join(df, "term", "left").select("term", (F.log(F.lit(n_docs + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf")), "idf")
    unknown = F.log(F.lit(float(n_docs + 1))) + 1

    vectors = tf.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    vectors = vectors.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("template")))).select("template", "license", "term", F.col("w").alias("tw"), F.col("norm").alias("tnorm"))

    said = known.select("template", "license", terms(F.col("notice")).alias("words")).select("template", "license", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
    laid = said.select("template", "license", "n", "offset", F.explode(_stems(F.col("word"))).alias("stem")).join(vectors.select("template", "tnorm").distinct(), "template")
    before, after = laid.agg(F.max("offset"), F.max(F.col("n") - F.col("offset"))).first()

    words = rows.filter(_has_anchor(F.col("text"))).select(*ROW_KEY, terms(F.col("text")).alias("words"))
    spots = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.size(_stems(F.get("words", i))) > 0)
    near = F.transform(spots, lambda i: F.struct(i.alias("spot"), F.greatest(i - before, F.lit(0)).alias("first"), F.slice("words", F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)) + after).alias("near"), _stems(F.get("words", i)).alias("stems")))
    found = words.select(*ROW_KEY, F.size("words").alias("n_terms"), F.explode(near).alias("s")).select(*ROW_KEY, "n_terms", "s.spot", "s.first", "s.near", F.explode("s.stems").alias("stem"))
    start, end = F.greatest(F.col("spot") - F.col("offset"), F.lit(0)), F.col("spot") - F.col("offset") + F.col("n")
    windows = found.join(F.broadcast(laid), "stem").withColumns({"start": start, "end": F.least(end, F.col("n_terms")), "said": F.slice("near", start - F.col("first") + 1, end - start)})
    at = [*ROW_KEY, "n_terms", "start", "end", "template", "license", "tnorm"]
    counted = windows.select(*at, F.explode("said").alias("term")).groupBy(*at, "term").agg(F.count(F.lit(1)).alias("tf"))  # a window met by two anchors counts each word twice, which leaves the cosine as it is
    weighed = counted.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", unknown)).join(F.broadcast(vectors.select("template", "term", "tw")), ["template", "term"], "left")
    sums = weighed.groupBy(*at).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum(F.col("w") * F.col("tw")).alias("dot"))
    matched = saved(sums.withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6)).filter(F.col("cosine") >= MIN_COSINE), "matched")
    reached = F.max("end").over(W.partitionBy(*ROW_KEY).orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    spans = matched.groupBy(*ROW_KEY, "n_terms", "start").agg(F.max("end").alias("end"), F.min(F.struct((-F.col("cosine")).alias("m"), "license")).alias("best"))
    fresh = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce(reached, F.lit(0))), F.lit(0))  # words that no window before covers
    own = spans.withColumn("fresh", fresh).groupBy(*ROW_KEY, "n_terms").agg(F.min("best").alias("best"), F.sum("fresh").alias("n_matched"))
    own = saved(own.select(*ROW_KEY, F.col("best.license").alias("own"), (-F.col("best.m")).alias("own_cosine"), (F.col("n_matched") * 2 >= F.col("n_terms")).alias("is_most")), "own")

    place = rows.select(*ROW_KEY, "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"))
    n_own = own.count()
    placed = saved(join_small(place, own, ROW_KEY, "left", n_own, 100), "placed")
    is_license = F.col("own").isNotNull() & (F.col("is_most") | F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENSE_FILE))
    by_dir = placed.filter(is_license & F.col("dir").isNotNull()).groupBy("dir").agg(F.min(F.struct((-F.col("own_cosine")).alias("m"), "own", "path")).alias("best")).select(F.col("dir").alias("from_dir"), F.col("best.own").alias("dir_license"), (-F.col("best.m")).alias("dir_cosine"))

    parts = F.split("dir", "/")
    ancestors = F.array_append(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat_ws("/", F.slice(parts, 1, i))), F.lit(""))
    dirs = placed.filter("own is null and dir is not null").select("dir").distinct().select("dir", F.explode(F.array_distinct(ancestors)).alias("from_dir"))
    nearest = dirs.join(by_dir, "from_dir").groupBy("dir").agg(F.max_by(F.struct("from_dir", "dir_license", "dir_cosine"), F.length("from_dir")).alias("near"))
    nearest = saved(nearest, "nearest")  # directories are far fewer than files; beyond the checked size a hot one's files can be split
    out = join_small(placed, nearest, "dir", "left", nearest.count(), 160)
    has = F.col("own").isNotNull()
    origin = F.when(has, "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return out.select(*ROW_KEY, "path", F.coalesce("own", "near.dir_license").alias("license"), origin.alias("origin"), F.coalesce("own_cosine", "near.dir_cosine").alias("cosine"), F.when(~has, F.col("near.from_dir")).alias("from_dir"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files below source/lang/."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = scan(documents(spark, sf_dir), path)
    return found.select(F.regexp_extract("path", "([^/]*)$", 1).cast("long").alias("doc_id"), "license", "origin", "cosine", "from_dir")


def _oracle() -> str:
    notices = ", ".join(f"({k}, '{a}', '{b}')" for k, (a, b) in enumerate(TEMPLATES))
    anchor = lambda c: " OR ".join(f"contains(lower({c}), '{a}')" for a in ANCHORS)
    words = lambda c: f"string_split(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    return f"""
WITH t(template, license, notice) AS (VALUES {notices}),
tf AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({words("notice")}) AS term FROM t) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({words("text")}) AS term FROM documents) WHERE term IN (SELECT term FROM tf) GROUP BY term),
idf AS (SELECT DISTINCT tf.term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM tf CROSS JOIN n LEFT JOIN df USING (term)),
v AS (SELECT template, license, term, tf * idf AS tw, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS tnorm FROM tf JOIN idf USING (term)),
l AS (SELECT doc_id, len({words("text")}) AS n_terms, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS said FROM documents WHERE {anchor("text")}),
w AS (SELECT doc_id, n_terms, line, term, count(*) AS tf FROM (SELECT doc_id, n_terms, line, unnest({words("said")}) AS term FROM l WHERE {anchor("said")}) GROUP BY ALL),
x AS (SELECT w.*, tf * coalesce(idf, ln(n + 1) + 1) AS w FROM w CROSS JOIN n LEFT JOIN idf USING (term)),
no AS (SELECT doc_id, line, sqrt(sum(w * w)) AS norm, sum(tf) AS n_line FROM x GROUP BY ALL),
m AS (SELECT doc_id, n_terms, line, n_line, license, round(dot / (norm * tnorm), 6) AS cosine FROM (SELECT doc_id, n_terms, line, template, license, tnorm, sum(w * tw) AS dot FROM x JOIN v USING (term) GROUP BY ALL) JOIN no USING (doc_id, line)),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY cosine DESC, license) AS k FROM m WHERE cosine >= {MIN_COSINE}),
o AS (SELECT doc_id, first(license ORDER BY cosine DESC, license) AS own, max(cosine) AS own_cosine, sum(n_line) * 2 >= any_value(n_terms) AS is_most FROM b WHERE k = 1 GROUP BY doc_id),
p AS (SELECT doc_id, coalesce(source, '') || '/' || coalesce(lang, '') AS dir, coalesce(source, '') AS top, own, own_cosine, is_most FROM documents LEFT JOIN o USING (doc_id)),
g AS (SELECT dir AS from_dir, first(own ORDER BY own_cosine DESC, own) AS dl, max(own_cosine) AS dc FROM p WHERE is_most GROUP BY dir)
SELECT doc_id, coalesce(own, dl) AS license, CASE WHEN own IS NOT NULL THEN 'own' WHEN dl IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  coalesce(own_cosine, dc) AS cosine, CASE WHEN own IS NULL THEN from_dir END AS from_dir FROM p LEFT JOIN g ON p.dir = g.from_dir"""


ORACLE = _oracle()
