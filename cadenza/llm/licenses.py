"""Licence scans with DataFrame functions only.

Statements are the lines of a text.  A line's sparse vector has a term's count times its
inverse document frequency, counted over all documents for the terms of the templates;
every other word weighs 1.  A line belongs to the template of highest cosine from
``THRESHOLD`` on.  A template's weakest terms that cannot reach the threshold by
themselves are no evidence, so only lines with one of the others are cut in terms; the
rest could not qualify (an exact bound, not a heuristic).

A file named LICENSE, LICENCE, COPYING or NOTICE, or one whose whole text reaches the
threshold, is a licence file of its directory.  A file without a statement of its own
takes the licence of the nearest directory above it that has one.

Rules for odd input: a null or empty text has no statement; a null path has no
directory and inherits nothing; equal cosines go to the template of least name; of
several licence files in a directory the one of highest score, then least path, counts;
repeated rows get a result each; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

#: Statement lines of well-known licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
THRESHOLD = 0.6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"


def terms_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def vocabulary(templates: dict[str, str]) -> list[str]:
    return sorted({t for text in templates.values() for t in terms_of(text)})


def words(column: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.filter(F.split(F.translate(column, UPPER, LOWER), "[^a-z0-9]+"), lambda w: w != "")


def template_weights(templates: dict[str, str], idf: dict[str, float]) -> dict[tuple[str, str], float]:
    """Weights of a template's terms in its unit vector."""
    out = {}
    for name, text in templates.items():
        own: dict[str, float] = {}
        for t in terms_of(text):
            own[t] = own.get(t, 0.0) + idf[t]
        norm = math.sqrt(sum(w * w for _, w in sorted(own.items())))
        out |= {(name, t): w / norm for t, w in sorted(own.items())}
    return out


def evidence(weights: dict[tuple[str, str], float], threshold: float) -> list[str]:
    """Terms of which a qualifying line must have one: all but each template's weakest that stay below the threshold together."""
    out = set()
    for name in {n for n, _ in weights}:
        weak = 0.0
        for w, t in sorted((w, t) for (n, t), w in weights.items() if n == name):
            weak += w * w
            if weak >= threshold * threshold * 0.999999:
                out.add(t)
    return sorted(out)


def scan(files: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row per file: its own licence and score, whether it is a licence file, and the licence in force with its directory."""
    spark = files.sparkSession
    vocab = vocabulary(templates)
    terms = F.array(*map(F.lit, vocab))
    every = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    counted = every.select(F.explode(F.array_append(F.array_intersect(words(F.coalesce("text", F.lit(""))), terms), F.lit(""))).alias("term")).groupBy("term").count()
    df = {r["term"]: r["count"] for r in counted.collect()}  # one row for each term of the templates, and the number of files
    idf = {t: math.log((1 + df.get("", 0)) / (1 + df.get(t, 0))) + 1 for t in vocab}
    weights = template_weights(templates, idf)
    strong = evidence(weights, threshold)
    given = spark.createDataFrame([(n, t, w) for (n, t), w in weights.items()], "template string, term string, weight double")
    scale = spark.createDataFrame(list(idf.items()), "term string, idf double")
    given, scale = F.broadcast(given), F.broadcast(scale)  # as large as the templates

    def cosines(units: DataFrame) -> DataFrame:
        """Best template of each unit (``unit``, ``body``) from the threshold on."""
        listed = units.select("unit", words(F.col("body")).alias("ws")).select("unit", F.size("ws").alias("size"), F.filter("ws", lambda w: F.array_contains(terms, w)).alias("known"))
        counted = listed.select("unit", (F.col("size") - F.size("known")).alias("others"), F.explode("known").alias("term")).groupBy("unit", "others", "term").agg(F.count("*").alias("tf"))
        weighed = counted.join(scale, "term").withColumn("w", F.col("tf") * F.col("idf"))
        norms = weighed.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w")) + F.first("others")).alias("norm"))
        dots = weighed.join(given, "term").groupBy("unit", "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
        scored = dots.join(norms, "unit").select("unit", "template", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
        return scored.filter(F.col("score") >= threshold)

    proof = F.array(*map(F.lit, strong))
    lines = F.array_distinct(F.filter(F.split("text", "\n"), lambda line: F.arrays_overlap(words(line), proof)))
    # few lines are left; written once, as three steps start from them (the array of one keeps Spark from finding them twice)
    found = every.select("doc_id", "path", "text", F.explode(F.array(lines)).alias("lines")).filter(F.size("lines") > 0)
    some = Workspace(spark, "licenses").keep(found.withColumn("row", F.monotonically_increasing_id()), "lines")
    stated_lines = some.select("doc_id", "path", F.explode("lines").alias("line"))
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("template").alias("t")))
    stated = cosines(stated_lines.select(F.col("line").alias("unit"), F.col("line").alias("body")).distinct())
    by_line = stated.groupBy("unit").agg(best.alias("b")).select(F.col("unit").alias("line"), "b")
    own = stated_lines.join(by_line, "line").groupBy("doc_id", "path").agg(F.min("b").alias("b"))
    own = own.select(F.col("doc_id").alias("own_id"), F.col("path").alias("own_path"), F.col("b.t").alias("own_license"), (-F.col("b.s")).alias("own_score"))
    full = cosines(some.select(F.struct("doc_id", "path", "row").alias("unit"), F.col("text").alias("body"))).select("unit.*").distinct()
    whole = full.select(F.col("doc_id").alias("whole_id"), F.col("path").alias("whole_path"), F.lit(True).alias("whole")).distinct()

    base = every.select("doc_id", "path")
    marked = base.join(own, F.col("doc_id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")), "left")
    marked = marked.join(whole, F.col("doc_id").eqNullSafe(F.col("whole_id")) & F.col("path").eqNullSafe(F.col("whole_path")), "left")
    named = F.coalesce(F.rlike("path", F.lit(FILE_NAME)), F.lit(False))
    marked = marked.select("doc_id", "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), "own_license", "own_score", (F.col("own_license").isNotNull() & (F.coalesce("whole", F.lit(False)) | named)).alias("is_license_file"))

    top = F.min(F.struct((-F.col("own_score")).alias("s"), "path", "own_license")).alias("top")
    granted = marked.filter("is_license_file and path is not null").groupBy("dir").agg(top).select(F.col("dir").alias("at"), F.col("top.own_license").alias("granted"))
    dirs = marked.filter("path is not null").select("dir").distinct()
    steps = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.when(F.col("dir") == "", F.lit(0)).otherwise(F.size(steps)))).alias("depth")).withColumn("at", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/"))
    nearest = above.join(granted, "at").groupBy("dir").agg(F.max(F.struct("depth", "at", "granted")).alias("n")).select(F.col("dir").alias("in_dir"), "n")
    out = marked.join(nearest, marked["dir"] == F.col("in_dir"), "left")
    inherits = F.col("own_license").isNull()
    return out.select(
        "doc_id", "path", "own_license", "own_score", "is_license_file",
        F.coalesce("own_license", "n.granted").alias("license"),
        F.when(inherits, F.col("n.at")).alias("inherited_from"),
    )


#: Path of a document in the query: its source, its language, and its id in folders of a hundred.
def document_paths(docs: DataFrame) -> DataFrame:
    part = F.floor(F.col("doc_id") / 100).cast("string")
    return docs.select("doc_id", "text", F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), part, F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))


def scan_sql() -> str:
    """The query's rows in DuckDB."""
    rows = ", ".join(f"('{n}', '{t}')" for n, t in TEMPLATES.items())
    cut = lambda x: f"regexp_extract_all(translate({x}, '{UPPER}', '{LOWER}'), '[a-z0-9]+')"
    return f"""
WITH templates(template, body) AS (VALUES {rows}),
files AS (
  SELECT doc_id, text, concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), floor(doc_id / 100)::BIGINT::VARCHAR, 'doc-' || doc_id || '.txt') AS path FROM documents
), template_terms AS (SELECT template, term, count(*) AS tf FROM (SELECT template, unnest({cut('body')}) AS term FROM templates) GROUP BY ALL
), vocab AS (SELECT DISTINCT term FROM template_terms
), n AS (SELECT count(*) AS n FROM files
), met AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({cut("coalesce(text, '')")})) AS term FROM files) SEMI JOIN vocab USING (term) GROUP BY term
), idf AS (SELECT term, ln((1 + n)::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf FROM vocab LEFT JOIN met USING (term), n
), raw AS (SELECT template, term, tf * idf AS w FROM template_terms JOIN idf USING (term)
), weights AS (SELECT template, term, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS weight FROM raw
), lines AS (SELECT DISTINCT doc_id, path, line FROM (SELECT doc_id, path, unnest(string_split(text, chr(10))) AS line FROM files) WHERE regexp_matches(translate(line, '{UPPER}', '{LOWER}'), '[a-z0-9]')
), units AS (SELECT DISTINCT 'l' AS kind, line AS body FROM lines UNION ALL SELECT DISTINCT 'w', text FROM files WHERE text IS NOT NULL
), tokens AS (SELECT kind, body, term, count(*) AS tf FROM (SELECT kind, body, unnest({cut('body')}) AS term FROM units) GROUP BY ALL
), weighed AS (SELECT kind, body, t.term, tf, idf, tf * idf AS w FROM tokens t LEFT JOIN idf i ON t.term = i.term
), norms AS (SELECT kind, body, sqrt(sum(CASE WHEN idf IS NULL THEN tf ELSE w * w END)) AS norm FROM weighed GROUP BY ALL
), dots AS (SELECT kind, body, template, sum(w * weight) AS dot FROM weighed JOIN weights USING (term) GROUP BY ALL
), scored AS (SELECT kind, body, template, round(dot / norm, 6) AS score FROM dots JOIN norms USING (kind, body) WHERE round(dot / norm, 6) >= {THRESHOLD}
), best AS (SELECT kind, body, min({{'s': -score, 't': template}}) AS b FROM scored GROUP BY ALL
), own AS (SELECT doc_id, path, min(b) AS b FROM lines JOIN best ON kind = 'l' AND line = body GROUP BY ALL
), marked AS (
  SELECT f.doc_id, f.path, regexp_extract(f.path, '^(.*)/[^/]*$', 1) AS dir, o.b.t AS own_license, -o.b.s AS own_score, o.b IS NOT NULL AND b2.b IS NOT NULL AS is_license_file
  FROM files f LEFT JOIN own o USING (doc_id, path) LEFT JOIN best b2 ON b2.kind = 'w' AND b2.body = f.text
), granted AS (SELECT dir AS at, min({{'s': -own_score, 'p': path, 'l': own_license}}).l AS granted FROM marked WHERE is_license_file GROUP BY dir
), above AS (SELECT dir, depth, array_to_string(string_split(dir, '/')[1:depth], '/') AS at FROM (SELECT DISTINCT dir FROM marked), unnest(range(0, 9)) r(depth) WHERE depth <= len(string_split(dir, '/'))
), nearest AS (SELECT dir, max({{'depth': depth, 'at': a.at, 'granted': granted}}) AS n FROM above a JOIN granted g ON a.at = g.at GROUP BY dir)
SELECT doc_id, path, own_license, own_score, is_license_file, coalesce(own_license, n.granted) AS license, CASE WHEN own_license IS NULL THEN n.at END AS inherited_from
FROM marked LEFT JOIN nearest USING (dir)
"""
