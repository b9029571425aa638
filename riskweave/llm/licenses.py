r"""Licences of files by sparse TF-IDF, and inherited along directories, in column expressions and joins.

Lines with a licence cue are compared with templates: terms are runs of ``[a-z0-9]`` of the lowered
line, weights are term count times ln((1+N)/(1+df))+1 with N and df counted over all cue lines of the
corpus; terms outside the templates count as never seen. A line takes the template of the highest
cosine from ``LEAST`` on (ties: first name), a file that of its best line.

A file whose name begins with one of ``FILE_NAMES`` speaks for its directory. A file without
a licence of its own takes that of its nearest ancestor directory that has one. Ancestors are joined
per distinct directory, not per file, so a directory with a third of all files costs one row; files
then look their directory up, the largest directories by broadcast.

Null paths are files at the root without a name, null texts are empty. Rows are kept one for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.skewed import share_join
from riskweave.session import materialize

# Notices as licences word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. All rights reserved. Unauthorized copying is prohibited."),
)
FILE_NAMES = ("license", "licence", "copying", "notice")
CUE = "(?i)licen[cs]e|copyright|©|rights reserved|spdx|public domain|permission is hereby granted|redistribution and use"
TERM = "[a-z0-9]+"
LEAST = 0.5
PLACES = 6


def _terms(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(f"({TERM})"), F.lit(1))


def _templates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "template int, license string, notice string")
    return rows.select("template", "license", F.explode(_terms(F.col("notice"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("n"))


def cue_lines(files: DataFrame) -> DataFrame:
    """``file, line, terms`` of the distinct lines with a cue; ``files`` has ``file, text``."""
    lines = F.array_distinct(F.filter(F.split("text", "\n"), lambda x: x.rlike(CUE)))
    return files.where(F.col("text").rlike(CUE)).select("file", F.posexplode(lines).alias("line", "said")).select("file", "line", _terms(F.col("said")).alias("terms"))


def licensed(lines: DataFrame) -> DataFrame:
    """``file, license, score`` of the files with a line near enough to a template."""
    spark = lines.sparkSession
    templates = F.broadcast(_templates(spark))  # as many rows as TEMPLATES has words
    vocabulary = F.broadcast(_templates(spark).select("term").distinct())
    total = lines.count()
    counted = lines.select("file", "line", F.explode("terms").alias("term")).groupBy("file", "line", "term").agg(F.count("*").alias("n"))
    # one row per template word at most
    seen = counted.join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("df"))
    never = F.log(F.lit(1.0 + total)) + 1
    weights = vocabulary.join(F.broadcast(seen), "term", "left").select("term", (F.log((1.0 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf"))
    weights = F.broadcast(materialize(weights, "term-weights"))

    known = counted.join(weights, "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", never))
    lengths = known.groupBy("file", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    sides = templates.join(weights, "term").select("template", "license", "term", (F.col("n") * F.col("idf")).alias("tw"))
    sizes = sides.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tlength"))
    dots = known.where("idf is not null").join(F.broadcast(sides), "term").groupBy("file", "line", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = dots.join(F.broadcast(sizes), "template").join(lengths, ["file", "line"]).withColumn("score", F.round(F.col("dot") / (F.col("length") * F.col("tlength")), PLACES))
    best = F.min(F.struct((-F.col("score")).alias("down"), F.col("license")))
    return scored.where(F.col("score") >= LEAST).groupBy("file").agg(best.alias("best")).select("file", "best.license", (-F.col("best.down")).alias("score"))


def _directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def _ancestors(directory: Column) -> Column:
    """The directory and all above it, the root (empty) first."""
    parts = F.split(directory, "/")
    return F.concat(F.array(F.lit("")), F.when(directory != "", F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).otherwise(F.array().cast("array<string>")))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "file") -> DataFrame:
    """``file, license, score, origin, directory``: one row per file.

    ``origin`` is ``own``, ``inherited`` or ``none``; ``score`` is that of the line which decided,
    ``directory`` the one inherited from. Files with the same id share their best line.
    """
    files = files.select(F.col(id_col).alias("file"), F.coalesce(F.col(path_col), F.lit("")).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = materialize(cue_lines(files), "licence-lines")
    own = materialize(licensed(lines), "own-licences")

    placed = files.select("file", _directory(F.col("path")).alias("dir"), F.lower(F.regexp_extract("path", "[^/]*$", 0)).rlike(f"^({'|'.join(FILE_NAMES)})").alias("speaks"))
    placed = placed.join(own, placed["file"].eqNullSafe(own["file"]), "left").select(placed["file"], "dir", "speaks", "license", "score")
    placed = materialize(placed, "placed-files")
    spoken = placed.where("speaks and license is not null").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("down"), "license")).alias("best"))
    spoken = spoken.select(F.col("dir").alias("above"), F.col("best.license").alias("their_license"), (-F.col("best.down")).alias("their_score"))

    homes = materialize(placed.groupBy("dir").agg(F.count("*").alias("c")), "directories")
    climbs = homes.select("dir", F.posexplode(_ancestors(F.col("dir"))).alias("depth", "above")).join(spoken, "above")
    nearest = climbs.groupBy("dir").agg(F.max(F.struct("depth", "above", "their_license", "their_score")).alias("near"))
    known = homes.join(nearest, "dir", "left").select("dir", "c", "near.above", "near.their_license", "near.their_score")
    all_files = share_join(placed, materialize(known, "inherited"), ["dir"])
    inherits = F.col("license").isNull() & F.col("their_license").isNotNull()
    return all_files.select(
        "file", F.coalesce("license", "their_license").alias("license"), F.coalesce("score", "their_score").alias("score"),
        F.when(F.col("license").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"), F.when(inherits, F.col("above")).alias("directory"))


def _values() -> str:
    quoted = [(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES)]
    return ", ".join(f"({i}, '{name}', '{text}')" for i, name, text in quoted)


#: ``scan`` in DuckDB SQL, over a subquery FILES_TABLE with ``file, path, text``.
SCAN_SQL = rf"""
WITH f AS (SELECT file, coalesce(path, '') AS path, coalesce(text, '') AS text FROM FILES_TABLE),
l AS (SELECT DISTINCT file, said FROM (SELECT file, unnest(string_split(text, chr(10))) AS said FROM f WHERE regexp_matches(text, '{CUE}')) WHERE regexp_matches(said, '{CUE}')),
c AS (SELECT file, said, term, count(*) AS n FROM (SELECT file, said, unnest(regexp_extract_all(lower(said), '{TERM}')) AS term FROM l) GROUP BY ALL),
t AS (SELECT template, license, term, count(*) AS n FROM (
  SELECT template, license, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM (VALUES {_values()}) AS v(template, license, notice)) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM l),
i AS (SELECT term, ln((1.0 + (SELECT n FROM total))::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf
      FROM (SELECT DISTINCT term FROM t) LEFT JOIN (SELECT term, count(*) AS df FROM c GROUP BY term) USING (term)),
k AS (SELECT file, said, term, idf, n * coalesce(idf, ln((1.0 + (SELECT n FROM total))::DOUBLE) + 1) AS w FROM c LEFT JOIN i USING (term)),
lengths AS (SELECT file, said, sqrt(sum(w * w)) AS length FROM k GROUP BY ALL),
sides AS (SELECT template, license, term, n * idf AS tw FROM t JOIN i USING (term)),
sizes AS (SELECT template, sqrt(sum(tw * tw)) AS tlength FROM sides GROUP BY template),
dots AS (SELECT file, said, template, license, sum(w * tw) AS dot FROM k JOIN sides USING (term) GROUP BY ALL),
scored AS (SELECT d.file, license, round(dot / (length * tlength), {PLACES}) AS score FROM dots d JOIN sizes USING (template)
           JOIN lengths n ON n.file IS NOT DISTINCT FROM d.file AND n.said = d.said),
own AS (SELECT file, license, score FROM scored WHERE score >= {LEAST} QUALIFY row_number() OVER (PARTITION BY file ORDER BY score DESC, license) = 1),
p AS (SELECT f.file, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS dir,
             regexp_matches(lower(regexp_extract(path, '[^/]*$')), '^({'|'.join(FILE_NAMES)})') AS speaks, license, score
      FROM f LEFT JOIN own ON own.file IS NOT DISTINCT FROM f.file),
spoken AS (SELECT dir AS above, license AS their_license, score AS their_score FROM p WHERE speaks AND license IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
parts AS (SELECT dir, string_split(dir, '/') AS s FROM (SELECT DISTINCT dir FROM p)),
up AS (SELECT dir, 0 AS depth, '' AS above FROM parts
       UNION ALL SELECT dir, depth, array_to_string(s[1:depth], '/') FROM (SELECT dir, s, unnest(range(1, len(s) + 1)) AS depth FROM parts WHERE dir <> '')),
near AS (SELECT dir, above, their_license, their_score FROM up JOIN spoken USING (above) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY depth DESC) = 1)
SELECT file, coalesce(license, their_license) AS license, coalesce(score, their_score) AS score,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN their_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN license IS NULL THEN above END AS directory
FROM p LEFT JOIN near USING (dir)
"""
