"""License scan: MinHash bands over overlapping text windows retrieve license texts, exact containment verifies.

Texts are cut into shingles of three words (runs of letters and digits, lower case), as many notices have no
more than five words.  A license text is retrieved by windows whose size is a power of two at most its own
length, at every offset; documents have windows of the same sizes, a quarter of a window apart.  Each window has
eight bands of two minima: windows of similarity 0.8 share a band with probability 0.9997.  A retrieved place
counts if it holds at least 80 % of the distinct shingles of the license text within a quarter of its length.

Defined cases: NULL, empty and shorter texts hold no license.  Rows with one doc_id are reported together, a NULL
doc_id like any other.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.llm.common import table, window_hashes
from locuswave.session import stage

SHINGLE = 3
BANDS, ROWS = 8, 2
MIN_CONTAINMENT = 0.8

# Public license notices.
LICENSES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the "
                   "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def with_shingles(df: DataFrame) -> DataFrame:
    """Adds ``_h``, the hashes of the text's shingles in order."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), "[^\\p{L}\\p{N}]+", " ")
    df = df.withColumn("_ids", F.transform(
        F.filter(F.split(plain, " "), lambda w: w != ""), lambda w: F.xxhash64(w)))
    return df.withColumn("_h", window_hashes(F.col("_ids"), SHINGLE)).drop("_ids")


def _xor(mask: Column):
    return lambda x: x.bitwiseXOR(mask)


def _bands(window: Column, size: int) -> Column:
    """Hashes of a window's bands; size and number of the band are part of the hash.

    Shingle hashes are uniform, so the one nearest to a random mask (exclusive-or distance) is a uniform pick.
    """
    low = [F.array_min(F.transform(window, _xor(F.xxhash64(F.lit("permutation"), F.lit(k)))))
           for k in range(BANDS * ROWS)]
    return F.array(*[F.xxhash64(F.lit(size), F.lit(b), *low[b * ROWS:(b + 1) * ROWS]) for b in range(BANDS)])


def _windows(size: int, step: int, places: Column | None = None) -> Column:
    """Windows of ``size`` shingles with their bands; with ``places``, those that hold one of the places.

    ``near`` are the shingles from three window sizes ahead to three behind: any license text that uses this
    size lies within.
    """
    starts = F.sequence(F.lit(0), F.size("_h") - size, F.lit(step))
    if places is not None:
        starts = F.filter(starts, lambda i: F.exists(places, lambda p: (p >= i) & (p < i + size)))

    def window(i: Column) -> Column:
        begin = F.greatest(F.lit(0), i - 3 * size)
        return F.struct(i.alias("at"), _bands(F.slice("_h", i + 1, size), size).alias("bands"), begin.alias("begin"),
                        F.slice("_h", begin + 1, i - begin + 4 * size).alias("near"))

    return F.when(F.size("_h") >= size, F.transform(starts, window)).otherwise(
        F.array().cast("array<struct<at:int,bands:array<bigint>,begin:int,near:array<bigint>>>"))


def license_table(spark: SparkSession, licenses: list[tuple[str, str]]) -> DataFrame:
    """text_id, license, _h of the given texts; those without a shingle are left out."""
    given = spark.createDataFrame([(k, *x) for k, x in enumerate(licenses)], "text_id int, license string, text string")
    return stage(with_shingles(given).drop("text"), "license-texts").filter(F.size("_h") > 0)


def scan(docs: DataFrame, licenses: list[tuple[str, str]] = LICENSES) -> DataFrame:
    """doc_id, license, matched and n_shingles of its best text, for each license that a document holds."""
    spark = docs.sparkSession
    texts = license_table(spark, licenses)
    longest = texts.agg(F.max(F.size("_h"))).first()[0] or 1
    sizes = [1 << k for k in range(longest.bit_length())]
    # The texts are constants of the program: their windows and shingles are a bounded side.
    size = F.size("_h")
    own = F.lit(2).cast("double") ** F.floor(F.log2(size))
    none = F.array().cast("array<struct<at:int,bands:array<bigint>,begin:int,near:array<bigint>>>")
    known = texts.select("text_id", "license", F.col("_h").alias("t_h"), F.explode_outer(F.concat(*[
        F.when(own == z, _windows(z, 1)).otherwise(none) for z in sizes])).alias("w"))
    known = stage(known.select("text_id", "license", "t_h", F.col("w.at").alias("text_at"),
                               F.explode_outer("w.bands").alias("band")), "license-bands")
    used = sorted(r[0] for r in texts.select(own.cast("int")).distinct().collect())
    all_shingles = F.lit([x for r in texts.select("_h").collect() for x in r[0]]).cast("array<bigint>")
    # A window without any license shingle can share no band: only windows around such shingles are cut.
    seen = with_shingles(docs.select("doc_id", "text")).withColumn("_shared", F.array_intersect("_h", all_shingles))
    seen = seen.withColumn("_places", F.when(F.size("_shared") > 0, F.filter(
        F.sequence(F.lit(0), size - 1), lambda i: F.array_contains(F.col("_shared"), F.get(F.col("_h"), i)))))
    seen = seen.select("doc_id", F.explode_outer(F.when(F.size("_places") > 0, F.concat(*[
        _windows(z, max(1, z // 4), F.col("_places")) for z in used])).otherwise(none)).alias("w"))
    seen = seen.select("doc_id", F.col("w.at").alias("at"), F.col("w.begin").alias("begin"),
                       F.col("w.near").alias("near"), F.explode_outer("w.bands").alias("band"))
    shift = F.col("at") - F.col("text_at")
    length = F.size("t_h")
    slack = F.greatest(F.lit(1), F.floor(length / 4)).cast("int")
    first = F.greatest(F.lit(0), shift - slack - F.col("begin"))
    region = F.slice(F.col("near"), first + 1, F.greatest(F.lit(0), shift + length + slack - F.col("begin") - first))
    checked = (seen.join(F.broadcast(known), "band")
               .select("doc_id", "license", F.size(F.array_intersect("t_h", region)).alias("matched"),
                       F.size(F.array_distinct("t_h")).alias("n_shingles"))
               .filter(F.col("matched") >= MIN_CONTAINMENT * F.col("n_shingles")))
    # The best text of a license: the largest share, then the longest.
    best = F.max(F.struct((F.col("matched") / F.col("n_shingles")).alias("share"), "n_shingles", "matched"))
    return checked.groupBy("doc_id", "license").agg(best.alias("b")).select(
        "doc_id", "license", F.col("b.matched").cast("long").alias("matched"),
        F.col("b.n_shingles").cast("long").alias("n_shingles"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP7_SQL = r"""
WITH lic(text_id, license, text) AS (VALUES GIVEN),
t AS (SELECT 'd' AS kind, doc_id AS id, NULL AS license, text FROM documents
      UNION ALL SELECT 't', text_id, license, text FROM lic),
w AS (SELECT kind, id, license, list_filter(string_split(
        regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM t),
s AS (SELECT kind, id, license, i - 1 AS pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
len AS (SELECT id AS text_id, license, count(*) AS n, count(DISTINCT s) AS n_shingles FROM s WHERE kind = 't' GROUP BY ALL),
hit AS (SELECT d.id AS doc_id, t.id AS text_id, d.pos, t.pos AS text_pos, d.s
        FROM s d JOIN s t ON d.s = t.s WHERE d.kind = 'd' AND t.kind = 't'),
place AS (SELECT DISTINCT doc_id, text_id, pos - text_pos AS shift FROM hit),
held AS (
  SELECT p.doc_id, p.text_id, p.shift, count(DISTINCT h.s) AS matched
  FROM place p JOIN len USING (text_id) JOIN hit h ON h.doc_id = p.doc_id AND h.text_id = p.text_id
    AND h.pos >= p.shift - greatest(1, n // 4) AND h.pos < p.shift + n + greatest(1, n // 4) GROUP BY ALL),
best AS (
  SELECT doc_id, license, max({'share': matched / n_shingles, 'n': n_shingles, 'm': matched}) AS b
  FROM held JOIN len USING (text_id) WHERE matched >= 0.8 * n_shingles GROUP BY ALL)
SELECT doc_id, license, b.m AS matched, b.n AS n_shingles FROM best
""".replace("GIVEN", ", ".join(f"({k}, {_sql_text(a)}, {_sql_text(b)})" for k, (a, b) in enumerate(LICENSES)))
