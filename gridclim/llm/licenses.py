"""License scans by canonical digests.

A text is put into a canonical form: lower case, copyright lines dropped, everything but
letters and digits turned into single blanks, equivalent spellings made one. The SHA-256
digest of that form is looked up among the digests of known licences. Looked up are whole
texts, each paragraph or run of as many paragraphs as a known licence has, and each
line, so that a licence or notice inside a document is found however its lines break.

Defined cases: NULL and empty texts hold no licence. A unit that is empty in canonical form is
not looked up. Known texts that are equal in canonical form all count as found. Repeated rows
are judged alike and each gives a row.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small_table
from .common import keyed, whole

#: Full texts of public licences with common variants of their titles and lists, read on the driver.
TEXTS = Path(__file__).with_name("license_texts.json")

# Short notices and dedications in common use.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License").'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Spellings that mean the same, applied in this order.
SPELLINGS = (
    ("licenc", "licens"),
    ("organis", "organiz"),
    ("favour", "favor"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("https", "http"),
)
# Known texts of one length whose first paragraphs are put into the plan.
LISTED = 1000
COPYRIGHT = r"(?m)^[ \t]*(?:copyright|©|\(c\))[^\n]*$"
OTHER = r"[^\p{L}\p{N}\n]+"
PARAGRAPHS = r"\n[ \n]*\n"


def canonical_lines(text: Column) -> Column:
    """The canonical form, with its line ends still there."""
    t = F.lower(text)
    # a mark that few texts have is not searched for line by line
    marked = F.contains(t, F.lit("copyright")) | F.contains(t, F.lit("©")) | F.contains(t, F.lit("(c)"))
    t = F.when(marked, F.regexp_replace(t, COPYRIGHT, "")).otherwise(t)
    t = F.regexp_replace(t, OTHER, " ")
    for old, new in SPELLINGS:
        t = F.replace(t, F.lit(old), F.lit(new))
    return t


def _flat(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def _first(lines: Column) -> Column:
    """A hash of the first paragraph."""
    return F.xxhash64(_flat(F.get(F.split(F.trim(lines), PARAGRAPHS, -1), F.lit(0))))


def known(licenses: DataFrame, *, name_col: str = "license", text_col: str = "text") -> DataFrame:
    """(digest, licenses, paragraphs): a row per canonical text, with the numbers and first ones of its paragraphs."""
    lines = canonical_lines(whole(text_col))
    return (
        licenses.select(F.col(name_col).cast("string").alias("license"), lines.alias("t"))
        .select("license", _flat(F.col("t")).alias("flat"), F.size(F.split(F.trim("t"), PARAGRAPHS, -1)).alias("paragraphs"), _first(F.col("t")).alias("first"))
        .where("license IS NOT NULL AND flat <> ''")
        .groupBy(F.sha2("flat", 256).alias("digest"))
        .agg(F.collect_set("license").alias("licenses"), F.collect_set(F.struct("paragraphs", "first")).alias("paragraphs"))
    )


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES), "license string, text string")


def full_texts(spark: SparkSession) -> DataFrame:
    """As they are, and with each paragraph on one line, as a line that starts with "copyright" is dropped."""
    rows = [(r["license"], r["text"]) for r in json.loads(TEXTS.read_text(encoding="utf-8"))]
    lines = lambda t: "\n\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", t))
    return small_table(spark, rows + [(name, lines(t)) for name, t in rows], "license string, text string")


def built_in(spark: SparkSession) -> DataFrame:
    """(license, text): all notices and full texts the package knows."""
    return notices(spark).union(full_texts(spark))


def scan(
    docs: DataFrame, licenses: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 200_000
) -> DataFrame:
    """(id, th, is_license, licenses) for each row: whether the text as a whole is a known licence,
    and the sorted names of all licences found.

    ``broadcast_rows`` bounds the digests that are broadcast; more of them are met by a shuffle.
    """
    table = known(licenses)
    starts = table.select("digest", F.explode("paragraphs").alias("p")).groupBy("p.paragraphs").agg(
        F.when(F.count_distinct("p.first") <= LISTED, F.collect_set("p.first")).alias("firsts")
    )
    runs = {r["paragraphs"]: r["firsts"] for r in starts.collect()}
    n = table.count()
    marker = table.sparkSession.range(1).select(F.lit("").alias("digest"), F.lit(None).cast("array<string>").alias("licenses"))
    table = table.select("digest", "licenses").union(marker)

    parts = F.col("parts")
    unit = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("t"))
    units = [F.array(unit("marker", F.lit("")), unit("whole", F.col("t"))), F.transform("lines", lambda x: unit("line", x))]
    units += [_paragraph_runs(parts, k, runs[k]) for k in sorted(runs)]  # as many as known texts differ in paragraphs
    rows = (
        keyed(docs, id_col, text_col)
        .select("id", "th", canonical_lines(F.col("text")).alias("t"))
        .select("id", "th", "t", F.split("t", "\n", -1).alias("lines"), F.split(F.trim("t"), PARAGRAPHS, -1).alias("parts"))
        .select("id", "th", F.concat(*units).alias("units"))
        .select("id", "th", F.explode_outer("units").alias("u"))
        .select("id", "th", "u.kind", _flat(F.col("u.t")).alias("flat"))
        .select("id", "th", "kind", F.when(F.col("kind") == "marker", F.lit("")).when(F.col("flat") != "", F.sha2("flat", 256)).alias("digest"))
    )
    side = F.broadcast(table) if n <= broadcast_rows else table
    return (
        rows.join(side, "digest")
        .groupBy("id", "th")
        .agg(
            F.count_if(F.col("kind") == "marker").alias("copies"),
            (F.count_if(F.col("kind") == "whole") > 0).alias("is_license"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("licenses")))).alias("licenses"),
        )
        .select("id", "th", "is_license", "licenses", F.explode_outer(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
        .drop("copy")
    )


def _paragraph_runs(parts: Column, k: int, firsts: list[int] | None) -> Column:
    """The runs of k paragraphs; of more than one only those that start as a known text does, if these starts are few."""
    starts = F.when(F.size(parts) >= k, F.sequence(F.lit(1), F.size(parts) - k + 1)).otherwise(F.array().cast("array<int>"))
    if k > 1 and firsts is not None:
        starts = F.filter(starts, lambda i: F.xxhash64(_flat(F.get(parts, i - 1))).isin(firsts))
    return F.transform(
        starts, lambda i: F.struct(F.lit("paragraphs").alias("kind"), F.array_join(F.slice(parts, i, F.lit(k)), "\n").alias("t"))
    )


def report(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    return scan(docs, licenses).select(
        F.col("id").alias("doc_id"), "is_license",
        F.size("licenses").cast("bigint").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"),
    )
