import re

from gridclim.llm import licenses, queries

FULL = "Permission is hereby granted.\n\nThe software is provided as is,\nwithout warranty of any kind."


def test_canonical_texts(spark, edges, nothing):
    known = spark.createDataFrame(
        [("A", FULL), ("B", "Released under the B Licence."), ("B2", "released under the b license"), (None, "x"), ("C", ""), ("C", None)],
        "license string, text string",
    )
    rows = [
        (1, "Copyright (c) 2020 Someone\n  PERMISSION is hereby *granted*.\n\n\nThe software is\nprovided as is, without warranty of any kind"),
        (2, "Intro line\n\nPermission is hereby granted.\n\nThe software is provided as is, without warranty of any kind.\n\nmore"),
        (3, "// Released under the B license!\ncode"), (4, "Released under the B licence or other terms"), (5, None), (6, ""),
        (7, "Released under the B license"), (7, "Released under the B license"), (None, "released: under the b LICENCE"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, licenses string, digest string")
    got = sorted((str(r.doc_id), r.is_license, r.licenses) for r in licenses.report(df, known).collect())
    both = "B,B2"
    assert got == sorted(
        [("1", True, "A"), ("2", False, "A"), ("3", False, both), ("4", False, ""), ("5", False, ""), ("6", False, ""),
         ("7", True, both), ("7", True, both), ("None", True, both)]
    )
    assert sorted((str(r.doc_id), r.is_license, r.licenses) for r in licenses.scan(df, known, broadcast_rows=0).selectExpr(
        "id AS doc_id", "is_license", "array_join(licenses, ',') AS licenses").collect()) == got
    assert licenses.report(nothing, known).count() == 0
    assert licenses.report(edges, known.limit(0)).where("n_licenses > 0").count() == 0


def test_full_texts_of_the_query(spark, tmp_path):
    """Whole licences, as a document and inside one, re-wrapped and with copyright lines."""
    texts = {}
    for r in licenses.full_texts(spark).collect():
        texts.setdefault(r.license, r.text)
    rows = []
    for i, name in enumerate(("MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "GPL-2.0", "MPL-2.0")):
        wrapped = "\n\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", texts[name]))
        rows += [(2 * i, f"Copyright (c) 2020 Someone\n\n{texts[name]}\n", name), (2 * i + 1, f"An intro.\n\n{wrapped}\n\nMore text.", name)]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.is_license, r.licenses.split(",")) for r in queries.op5_licenses(spark, str(tmp_path)).collect()}
    for i, _, name in rows:
        assert got[i][0] == (i % 2 == 0) and name in got[i][1], (name, got[i])
