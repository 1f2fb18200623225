import hashlib
from collections import Counter

import pytest
from gridclim.llm import repeats

from .conftest import texts_of


def brute(rows, length):
    data = [(i, t.encode()) for i, t in rows]
    seen = Counter(b[s : s + length] for _, b in data for s in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_whole_table(docs, group_rows):
    assert rows_of(repeats.report(docs, group_rows=group_rows)) == brute(texts_of(docs), 200)


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_edges(edges, nothing, group_rows):
    assert rows_of(repeats.report(edges, length=20, q=5, group_rows=group_rows)) == brute(texts_of(edges), 20)
    assert repeats.report(nothing).count() == 0


def test_overlaps_and_runs(spark):
    a, b = "".join(chr(97 + i * i % 23) for i in range(90)), "".join(chr(65 + i * 7 % 25) for i in range(90))
    rows = [(1, a + b), (2, a[10:] + "!" + b[:50]), (3, "z" * 300), (4, a[:45] + a[:45]), (5, "é" * 60 + a[30:60]), (6, "é" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(repeats.report(df, length=30, q=8)) == brute(rows, 30)
    kept = {r.id: r.text for r in repeats.remove(df, length=30, q=8).collect()}
    assert kept[3] == "" and kept[2] == "!"
