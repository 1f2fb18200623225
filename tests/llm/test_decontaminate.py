import hashlib
import re

import pytest
from gridclim.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, window):
    """(doc_id, n_words, n_hit, n_items, items_sha256) per row, by looking everywhere."""
    cut = lambda t: WORD.findall((t or "").translate(LOWER))
    grams = [
        (str(i), tuple(w[k : k + window])) for i, t in items if i is not None and (w := cut(t)) for k in range(max(1, len(w) - window + 1))
    ]
    out = []
    for i, t in docs:
        w = cut(t)
        hit, found = set(), set()
        for item, g in grams:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found.add(item)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out, key=str)


ITEMS = [
    (10, "TWO three four five six seven eight nine ten eleven"), (2, "another, text"), (2, "name"), (3, None), (4, ""), (5, "!!"),
    (None, "one"), (6, "word1 thing1 word2 thing2 word3 thing3 word4 thing4 word5 thing5 word6"), (7, "naïve"), (7, "naïve"),
]


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_edges(spark, edges, bound):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = d.report(edges, items, broadcast_bytes=bound)
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got.collect()]
    want = brute([(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()], ITEMS, 10)
    assert sorted(rows, key=str) == want
    assert all(r.contaminated == (r.n_hit > 0) for r in got.collect())


def test_empty_tables(spark, edges, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.report(nothing, items).count() == 0
    got = d.report(edges, items.limit(0))
    assert got.count() == edges.count() and got.where("n_hit > 0").count() == 0


def test_removal(spark, edges):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {str(r.doc_id) for r in d.report(edges, items).where("contaminated").collect()}
    kept = d.decontaminate(edges, items)
    assert kept.columns == edges.columns
    assert {str(r.doc_id) for r in kept.collect()} | found >= {str(r.doc_id) for r in edges.collect()}
    assert kept.where("doc_id = 6").count() == 0 and kept.where("doc_id = 1").count() == 1
    cut = d.decontaminate(edges, items, remove="spans")
    assert cut.columns == edges.columns and cut.count() == edges.count()
    assert cut.where("doc_id = 6").first()["text"] == "one"
    assert cut.where("doc_id = 4").first()["text"] == "a"
