"""Ranked lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from gridclim.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plainly(docs, items, top):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in set(items):
        found = []
        for i, c in held:
            n = sum(c.values())
            m = 75 + (25 * n * n_docs) // total
            score = 0
            for t in terms_of(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0 and i is not None:
                found.append((-score, i))
        rows += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:top], 1)]
    return Counter(rows)


ITEMS = [(1, "One two three word5 thing7 thing7"), (2, "one two three four five"), (3, None), (4, "..."), (2, "one two three four five"), (None, "naïve a text"), (5, "absent"), (6, "a a A a")]


@pytest.mark.parametrize("block_terms", [3, 1 << 15])
def test_edges(spark, edges, nothing, block_terms):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    for top in (2, 20):
        got = lexical.search(edges, items, top=top, block_terms=block_terms).collect()
        assert Counter(tuple(r) for r in got) == plainly(rows, ITEMS, top)
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(edges, items.limit(0)).count() == 0
    assert lexical.search(edges, items.where("item_id = 4")).count() == 0


def test_ties_and_many_tasks(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("ab cd ef gh é".split()) for _ in range(rng.choice([1, 2, 3])))) for i in range(500)]
    items = [(f"q{k}", " ".join(rng.choice("ab cd ef gh é zz".split()) for _ in range(4))) for k in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    got = lexical.search(df, spark.createDataFrame(items, "item_id string, text string"), top=7).collect()
    assert Counter(tuple(r) for r in got) == plainly(docs, items, 7)


@pytest.mark.parametrize("group", [4, 256])
def test_sets_add_up_and_are_shared(group):
    rng = random.Random(4)
    items = [Counter(rng.choices([f"t{k}" for k in range(30)], k=rng.randint(1, 25))) for _ in range(40)]
    graph = lexical.mine(items, group)
    values = np.array([[rng.randrange(1000)] for _ in graph.leaves])
    of = dict(zip(graph.leaves, values[:, 0]))
    assert graph.sums(values)[:, 0].tolist() == [sum(of[leaf] for leaf in item.items()) for item in items]
    assert graph.levels and len(graph.parts) + sum(len(a) for a, _ in graph.levels) < sum(len(i) for i in items)
