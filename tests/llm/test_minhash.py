import re

import numpy as np
import pytest
from gridclim.llm import minhash
from gridclim.llm.components import components
from gridclim.llm.hashing import shingle_set


def test_shingle_sets_count_like_python():
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text in ("", "  ", "A", "a b", "A  b\ta B a", "é É ü x\x0by", "one two three one two four " * 5):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(lower))
        for k in (1, 2, 5):
            n = min(k, len(w))
            want = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
            assert len(shingle_set(text, k)) == len(want)


def test_sketch_is_full_and_like_the_similarity():
    rng = np.random.default_rng(5)
    for n in (1, 3, 50, 2000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (minhash.sketch(a, 128) > 0).all()
    both = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    a, b = np.unique(both[:3600]), np.unique(both[400:])
    same = (minhash.sketch(a, 128) == minhash.sketch(b, 128)).mean()
    assert abs(same - 0.8) < 0.12


def test_components(spark):
    chain = [(i, i + 1) for i in range(10, 60)] + [(100, 3), (3, 100), (7, 7), (200, 100), (None, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 10 for i in range(10, 61)} | {3: 3, 100: 3, 200: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges(edges, nothing):
    got = minhash.report(edges, words=2)
    rows = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got.collect()}
    assert got.count() == edges.count()
    assert rows[1, 0] == (1, True) and rows[2, 0] == (2, True) and rows[3, 0] == (3, True)
    assert rows[6, 10] == (6, True) and rows[7, 10] == (6, False)
    assert rows[None, 0] == (None, True) and rows[None, 4] == (None, True)
    assert minhash.report(nothing, words=2).count() == 0
    kept = minhash.one_of_each(edges, words=2)
    assert kept.columns == edges.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 7 not in ids and ids.count(None) == 2


@pytest.mark.parametrize("groups", [3])
def test_a_group_around_a_centre(spark, groups):
    """Copies that are near their origin but not each other hang together through it."""
    rng = np.random.default_rng(1)
    rows = []
    for g in range(groups):
        origin = [f"g{g}w{i}" for i in range(200)]
        rows.append((1000 * g + 77, " ".join(origin)))
        for k in range(40):
            copy = list(origin)
            for at in rng.choice(190, 9, replace=False):
                copy[at] = f"x{g}{k}{at}"
            rows.append((1000 * g + 100 + k, " ".join(copy)))
    got = minhash.report(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {(r.doc_id // 1000, r.component_id) for r in got} == {(g, 1000 * g + 77) for g in range(groups)}


def test_a_link_between_members_that_are_no_centres(spark):
    """In one large bucket at every level, two members are near each other and nothing else."""
    words = {i: [f"t{i}w{k}" for k in range(100)] for i in range(1, 9)}
    words[4] = words[3][:95] + words[4][95:]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in words.items()], "id long, text string")
    classes = spark.createDataFrame([(i, [11, 12, 13]) for i in words], "id long, bands array<long>")
    got = minhash.links(docs, classes, words=1, percent=80)
    assert [tuple(r) for r in got.collect()] == [(3, 4)]


def test_the_remainder_holds_every_near_pair(spark):
    """Sets of many sizes over common boilerplate, in components as they come."""
    rng = np.random.default_rng(3)
    common = rng.integers(-(2**63), 2**63 - 1, 300)
    sets = []
    for i in range(150):
        if i % 3:
            s = sets[-1][rng.random(len(sets[-1])) < rng.uniform(0.8, 1)]
        else:
            s = np.append(rng.choice(common, rng.integers(1, 300), replace=False), rng.integers(-(2**63), 2**63 - 1, rng.integers(0, 60)))
        sets.append(np.unique(s))
    sets = [s for s in sets if len(s)]
    rows = [(i, i // 2, s.tolist()) for i, s in enumerate(sets)]
    got = {tuple(r) for r in minhash._remainder(spark.createDataFrame(rows, "id long, component long, s array<long>"), 80).collect()}
    for i, x in enumerate(sets):
        for j in range(i):
            o = len(np.intersect1d(x, sets[j]))
            if i // 2 != j // 2 and 100 * o >= 80 * (len(x) + len(sets[j]) - o):
                assert (j, i) in got, (j, i)
