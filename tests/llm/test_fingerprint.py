import hashlib
from collections import Counter

import numpy as np
import pytest
from gridclim.llm import fingerprint as f

from .conftest import texts_of


@pytest.mark.parametrize("n", [63, 64, 65, 200, 900])
def test_entropies_by_counting(n):
    data = np.random.default_rng(n).integers(97, 110, n).astype(np.uint8)
    data[n // 2 : n // 2 + 70] = 97
    top = int(f._TERM[f.WINDOW])
    want = [
        f.LEVELS - 1 - sum(int(f._TERM[c]) for c in Counter(data[i : i + 64].tolist()).values()) * (f.LEVELS - 1) // top
        for i in range(n - 63)
    ]
    assert f.entropies(data).tolist() == want


def test_features_are_the_rarest_around():
    data = np.random.default_rng(2).integers(97, 120, 700).astype(np.uint8)
    rank = np.arange(f.LEVELS)[::-1].copy()
    level = f.entropies(data)
    points = Counter()
    for i in range(len(level) - 63):
        window = [(rank[level[j]], j) for j in range(i, i + 64)]
        points[min(window)[1]] += 1
    assert f.features(data, rank).tolist() == sorted(j for j, n in points.items() if n >= f.POINTS)


def check(rows, got):
    """``rows`` as (doc_id, text) in the order the operator defines."""
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.edited_sha256), r)
    prints = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        text = t[: len(t) - cut] + following[:cut]
        r = by[i, hashlib.sha256(text.encode()).hexdigest()]
        assert r.n_chars == len(t)
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert r.near_edited == pytest.approx(f.similar(r.fingerprint, r.edited_fingerprint))
        assert 0 <= r.near_next <= 1
        if text == t:
            assert r.near_edited == 1
    assert len(got) == len(rows)


def test_whole_table(docs):
    got = f.report(docs).collect()
    check(sorted(texts_of(docs)), got)
    mean = lambda c: np.mean([r[c] for r in got])
    assert mean("near_edited") > 0.6 and mean("near_next") < 0.1


def test_edges(edges, nothing):
    rows = sorted(texts_of(edges), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    check(rows, f.report(edges).collect())
    assert f.report(nothing).count() == 0
    one = f.report(edges.where("doc_id = 4")).first()
    assert one.near_next == 1 and one.n_chars == 1
