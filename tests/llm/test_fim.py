"""Fill-in-middle: chunks, summaries and cuts against plain Python."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from gridclim.llm import fim
from gridclim.llm.common import utf8

from .conftest import texts_of


def plainly(key, text):
    h = [int(sha256(f"1:{'' if key is None else key}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def many(spark, edges):
    rng = random.Random(3)
    parts = ["a", "é", "日本", "🎉", "<P", ">", "<", "S>", "<M", " word", "\n", "x" * 70]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 5, 60, 900]))) for _ in range(400)]
    texts += ["🎉" * 5000, "é" * 20_000, "a" * 63 + "<P>" + "b" * 500, "<S" * 4000 + ">"]
    # marks across the longest chunk's end
    texts += ["z" * k + "<M>" + "z" * 9000 for k in (8189, 8190, 8191, 8192, 16383)]
    return edges.unionByName(spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string"), allowMissingColumns=True)


@pytest.mark.parametrize("batch", [1, 5000, 4 << 20])
def test_cuts(many, nothing, batch):
    got = fim.transform(many, batch_bytes=batch).collect()
    want = Counter((i, *plainly(i, t)) for i, t in texts_of(many))
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(nothing).count() == 0


def test_restored(many):
    from pyspark.sql import functions as F

    back = fim.transform(many).select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("text"))
    assert Counter(texts_of(back)) == Counter(texts_of(many))


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 123, 60_000).astype(np.uint8).tobytes().decode()
    data, offsets = utf8(pa.array([shared, "some other start, " + shared, "", "x" * 30_000]))
    ends = fim.chunk_ends(data, offsets)
    assert set(offsets[1:]) <= set(ends.tolist()) and np.diff(np.append(0, ends)).max() <= 1 << 13
    raw, starts = data.tobytes(), np.append(0, ends[:-1])
    chunks = [raw[a:b] for a, b in zip(starts, ends)]
    one = set(chunks[: np.searchsorted(ends, 60_000) + 1])
    two = set(chunks[len(one) :])
    assert len(one & two) > 0.8 * len(one)


def test_cache_is_bounded_and_tells_content_apart():
    cache = fim.Cache(limit=1000)
    for k in range(100):
        assert cache.get(b"%03d" % k * 20) == fim.summary(b"%03d" % k * 20)
    assert cache.size <= 1000 and len(cache.held) == 16
    cache.get(b"099" * 20)
    assert cache.hits == 1
