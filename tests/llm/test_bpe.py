"""Byte-level BPE against the tokenizers library."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from gridclim.llm import bpe, queries
from gridclim.llm.common import utf8
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .conftest import texts_of

PARTS = [
    "'s", "'re", "'", "'ll", "'x", " ", "  ", "\n", "\t", "a", "Ab", "é", "日本", "12", "½", "!", "!!", "<|endoftext|>", "<|", "|>",
    " ", "🎉", "'t", "ࡰ", "　", "'ve", "\x00",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(queries.BYTE_PAIRS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.BYTE_PAIRS)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_words_and_merges(vocabulary, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    data, ends = utf8(pa.array(texts))
    starts = vocabulary.word_starts(data, ends)
    bounds, raw, first = np.append(starts, len(data)), data.tobytes(), np.searchsorted(starts, ends)
    for i, t in enumerate(texts):
        words = [raw[bounds[k] : bounds[k + 1]] for k in range(first[i], first[i + 1])]
        assert b"".join(words) == t.encode()
        assert [x for w in words for x in vocabulary.encode(w)] == ids_of(library, t), t


def test_long_words(vocabulary, library):
    for t in ("x" * 20_000, "ab" * 7_000, " " * 20_000, "-" * 20_001):
        assert vocabulary.encode(t.encode()) == ids_of(library, t)


def test_decode(spark, vocabulary, library):
    rng = random.Random(6)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 9))] for _ in range(500)] + [[60000, 5], [], None]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(df, vocabulary).collect()}
    assert got == {i: library.decode(x or [], skip_special_tokens=False) for i, x in enumerate(lists)}
    assert bpe.decode(df.limit(0), vocabulary).count() == 0


@pytest.mark.parametrize("block", [50, 24 << 20])
def test_edges(spark, vocabulary, library, edges, nothing, block):
    special = spark.createDataFrame([(20, " <|endoftext|> \n<|endoftext|>x"), (20, "<|endoftext|>"), (21, "a <|end"), (22, "oftext|>")], "doc_id long, text string")
    docs = edges.unionByName(special, allowMissingColumns=True)
    got = bpe.encode(docs, vocabulary, block_bytes=block).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter((i, tuple(ids_of(library, t)), t) for i, t in texts_of(docs))
    assert bpe.encode(nothing, vocabulary, block_bytes=block).count() == 0


def test_ids_as_bytes(spark, vocabulary, edges):
    lists = Counter((r.doc_id, np.array(r.ids, dtype="<u4").tobytes(), r.decoded) for r in bpe.encode(edges, vocabulary, block_bytes=50).collect())
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in bpe.encode(edges, vocabulary, block_bytes=50, as_bytes=True).collect()) == lists


def test_digests_need_no_second_worker(spark):
    plan = queries.op12_bpe(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # the plan's last step stands first
    assert plan.index("FlatMapCoGroupsInArrow") < plan.index("MapInArrow") and plan.count("MapInArrow ") == 3


def test_whole_table(spark, docs, library):
    from hashlib import sha256

    def row(text):
        ids = ids_of(library, text)
        back = library.decode(ids, skip_special_tokens=False)
        return len(ids), sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha256(back.encode()).hexdigest()

    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: row(t) for i, t in texts_of(docs)}


def test_each_word_is_encoded_once(spark, vocabulary, docs):
    named = docs.selectExpr("doc_id AS id", "text").repartition(4)
    words = bpe.dictionaries(named, vocabulary, 10_000, 5_000)
    calls = spark.sparkContext.accumulator(0)

    class Counting(bpe.Vocabulary):
        def encode(self, word):
            calls.add(1)
            return super().encode(word)

    counting = Counting(**{name: getattr(vocabulary, name) for name in ("classes", "byte_ids", "merges", "pieces", "added")})
    rows = bpe.encode_words(words, counting).collect()
    distinct = {d for _, t in texts_of(docs) for d in words_of(vocabulary, t)}
    assert calls.value == len(distinct) < sum(r.n for r in rows)


def words_of(vocabulary, text):
    data, ends = utf8(pa.array([text]))
    bounds = np.append(vocabulary.word_starts(data, ends), len(data))
    return [text.encode()[a:b] for a, b in zip(bounds, bounds[1:])]


def test_places_are_packed():
    for n in (0, 1, 7, 5000):
        found = np.random.default_rng(n).integers(0, 2**31, n).astype("<u4")
        assert (bpe.unpacked(bpe.packed(found), n) == found).all()


def test_other_rows_on_second_reading(spark, vocabulary):
    def shuffled(batches):
        rng = np.random.default_rng()
        for batch in batches:
            yield batch.take(pa.array(rng.permutation(batch.num_rows)))

    docs = spark.range(2000, numPartitions=2).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    twice = docs.mapInArrow(shuffled, "doc_id long, text string")
    with pytest.raises(Exception, match="another order"):
        bpe.encode(twice, vocabulary).count()
