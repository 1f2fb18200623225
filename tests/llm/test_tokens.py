"""SentencePiece pieces and token counts."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as library
import tiktoken
from gridclim.llm import queries, sentencepiece, token_counts
from gridclim.session import scratch_dir
from sentencepiece import sentencepiece_model_pb2

from .conftest import texts_of

TEXTS = [
    "", "a", " ", "  a  b ", "x▁y▁", "日本語テキスト処理 は難しい 🎉🎉", "\n\t a\x00b", "ééé" * 30, "a" * 200 + " bb",
    " ".join(f"the{i % 7} word{i % 5}ing" for i in range(120)),
]


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.Vocabulary.read(queries.PIECES)


def score(vocabulary, ids):
    names = vocabulary.names()
    return sum(vocabulary.pieces[names[i]][0] if isinstance(names[i], str) else 0 for i in ids)


def test_round_trip(vocabulary):
    for t in TEXTS:
        assert vocabulary.decode(vocabulary.encode(t), vocabulary.names()) == t


def test_scores_as_the_library_as_a_unigram_model(vocabulary):
    model = sentencepiece_model_pb2.ModelProto()
    with open(queries.PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    names = vocabulary.names()
    for i, piece in enumerate(model.pieces):
        if isinstance(names[i], str) and names[i]:
            piece.score = vocabulary.pieces[names[i]][0]
    other = library.SentencePieceProcessor(model_proto=model.SerializeToString())
    for t in "the another word of longer thing internationalisation tokens Straße élève naïve running".split():
        assert score(vocabulary, vocabulary.encode(t)) == pytest.approx(score(vocabulary, other.encode(t)), abs=1e-3)


def test_common_words_are_single_pieces(vocabulary):
    own = library.SentencePieceProcessor(model_file=queries.PIECES)
    words = "the and another word of longer thing tokens running table history number water small after".split()
    same = [vocabulary.encode(w) == own.encode(w) for w in words]
    assert sum(same) >= 14


def test_a_column_is_encoded_as_its_texts(vocabulary):
    rng = random.Random(7)
    starts = [p for p in vocabulary.pieces if len(p) > 1]
    made = ["".join(rng.choice(starts)[: rng.randint(1, 9)] for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts = [*TEXTS, *made, "", "\n", "x" * 64, "x" * 65, "é▁🎉" * 9]
    for some in (texts, texts[::-1], [], [""], ["", ""], ["", "a", ""]):
        fresh = sentencepiece.Vocabulary.read(queries.PIECES)
        want = [vocabulary.encode(x) for x in some]
        assert fresh.encode_all(pa.array(some, pa.string())).to_pylist() == want
        assert fresh.encode_all(pa.array(["cut off", *some], pa.string())[1:]).to_pylist() == want


def test_words_go_side_by_side(vocabulary):
    alone = []

    class Counting(sentencepiece.Vocabulary):
        def _word(self, s):
            alone.append(s)
            return super()._word(s)

    counting = Counting(vocabulary.pieces, vocabulary.byte_ids, vocabulary.unknown, vocabulary.size, vocabulary.longest)
    texts = ["some words of a text", "other words\n🎉", "y" * 80] * 3
    found = counting.encode_all(pa.array(texts)).to_pylist()
    assert found == [vocabulary.encode(t) for t in texts]
    assert not any(w.strip().isascii() and w.strip().isalpha() and len(w) <= 64 for w in alone)
    words = ["some", " words", "y" * 64, "▁", "🎉x", "é"]
    assert [np.frombuffer(ids, dtype=np.int32).tolist() for ids in counting.words(words)] == [vocabulary._word(w)[1] for w in words]


def test_decode_of_any_ids(spark, vocabulary):
    names = vocabulary.names()
    byte = {n: i for i, n in enumerate(names) if isinstance(n, int)}
    plain = vocabulary.encode("a text")
    lists = [plain, [byte[b] for b in "é🎉".encode()], [-1, *plain, 10**6], [vocabulary.pieces[" "][1]] * 2, [byte[32], byte[10]], [], None]
    df = spark.createDataFrame(list(enumerate(lists)), "id long, ids array<int>")
    got = {r.id: r.decoded for r in sentencepiece.decode(df, vocabulary).collect()}
    assert got == {i: vocabulary.decode(x or [], names) for i, x in enumerate(lists)}


@pytest.mark.parametrize("chunk", [33, 50, 333])
def test_chunks_find_a_path_as_good(vocabulary, chunk):
    for t in TEXTS[1:]:
        s = " " + t
        parts = [
            (s[a : a + chunk + vocabulary.longest - 1], min(chunk, len(s) - a), s[a - 1 : a] if a else "")
            for a in range(0, len(s), chunk)
        ]
        states = sentencepiece.scan([vocabulary.transfer(*p) for p in parts])
        ids = [x for p, a, b in zip(parts, states, states[1:]) for x in vocabulary.trace(*p, a, b)]
        assert vocabulary.decode(ids, vocabulary.names()) == t
        assert score(vocabulary, ids) == pytest.approx(score(vocabulary, vocabulary.encode(t)))


@pytest.mark.parametrize("chunk", [100, 1 << 16])
def test_spark(vocabulary, edges, nothing, chunk):
    got = sentencepiece.report(edges, vocabulary, chunk=chunk)
    assert got.count() == edges.count() and got.where("NOT round_trip").count() == 0
    points = lambda i, ids: (i, round(score(vocabulary, ids), 6))
    want = Counter(points(i, vocabulary.encode(t)) for i, t in texts_of(edges))
    assert Counter(points(r.doc_id, r.ids) for r in got.collect()) == want
    assert sentencepiece.report(nothing, vocabulary, chunk=chunk).count() == 0


def test_decoding_needs_no_second_worker(spark, vocabulary, edges):
    plan = sentencepiece.report(edges, vocabulary)._jdf.queryExecution().optimizedPlan().toString()
    # steps above the union would follow the one that encodes, in the same task
    above, below = plan.split("Union")
    assert "MapInArrow" not in above and below.count("MapInArrow") == 4
    both = sentencepiece.encode(edges, vocabulary, chunk=100, decoded="back")
    row = lambda r, text: (r.id, r.th, tuple(r.ids), text)
    want = Counter(row(r, r.back) for r in sentencepiece.decode(both.drop("back"), vocabulary, text_col="back").collect())
    assert Counter(row(r, r.back) for r in both.collect()) == want


def test_whole_table(spark, docs, vocabulary):
    got = queries.op6_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    want = {i: vocabulary.encode(t) for i, t in texts_of(docs)}
    assert {r.doc_id: r.ids for r in got} == want and all(r.round_trip for r in got)


@pytest.fixture(scope="module")
def own():
    ranks = token_counts.ranks(queries.RANKS)
    return tiktoken.Encoding("own", pat_str=queries.SPLIT, mergeable_ranks=ranks, special_tokens={})


def test_counts_of_whole_table(spark, docs, own):
    got = queries.op10_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert Counter(r.n_tokens for r in got) == Counter(len(own.encode_ordinary(t)) for _, t in texts_of(docs))
    assert all(r.closed for r in got) and len({(r.file, r.doc) for r in got}) == len(got)


@pytest.mark.parametrize("block", [3, 64, 1 << 20])
def test_count_edges(spark, edges, nothing, own, block):
    ranks = token_counts.ranks(queries.RANKS)
    path = scratch_dir(spark)
    token_counts.write(edges, path, ranks, queries.SPLIT, queries.END_OF_DOCUMENT)
    got = token_counts.count(token_counts.blocks(spark, path, block=block), queries.END_OF_DOCUMENT).collect()
    assert Counter(r.n_tokens for r in got) == Counter(len(own.encode_ordinary(t)) for _, t in texts_of(edges))
    path = scratch_dir(spark)
    token_counts.write(nothing, path, ranks, queries.SPLIT, queries.END_OF_DOCUMENT)
    assert token_counts.count(token_counts.blocks(spark, path, block=block), queries.END_OF_DOCUMENT).count() == 0


def test_stitching(spark):
    import struct

    ids = [7, 7, 1, 1, 7, 7, 7, 7, 7, 7, 7, 1, 7, 7]  # 1 ends a document
    raw = struct.pack(f"<{len(ids)}H", *ids)
    for size in (1, 2, 3, 5, 100):
        blocks = [("f", k, raw[k * size * 2 : (k + 1) * size * 2]) for k in range((len(ids) + size - 1) // size)]
        df = spark.createDataFrame([*blocks, ("e", 0, b""), ("n", 0, None)], "file string, k long, raw binary")
        got = sorted((r.doc, r.n_tokens, r.closed) for r in token_counts.count(df, 1).collect())
        assert got == [(0, 2, True), (1, 0, True), (2, 7, True), (3, 2, False)]


def test_a_file_is_read_by_ranges_and_writers_start_new_ones(spark, own, tmp_path):
    ranks = token_counts.ranks(queries.RANKS)
    # larger than one value may be: no documents, but one token at its end
    with open(tmp_path / "part-00000-big.txt", "wb") as file:
        file.truncate((1 << 31) + 2)
        file.seek(1 << 31)
        file.write(queries.END_OF_DOCUMENT.to_bytes(2, "little"))
    got = token_counts.count(token_counts.blocks(spark, str(tmp_path)), queries.END_OF_DOCUMENT).collect()
    assert [(r.doc, r.n_tokens, r.closed) for r in got] == [(0, 1 << 30, True)]
    docs = spark.range(40).selectExpr("concat('text number ', id) AS text").coalesce(1)
    path = scratch_dir(spark)
    token_counts.write(docs, path, ranks, queries.SPLIT, queries.END_OF_DOCUMENT, file_bytes=400, file_rows=1)
    sizes = [r.length for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("length").collect()]
    assert len(sizes) > 1 and max(sizes) <= 400
    got = token_counts.count(token_counts.blocks(spark, path), queries.END_OF_DOCUMENT).collect()
    assert Counter(r.n_tokens for r in got) == Counter(len(own.encode_ordinary(f"text number {i}")) for i in range(40))
