"""Byte-level BPE: encoding through a table of distinct words, decoding through a table of pieces.

Texts are split into words, block by block; a block of documents keeps the places of its
words in the block's own dictionary. The dictionaries of all blocks meet in one table, dealt by
word, in which each distinct word is encoded once, whatever number of documents holds
it. The ids go back to the blocks, where they are put together by the words' places, and
joined to the table of pieces. Only dictionaries are compared across the corpus, and a
frequent word is there once per block.

Splitting follows the tokenizer's own rules: white space goes in front of the next word if it is
one blank, runs of letters, of numbers and of other characters are words, and ``'s 't
're 've 'm 'll 'd`` are. Which characters are letters, numbers or spaces is asked of the
tokenizers library once, so no other Unicode version can interfere.

Defined cases: NULL and empty texts have no ids and decode to the empty text. A text that
holds an added token's own spelling has that token there. Rows that repeat are
encoded as often as they come; an identifier may be NULL. Ids beyond the vocabulary decode to nothing, and bytes that
are no UTF-8 to U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import small_table
from .common import pieces_of, share, utf8, whole

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
SURROGATES = range(0xD800, 0xE000)


def alphabet() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary: printable ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _classes(tokenizer: Tokenizer) -> np.ndarray:
    """OTHER, LETTER, NUMBER, SPACE or BLANK for each code point, as the tokenizer splits.

    All code points in a row are split into runs of one kind. What a run's last character
    is shows which of a letter, a number or a sign before it is not cut off.
    """
    points = np.array([p for p in range(0x110000) if p not in SURROGATES])
    cut = tokenizer.pre_tokenizer.pre_tokenize_str
    found = np.full(0x110000, SPACE, dtype=np.uint8)
    for _, (first, stop) in cut("".join(map(chr, points))):
        run = points[first:stop]
        for probe, kind in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(cut(probe + chr(run[-1]))) == 1:
                found[run] = kind
    found[ord(" ")] = BLANK
    return found


@dataclass(frozen=True)
class Vocabulary:
    """What a tokenizer file says, packed for tasks."""

    classes: np.ndarray
    byte_ids: list[int]
    merges: dict[int, int]  # left id << 20 | right id -> rank << 20 | id of both
    pieces: dict[int, bytes]
    added: dict[bytes, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Read a tokenizer file on the driver. Its kind must be byte-level BPE without a normaliser."""
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, before = held["model"], held["pre_tokenizer"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [k for k in ("single_word", "lstrip", "rstrip") for t in held["added_tokens"] if t[k]]
        if held["normalizer"] or model["type"] != "BPE" or odd or any(before.get(k) != v for k, v in plain.items()):
            raise ValueError(f"{path} is no plain byte-level BPE file {odd}")
        ids, letters = model["vocab"], alphabet()
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            merges.setdefault(ids[a] << 20 | ids[b], rank << 20 | ids[a + b])
        pieces = {i: bytes(letters[c] for c in p) for p, i in ids.items()}
        added = {t["content"].encode(): t["id"] for t in held["added_tokens"]}
        pieces |= {i: t for t, i in added.items()}
        byte_ids = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        return cls(_classes(Tokenizer.from_file(path)), byte_ids, merges, pieces, added)

    @cached_property
    def added_pattern(self) -> re.Pattern[bytes] | None:
        longest_first = sorted(self.added, key=len, reverse=True)
        return re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None

    def word_starts(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Byte positions at which words start in texts that lie side by side and meet at ``ends``."""
        if not len(data):
            return np.zeros(0, dtype=np.int64)
        raw = data.tobytes()
        at = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        n = len(points)
        edge = np.zeros(n + 1, dtype=bool)
        edge[np.searchsorted(at, ends)] = True
        # Added tokens lie inside one text and part it as its ends do.
        tokens = np.searchsorted(at, self._added(raw, ends))
        edge[tokens] = True
        kind = self.classes[points]
        run = np.minimum(kind, SPACE)
        start = edge[:-1].copy()
        start[1:] |= run[1:] != run[:-1]
        # The last space before a word is a word by itself, or part of that word if it is a blank.
        first = np.flatnonzero(start & (run != SPACE))
        first = first[first > 0]
        first = first[~edge[first] & (run[first - 1] == SPACE)]
        start[first - 1] = True
        start[first[kind[first - 1] == BLANK]] = False
        # An apostrophe that starts a word takes some endings with it.
        mark = np.flatnonzero(start & (points == ord("'")))
        mark = mark[mark + 1 < n]
        mark = mark[~edge[mark + 1]]
        one, two = points[mark + 1], np.where(edge[np.minimum(mark + 2, n)], 0, points[np.minimum(mark + 2, n - 1)])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.isin(one.astype(np.uint64) << np.uint64(32) | two, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])
        for chosen, length in ((mark[short], 2), (mark[long], 3)):
            start[chosen + 1] = False
            after = chosen + length
            start[after[after < n]] = True
        for a, b in tokens:
            start[a + 1 : b] = False
        return at[start]

    def _added(self, raw: bytes, ends: np.ndarray) -> np.ndarray:
        """Where added tokens start and end, as rows of two."""
        found: list[tuple[int, int]] = []
        if self.added_pattern is not None and self.added_pattern.search(raw):
            found = [m.span() for a, b in zip(ends, ends[1:]) for m in self.added_pattern.finditer(raw, int(a), int(b))]
        return np.array(found, dtype=np.int64).reshape(-1, 2)

    def encode(self, word: bytes) -> list[int]:
        """The ids of one word: the pair of least rank is merged first, the leftmost of several."""
        if word in self.added:
            return [self.added[word]]
        merges = self.merges
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m >> 20, i) for i in range(n - 1) if (m := merges.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            found = merges.get(ids[i] << 20 | ids[j])
            if found is None or found >> 20 != rank:
                continue
            ids[i], ids[j] = found & 0xFFFFF, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := merges.get(ids[i] << 20 | ids[k])) is not None:
                    heapq.heappush(heap, (m >> 20, i))
            k = before[i]
            if k >= 0 and (m := merges.get(ids[k] << 20 | ids[i])) is not None:
                heapq.heappush(heap, (m >> 20, k))
        return [i for i in ids if i >= 0]


class Block:
    """Documents that share a dictionary of words, the most frequent word first."""

    def __init__(self) -> None:
        self.size = 0
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.words: list[pa.DictionaryArray] = []

    def add(self, ids: pa.Array, texts: pa.Array, vocabulary: Vocabulary) -> None:
        data, ends = utf8(texts)
        starts = vocabulary.word_starts(data, ends)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(data)])
        self.size += len(data)
        self.ids.append(ids)
        self.lengths.append(np.diff(np.searchsorted(starts, ends)))
        self.words.append(words.dictionary_encode())

    def placed(self) -> tuple[pa.Array, list[np.ndarray]]:
        """The dictionary, and each part's words as places in it."""
        parts = pa.chunked_array(self.words).unify_dictionaries().chunks
        found = [part.indices.to_numpy(zero_copy_only=False) for part in parts]
        words = parts[0].dictionary
        often = np.argsort(-np.bincount(np.concatenate(found), minlength=len(words)), kind="stable")
        place = np.empty(len(words), dtype="<u4")
        place[often] = np.arange(len(words))
        return words.take(pa.array(often)), [place[part] for part in found]


def blocks(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, block_bytes: int, part_bytes: int) -> Iterator[tuple[int, Block, pa.Array, list[np.ndarray]]]:
    """Documents of a task in blocks of about ``block_bytes`` of text, each under a key.

    The key names the task and the contents, so one that is worked out again gets the same key
    only if it holds the same documents in the same order.
    """
    block, made = Block(), 0

    def closed() -> tuple[int, Block, pa.Array, list[np.ndarray]]:
        words, places = block.placed()
        key = hashlib.blake2b(f"{TaskContext.get().partitionId()} {made}".encode(), digest_size=8)
        for some in (*words.buffers()[1:], *places):
            if some is not None:
                key.update(some)
        return int.from_bytes(key.digest(), "little", signed=True), block, words, places

    for batch in pieces_of(batches, 1, part_bytes):
        block.add(batch.column(0), batch.column(1), vocabulary)
        if block.size >= block_bytes:
            yield closed()
            block, made = Block(), made + 1
    if block.ids:
        yield closed()


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers byte by byte, high bytes apart from low ones, compressed."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    plain = pa.decompress(raw, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, dtype=np.uint8).reshape(4, n).T).view("<u4").ravel()


def dictionaries(docs: DataFrame, vocabulary: Vocabulary, block_bytes: int, part_bytes: int) -> DataFrame:
    """(bucket, block, n, at, size, lengths, words): each block's distinct words, those of a bucket in a row.

    Words are dealt by a hash into as many buckets as the session's exchanges have
    partitions. A row holds ``n`` words side by side, their lengths, and the steps between their places.
    """
    shared = share(docs.sparkSession, vocabulary)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, words, _ in blocks(batches, shared(), block_bytes, part_bytes):
            bucket = np.array([zlib.crc32(w) % buckets for w in words.to_pylist()], dtype=np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k, (a, b) in enumerate(zip(ends, ends[1:])):
                if a < b:
                    some = words.take(pa.array(order[a:b]))
                    joined = some.buffers()[2].to_pybytes()
                    lengths = np.diff(np.frombuffer(some.buffers()[1], dtype=np.int32)[: b - a + 1])
                    row = {
                        "bucket": k, "block": key, "n": int(b - a), "at": packed(np.diff(order[a:b], prepend=0)), "size": int(lengths.sum()),
                        "lengths": packed(lengths), "words": pa.compress(joined[: lengths.sum()], codec="zstd", asbytes=True),
                    }
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("at", pa.binary()), ("size", pa.int32()), ("lengths", pa.binary()), ("words", pa.binary())]
    )
    return docs.mapInArrow(cut, "bucket int, block long, n int, at binary, size int, lengths binary, words binary")


def places(docs: DataFrame, vocabulary: Vocabulary, block_bytes: int, part_bytes: int) -> DataFrame:
    """(block, ids, lengths, places): documents as places of words, many in a row."""
    shared = share(docs.sparkSession, vocabulary)
    kind = docs.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block, _, found in blocks(batches, shared(), block_bytes, part_bytes):
            for ids, lengths, part in zip(block.ids, block.lengths, found):
                columns = [
                    pa.array([key], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([packed(part)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "lengths", "places"])

    return docs.mapInArrow(cut, f"block long, ids array<{kind}>, lengths array<int>, places binary")


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(of, n, at, n_ids, counts, ids): the dictionaries' words as ids, each distinct word encoded once.

    All rows of a bucket meet in one task, one for each block, and so do all occurrences of
    a word; the task holds the bucket's distinct words while it passes.
    """
    shared = share(words.sparkSession, vocabulary)
    schema = pa.schema([("of", pa.int64()), ("n", pa.int32()), ("at", pa.binary()), ("n_ids", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        bucket, known = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                ends = np.cumsum(unpacked(row["lengths"], row["n"]))
                joined = pa.decompress(row["words"], decompressed_size=row["size"], codec="zstd", asbytes=True)
                found = []
                for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
                    word = joined[a:b]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = own.encode(word)
                    found.append(ids)
                counts, ids = np.array([len(i) for i in found]), np.array(list(chain.from_iterable(found)))
                coded = {"of": row["block"], "n": row["n"], "at": row["at"], "n_ids": len(ids), "counts": packed(counts), "ids": packed(ids)}
                yield pa.RecordBatch.from_pylist([coded], schema=schema)

    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(code, "of long, n int, at binary, n_ids int, counts binary, ids binary")


def _dictionary(rows: pa.Table) -> pa.ListArray:
    """The ids of a block's words, by their places, from the rows of all buckets."""
    held = rows.to_pylist()
    at = [np.cumsum(unpacked(r["at"], r["n"])) for r in held]
    counts = [unpacked(r["counts"], r["n"]) for r in held]
    ids = [unpacked(r["ids"], r["n_ids"]) for r in held]
    if not held:
        return pa.array([], pa.list_(pa.int32()))
    ends = np.append(0, np.cumsum(np.concatenate(counts)))
    found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
    return found.take(pa.array(np.argsort(np.concatenate(at))))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 16 << 20,
    part_bytes: int = 1 << 20,
    as_bytes: bool = False,
) -> DataFrame:
    """(doc_id, ids, decoded): each row's ids, and the text that they decode to.

    With ``as_bytes`` ids are one binary value, four bytes for each, little-endian.

    ``docs`` is read twice, once for the dictionaries and once for the places of words, and must
    give the same rows in the same order, as a table of files does. Other input should
    be written first; a block that comes out differently ends the job with an error.
    """
    named = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    coded = encode_words(dictionaries(named, vocabulary, block_bytes, part_bytes), vocabulary)
    held = places(named, vocabulary, block_bytes, part_bytes)
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = [vocabulary.pieces.get(i, b"") for i in range(max(vocabulary.pieces) + 1)]
    shared = share(docs.sparkSession, pa.array(pieces, pa.binary()))

    def put_together(rows: pa.Table, words: pa.Table) -> pa.Table:
        piece = shared()
        ids = _dictionary(words)
        lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
        found = []
        for names, n, raw in zip(rows["ids"], rows["lengths"], rows["places"].to_pylist()):
            n = n.values.to_numpy()
            at = unpacked(raw, int(n.sum()))
            if len(at) and at.max() >= len(ids):
                raise RuntimeError("documents came in another order when they were read again")
            ends = np.append(0, np.cumsum(n))
            tokens = ids.take(pa.array(at)).flatten()
            token_ends = np.append(0, np.cumsum(lengths[at]))[ends]
            texts = piece.take(tokens)
            raw = texts.buffers()[2].to_pybytes() if len(texts) else b""
            text_ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[token_ends] if len(texts) else token_ends
            decoded = [raw[a:b].decode("utf-8", "replace") for a, b in zip(text_ends, text_ends[1:])]
            if as_bytes:
                raw = pa.py_buffer(tokens.to_numpy(zero_copy_only=False).astype("<i4"))
                lists = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((4 * token_ends).astype(np.int32)), raw])
            else:
                lists = pa.ListArray.from_arrays(pa.array(token_ends, pa.int32()), tokens)
            found.append(pa.table([names.values, lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]))
        if not found:
            raise RuntimeError("documents came in another order when they were read again")
        return pa.concat_tables(found)

    listed = "binary" if as_bytes else "array<int>"
    return held.groupBy("block").cogroup(coded.groupBy("of")).applyInArrow(put_together, f"doc_id {kind}, ids {listed}, decoded string")


def piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """(id, piece): what each id stands for; as large as the vocabulary file, so it is broadcast."""
    return small_table(spark, sorted(vocabulary.pieces.items()), "id int, piece binary")


def decode(tokens: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of any lists of ids, joined to the table of pieces by id."""
    named = tokens.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(ids_col).alias("ids"))
    found = named.select("doc_id", "row", F.posexplode_outer("ids").alias("pos", "id")).join(
        F.broadcast(piece_table(tokens.sparkSession, vocabulary)), "id", "left"
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.hex("piece").alias("piece"))))
    raw = F.unhex(F.array_join(F.transform(ordered, lambda p: p["piece"]), ""))
    return found.groupBy("row", "doc_id").agg(F.make_valid_utf8(raw.cast("string")).alias("text")).select("doc_id", "text")


def report(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256); ids as little-endian numbers of four bytes.

    The digests are column expressions, so a task needs no second Python worker beside the one that encodes.
    """
    coded = encode(docs, vocabulary, as_bytes=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
