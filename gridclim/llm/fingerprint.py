"""Document fingerprints from improbable features.

Every window of 64 bytes has an entropy. How rare an entropy is over all documents ranks the
windows, and in every stretch of 64 neighbouring windows the rarest, the first of equals,
gains a point. Windows of enough points are the document's features. Their hashes go into
a chain of Bloom filters of 2,048 bits with at most 160 features each, and two documents
compare by the bits their filters share beyond what chance explains.

Entropies of neighbouring windows differ by one byte that leaves and one that comes, so
all of them follow from two counts per byte and a running sum, in whole numbers. The
rarities are a histogram over all windows of all documents, of at most ``LEVELS`` bins.

Defined cases: NULL and empty texts, and texts shorter than a window, use the whole text as
their one feature; equal texts have equal fingerprints, two empty ones included. Documents
without a next one (a single row) are their own next. Equal identifiers follow in the order
of their texts; rows without identifier come first.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import whole
from .hashing import Prefix

WINDOW = 64
LEVELS = 1000
FILTER_BYTES = 256
FEATURES_PER_FILTER = 160
POINTS = 16
#: count * log2(count) in whole numbers, and what one more adds
_TERM = np.round(np.append(0.0, np.arange(1, WINDOW + 1) * np.log2(np.arange(1, WINDOW + 1))) * 2**20).astype(np.int64)
_STEP = np.append(0, np.diff(_TERM))
SEGMENT = 1 << 20


def entropies(data: np.ndarray) -> np.ndarray:
    """The entropy of each window as a level from 0 to ``LEVELS`` - 1."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(data, kind="stable").astype(np.int64)
    keys = (data[order].astype(np.int64) << 32) | order
    index = np.arange(n)
    ahead = np.empty(n, dtype=np.int64)  # equal bytes in the window that starts here
    ahead[order] = np.searchsorted(keys, keys + WINDOW) - index
    behind = np.empty(n, dtype=np.int64)  # equal bytes in the window that ends here
    behind[order] = index - np.searchsorted(keys, keys - WINDOW, side="right") + 1
    change = _STEP[behind[WINDOW:]] - _STEP[ahead[: n - WINDOW]]
    first = _TERM[np.bincount(data[:WINDOW], minlength=256)].sum()
    total = np.concatenate(([first], first + np.cumsum(change)))
    # total is WINDOW * 6 bits when all bytes are the same, and 0 when all differ
    return (LEVELS - 1) - total * (LEVELS - 1) // _TERM[WINDOW]


def features(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Starts of the windows that are often the rarest around."""
    levels = entropies(data)
    n = len(levels)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    key = (ranks[levels] << 40) | np.arange(n)
    span = min(WINDOW, n)
    table = np.append(key, np.full(-n % span, np.iinfo(np.int64).max)).reshape(-1, span)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[: n - span + 1], left[span - 1 : n])
    points = np.bincount(least & ((1 << 40) - 1), minlength=n)
    return np.flatnonzero(points >= min(POINTS, n - span + 1))


def digest(data: np.ndarray, ranks: np.ndarray) -> bytes:
    """The chained filters, each behind the number of its features."""
    found = [features(data[i : i + SEGMENT + WINDOW - 1], ranks) + i for i in range(0, max(1, len(data)), SEGMENT)]
    at = np.concatenate(found)
    if len(at):
        hashes = Prefix(data, 0).of(at, at + WINDOW), Prefix(data, 1).of(at, at + WINDOW)
    else:
        own = np.frombuffer(hashlib.blake2b(data.tobytes(), digest_size=16).digest(), dtype=np.uint64)
        hashes = own[:1], own[1:]
    # five places of 11 bits each
    places = np.stack([(hashes[k // 3] >> np.uint64(11 * (k % 3) + 2)) & np.uint64(2047) for k in range(5)], axis=1)
    parts = []
    for i in range(0, len(places), FEATURES_PER_FILTER):
        some = places[i : i + FEATURES_PER_FILTER]
        bits = np.zeros(FILTER_BYTES * 8, dtype=np.uint8)
        bits[some.ravel().astype(np.int64)] = 1
        parts.append(bytes([len(some)]) + np.packbits(bits).tobytes())
    return b"".join(parts)


def _filters(fingerprint: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(fingerprint, dtype=np.uint8).reshape(-1, FILTER_BYTES + 1)
    return rows[:, 0].astype(np.int64), rows[:, 1:]


def likeness(a: bytes, b: bytes) -> float:
    """From 0 to 1: bits shared beyond chance, as a part of what could be shared.

    Each filter of the fingerprint with fewer features counts by its features with its
    best partner.
    """
    if a == b:
        return 1.0
    (na, fa), (nb, fb) = _filters(a), _filters(b)
    if na.sum() > nb.sum():
        (na, fa), (nb, fb) = (nb, fb), (na, fa)
    ones_a, ones_b = np.bitwise_count(fa).sum(axis=1), np.bitwise_count(fb).sum(axis=1)
    total = 0.0
    for k in range(len(fa)):
        common = np.bitwise_count(fa[k] & fb).sum(axis=1)
        least = ones_a[k] * ones_b / (FILTER_BYTES * 8)  # by chance
        most = np.minimum(ones_a[k], ones_b)
        total += na[k] * np.where(most > least, (common - least) / np.maximum(most - least, 1e-9), 0.0).max()
    return float(min(1.0, max(0.0, total / na.sum())))


def ranks(docs: DataFrame, *, text_col: str = "text") -> np.ndarray:
    """Entropy levels from the rarest, 0, to the most frequent, over all windows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(LEVELS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                data = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), dtype=np.uint8)
                for i in range(0, len(data), SEGMENT):
                    sums += np.bincount(entropies(data[i : i + SEGMENT + WINDOW - 1]), minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(sums)], names=["level", "n"])

    rows = docs.select(whole(text_col)).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(LEVELS, dtype=np.int64)
    for r in rows:
        total[r["level"]] = r["n"]
    # A level nobody has seen is no rarer than one seen once; equals by level.
    place = np.empty(LEVELS, dtype=np.int64)
    place[np.lexsort((np.arange(LEVELS), np.maximum(total, 1)))] = np.arange(LEVELS)
    return place


def _text(fingerprint: bytes) -> str:
    return base64.b64encode(fingerprint).decode()


def fingerprints(docs: DataFrame, rarity: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_text(digest(np.frombuffer(t.as_py().encode("utf-8", "surrogatepass"), dtype=np.uint8), shared.value)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).mapInArrow(run, f"id {kind}, fingerprint string")


def similar(fingerprint: str, other: str) -> float:
    """:func:`likeness` of two fingerprints as stored."""
    return likeness(base64.b64decode(fingerprint), base64.b64decode(other))




def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the start of the following one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def with_next(docs: DataFrame, rarity: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document.

    Texts are dealt out by ranges of identifiers once. A task meets its rows in order and so
    has each row's next one, except for its last; the tasks' first and last rows, two per task,
    are matched in a join.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(rarity)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(one: tuple, two: tuple) -> tuple:
        """Both as (id, text, digest)."""
        text = edited(one[1], two[1])
        raw = text.encode("utf-8", "surrogatepass")
        own = digest(np.frombuffer(raw, dtype=np.uint8), shared.value)
        return (
            one[0], len(one[1]), hashlib.sha256(raw).hexdigest(), _text(one[2]), _text(own),
            likeness(one[2], own), likeness(one[2], two[2]),
        )

    def own(text: str) -> bytes:
        return digest(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), shared.value)

    def table(rows: list[tuple], ends: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        filled = [r + (None, None) for r in rows] + [(e[2], *[None] * 6, e[0], e[1]) for e in ends]
        columns = list(zip(*filled)) if filled else [[]] * 9
        types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=[*names, "first", "text"]
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, id_type = None, pa.int64()
        for batch in batches:
            rows, ends = [], []
            id_type = batch.column(0).type
            for i, text in zip(batch.column(0), batch.column(1)):
                now = (i.as_py(), text.as_py(), own(text.as_py()))
                if before is None:
                    ends.append((True, now[1], now[0]))
                else:
                    rows.append(compare(before, now))
                before = now
            yield table(rows, ends, id_type)
        if before is not None:
            yield table([], [(False, before[1], before[0])], id_type)

    ordered = (
        docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", "text")
    )
    out = "id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, first boolean, text string".format(kind=kind)
    walked = materialise(ordered.mapInArrow(walk, out).withColumn("part", F.spark_partition_id()))
    ends = walked.where("first IS NOT NULL").select("part", "first", "id", "text")
    # One row per task with rows: the next task in order, the first one behind the last.
    parts = ends.where("first").select("part")
    order = Window.orderBy("part")
    follow = parts.select(
        "part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("follow")
    )
    heads = ends.where("first").select(F.col("part").alias("follow"), F.col("text").alias("next_text"))
    lasts = ends.where("NOT first").join(follow, "part").join(heads, "follow").select("id", "text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                compare((i.as_py(), a.as_py(), own(a.as_py())), (None, b.as_py(), own(b.as_py())))
                for i, a, b in zip(*batch.columns)
            ]
            yield table(rows, [], batch.column(0).type)

    inner = walked.where("first IS NULL").select(*names)
    return inner.union(lasts.mapInArrow(finish, out).select(*names))


def report(docs: DataFrame) -> DataFrame:
    return with_next(docs, ranks(docs)).withColumnRenamed("id", "doc_id")
