"""Removal of long repeated substrings by refining q-gram buckets, as in suffix sorting.

A byte goes if some string of ``length`` bytes that covers it also starts elsewhere. All
starts of such strings are put into buckets by a q-gram inside the string, and buckets
are refined by what follows at later offsets until each bucket holds equal strings:

1. Of the q-grams in a string, the one with the smallest hash is its anchor. The choice
   depends on the string alone, so equal strings have equal anchors at equal offsets. The
   starts that share an anchor occurrence are a run of neighbours, kept as one row:
   about one row per 75 bytes.
2. Rows are bucketed by the anchor's q-gram, then by everything the whole run of
   starts can see. Rows equal in that have all their starts repeated.
3. What is left alone in its bucket may still share some of its starts with others of the
   same q-gram. One row of each kind is looked at again with its text, and its starts are
   bucketed one by one by their whole strings, a q-gram's rows together.

A q-gram with more than ``group_rows`` kinds of rows is not handled in one group: there each
start becomes a Spark row of its own, counted by its string, with the same result.

Bucket identifiers are 64-bit hashes of contents, two independent ones together.

Defined cases: NULL and empty texts have no bytes. Matches never cross documents. Rows that
repeat are documents of their own, so all their strings are repeated if long enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import keyed
from .hashing import Prefix, mix

_U = np.uint64
SEGMENT = 1 << 20  # starts handled at a time


def text_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def anchors(data: np.ndarray, length: int, q: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(q-gram hash, context hash, anchor, first start, last start) of each run of starts."""
    width = length - q + 1  # q-grams in a string
    for begin in range(0, len(data) - length + 1, SEGMENT):
        part = data[begin : begin + SEGMENT + length - 1]
        n = len(part) - length + 1
        one = Prefix(part, 0)
        grams = one.windows(q)
        place = np.arange(len(grams), dtype=np.uint64)
        low = _U(21)  # more than SEGMENT + length
        keys = (mix(grams) >> low << low) | place
        pad = -len(keys) % width
        table = np.append(keys, np.full(pad, ~_U(0))).reshape(-1, width)
        left = np.minimum.accumulate(table, axis=1).ravel()
        right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(right[:n], left[width - 1 : width - 1 + n]) & ((_U(1) << low) - _U(1))).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:], n) - 1
        anchor = at[first]
        seen = mix(Prefix(part, 1).of(first, last + length) ^ mix((anchor - first).astype(np.uint64)))
        yield grams[anchor].astype(np.int64), seen.astype(np.int64), anchor + begin, first + begin, last + begin


def _rows(docs: DataFrame, length: int, q: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(2)):
                text = text.as_py()
                if len(text) * 4 < length:
                    continue
                for g, c, p, a, b in anchors(text_bytes(text), length, q):
                    owner = np.full(len(g), i)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(g), pa.array(c), batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)),
                            pa.array(a), pa.array((p - a).astype(np.int16)), pa.array((b - a).astype(np.int16)),
                        ],
                        names=["g", "c", "id", "th", "a", "d", "w"],
                    )

    kind = docs.schema["id"].dataType.simpleString()
    # d: from the first start to the anchor; w: from the first start to the last
    return docs.mapInArrow(run, f"g long, c long, id {kind}, th long, a long, d short, w short")


def _context(texts_and_rows: DataFrame, length: int) -> DataFrame:
    """The bytes that each row's starts can see."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("g", "i", "a", "d", "w", "n", "context")}
            for i, (text, rows) in enumerate(zip(batch.column(2), batch.column(3))):
                rows = rows.as_py()
                if not rows:
                    continue
                data = text.as_py().encode("utf-8", "surrogatepass")
                for r in rows:
                    for k in ("g", "a", "d", "w", "n"):
                        out[k].append(r[k])
                    out["i"].append(i)
                    out["context"].append(data[r["a"] : r["a"] + r["w"] + length])
            owner = pa.array(out["i"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["g"], pa.int64()), batch.column(0).take(owner), batch.column(1).take(owner),
                    pa.array(out["a"], pa.int64()), pa.array(out["d"], pa.int16()), pa.array(out["w"], pa.int16()),
                    pa.array(out["n"], pa.int64()), pa.array(out["context"], pa.binary()),
                ],
                names=["g", "id", "th", "a", "d", "w", "n", "context"],
            )

    kind = texts_and_rows.schema["id"].dataType.simpleString()
    return texts_and_rows.mapInArrow(
        run, f"g long, id {kind}, th long, a long, d short, w short, n long, context binary"
    )


def _starts(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two keys per start of each row's run, the row's index and the start's place in the text.

    The keys stand for the string and for where in it the anchor lies.
    """
    context = batch.column(batch.schema.get_field_index("context"))
    ends = np.frombuffer(context.buffers()[1], dtype=np.int32)[context.offset : context.offset + len(context) + 1]
    data = np.frombuffer(context.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    first, counts = ends[:-1] - ends[0], np.diff(ends) - length + 1
    row = np.repeat(np.arange(len(context)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = first[row] + inside
    place = mix((batch["d"].to_numpy()[row] - inside).astype(np.uint64))
    one, two = Prefix(data, 0).windows(length)[at], Prefix(data, 1).windows(length)[at]
    return one, mix(two ^ place), row, batch["a"].to_numpy()[row] + inside


def _compare(rows: DataFrame, length: int, chunk: int = 4096) -> DataFrame:
    """Spans of repeated strings in rows that come sorted by q-gram, some q-grams at a time."""

    def judge(group: pa.RecordBatch) -> pa.RecordBatch:
        one, two, row, at = _starts(group, length)
        pairs = np.stack([one, two], axis=1).view([("one", np.uint64), ("two", np.uint64)]).ravel()
        _, where = np.unique(pairs, return_inverse=True)
        weight = np.bincount(where, weights=group["n"].to_numpy()[row])
        hit = weight[where] > 1
        # neighbours of one row make one span
        begin = hit & np.append(True, ~hit[:-1] | (row[1:] != row[:-1]))
        end = hit & np.append(~hit[1:] | (row[1:] != row[:-1]), True)
        owner = pa.array(row[begin])
        return pa.RecordBatch.from_arrays(
            [group["id"].take(owner), group["th"].take(owner), pa.array(at[begin]), pa.array(at[end] + length)],
            names=["id", "th", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            g = batch["g"].to_numpy()
            change = np.flatnonzero(g[1:] != g[:-1]) + 1
            if held and len(g) and held[-1]["g"][-1].as_py() != g[0]:
                change = np.append(0, change)
            # cut where a q-gram ends, each piece at least as large as a chunk
            done = 0
            size = sum(len(h) for h in held)
            for c in change:
                if size + c - done >= chunk:
                    yield judge(pa.concat_batches([*held, batch.slice(done, c - done)]))
                    held, size, done = [], 0, int(c)
            if done < len(batch):
                held.append(batch.slice(done))
        if held:
            yield judge(pa.concat_batches(held))

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, th long, start long, end long")


def _spread(rows: DataFrame, length: int) -> DataFrame:
    """The same for q-grams with many rows: a row per start, counted by its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            one, two, row, at = _starts(batch, length)
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one.astype(np.int64)), pa.array(two.astype(np.int64)), batch["id"].take(owner),
                    batch["th"].take(owner), pa.array(at), batch["n"].take(owner),
                ],
                names=["one", "two", "id", "th", "start", "n"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    starts = rows.mapInArrow(run, f"one long, two long, id {kind}, th long, start long, n long")
    often = starts.groupBy("one", "two").agg(F.sum("n").alias("weight")).where("weight > 1").drop("weight")
    return starts.join(often, ["one", "two"]).select("id", "th", "start", (F.col("start") + length).alias("end"))


def _with(base: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """The texts with a document's list, or NULL; both uses share one exchange of the texts."""
    side = lists.select(F.col("id").alias("_id"), F.col("th").alias("_th"), name)
    return base.join(side, base["id"].eqNullSafe(side["_id"]) & (base["th"] == side["_th"]), "left").select(
        "id", "th", "text", name
    )


def spans(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 200,
    q: int = 50,
    group_rows: int = 4096,
) -> DataFrame:
    """(id, th, text, spans): every row, with the byte ranges that repeated strings cover.

    Ranges are not sorted and may overlap; NULL if there are none.
    """
    if not 0 < q <= length:
        raise ValueError("a q-gram must fit into the string")
    base = keyed(docs, id_col, text_col)
    same = Window.partitionBy("g", "c")
    gram = Window.partitionBy("g")
    bucketed = (
        _rows(base, length, q)
        .repartition("g")
        .withColumn("k", F.row_number().over(same.orderBy("th", "a")))
        .withColumn("n", F.count(F.lit(1)).over(same))
        .withColumn("kinds", F.count_if(F.col("k") == 1).over(gram))
        .withColumn("lone", F.max(F.col("n") == 1).over(gram))
        .withColumn("probe", F.col("lone") & (F.col("kinds") > 1) & (F.col("k") == 1))
        .where("n > 1 OR probe")
        .select("g", "id", "th", "a", "d", "w", "n", "kinds", "probe")
    )
    rows = materialise(bucketed)
    covered = rows.where("n > 1").select("id", "th", F.col("a").alias("start"), (F.col("a") + F.col("w") + length).alias("end"))

    probes = rows.where("probe")
    few = probes.where(F.col("kinds") <= group_rows)
    many = probes.where(F.col("kinds") > group_rows)

    def seen(some: DataFrame) -> DataFrame:
        lists = some.groupBy("id", "th").agg(F.collect_list(F.struct("g", "a", "d", "w", "n")).alias("probes"))
        return _context(_with(base, lists, "probes"), length)

    covered = covered.union(_compare(seen(few).repartition("g").sortWithinPartitions("g"), length))
    if not many.isEmpty():
        covered = covered.union(_spread(seen(many), length))
    lists = covered.groupBy("id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return _with(base, lists, "spans")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _split(data: bytes, found: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in found for x in r), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def report(docs: DataFrame, **options) -> DataFrame:
    """Sizes and digests per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(2), batch.column(3)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                found = merged([(r["start"], r["end"]) for r in ranges.as_py() or []])
                kept = _split(data, found)
                out.append((len(data), len(data) - len(kept), len(found), hashlib.sha256(kept).hexdigest()))
            n, removed, runs, digest = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, runs)), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    found = spans(docs, **options)
    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, text): each row's text without repeated strings.

    A character cut in the middle goes as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                _split(t.as_py().encode("utf-8", "surrogatepass"), merged([(r["start"], r["end"]) for r in x.as_py() or []])).decode("utf-8", "ignore")
                for t, x in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    found = spans(docs, id_col=id_col, text_col=text_col, **options)
    return found.mapInArrow(run, f"id {found.schema['id'].dataType.simpleString()}, text string")
