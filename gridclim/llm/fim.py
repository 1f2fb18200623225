"""Fill-in-middle transformation over content-defined chunks whose counts are remembered.

A rolling hash over the bytes of a text decides where chunks end, so texts that share a
passage share its chunks, wherever they lie. What a chunk holds is worked out once: its
code points, whether a mark lies inside, and the bytes at its two ends, by which a mark
that lies across two chunks is seen. Summaries are remembered by the chunk itself, so two
chunks with equal hashes are still told apart by their content. Summaries in a
row add up to those of the text; their running sums tell which chunk a cut falls into,
and only that chunk is searched for the place.

Where a document is cut, and in which of the three forms it is written, depends on four
numbers drawn from the SHA-256 of its identifier, so a run can be repeated.

Defined cases: NULL and empty texts are plain and have no code points. A text that holds
a mark is plain, since its output could not be told apart. A row without identifier is cut as if that
were the empty text. Rows that repeat are treated alike, each one by itself.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, utf8, whole
from .hashing import VALUES

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
WINDOW = 32  # bytes the rolling hash sees, a power of two
BASE = 0x9E3779B1  # any odd number: the same hash in every task
PLAIN, SPM = 10, 20  # percent of the documents, and of those that are cut
FORMS = ("plain", "psm", "spm")


@dataclass(frozen=True)
class Summary:
    """What a stretch of bytes adds to the text it lies in."""

    points: int
    marked: bool
    head: bytes
    tail: bytes


def summary(chunk: bytes) -> Summary:
    data = np.frombuffer(chunk, dtype=np.uint8)
    marked = b"<" in chunk and any(m in chunk for m in MARKS)
    return Summary(int(np.count_nonzero((data & 0xC0) != 0x80)), marked, chunk[:2], chunk[-2:])


@dataclass
class Cache:
    """Summaries by chunk, the longest unused ones given up beyond ``limit`` bytes of chunks."""

    limit: int = 32 << 20
    held: dict[bytes, Summary] = field(default_factory=dict)
    size: int = 0
    hits: int = 0

    def get(self, chunk: bytes) -> Summary:
        found = self.held.pop(chunk, None)
        if found is None:
            found = summary(chunk)
            self.size += len(chunk)
            while self.size > self.limit and self.held:
                oldest = next(iter(self.held))
                del self.held[oldest]
                self.size -= len(oldest)
        else:
            self.hits += 1
        self.held[chunk] = found
        return found


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte a polynomial hash of the ``WINDOW`` bytes that end there, by doubling the window."""
    found = VALUES[0][data].astype(np.uint32)
    power, width = BASE, 1
    while width < WINDOW:
        found[width:] = found[width:] + np.uint32(power) * found[:-width]
        power, width = power * power % 2**32, 2 * width
    return found


def chunk_ends(data: np.ndarray, offsets: np.ndarray, *, bits: int = 10, least: int = 64, most: int = 1 << 13) -> np.ndarray:
    """Where chunks of texts that lie side by side end.

    A chunk ends where ``bits`` bits of the rolling hash are zero, after ``least`` bytes at
    least and ``most`` at most, and with its text. Windows lie inside one text.
    """
    wanted = (np.flatnonzero((rolling(data) >> np.uint32(32 - bits)) == 0) + 1).tolist()
    ends: list[int] = []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        last = a
        while last < b:
            k = bisect_left(wanted, last + max(least, WINDOW))
            end = min(wanted[k] if k < len(wanted) else b, last + most, b)
            ends.append(end)
            last = end
    return np.array(ends, dtype=np.int64)


def _place(data: np.ndarray, start: int, points: int) -> int:
    """The byte behind ``points`` code points of a chunk, continuation bytes at its start aside."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    return start + (int(lead[points]) if points < len(lead) else len(data))


def draws(key: Column) -> Column:
    """Four whole numbers from the SHA-256 of a key."""
    digest = F.sha2(F.concat(F.lit("1:"), key), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)))


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 4 << 20, remember: int = 32 << 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row; lengths are NULL where plain."""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(remember)
        for batch in pieces_of(batches, 1, batch_bytes):
            data, offsets = utf8(batch.column(1))
            raw = data.tobytes()
            ends = chunk_ends(data, offsets)
            starts = np.append(0, ends[:-1])
            known = [cache.get(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            points = np.array([s.points for s in known], dtype=np.int64)
            before = np.append(0, np.cumsum(points))  # code points of the whole batch before each chunk
            first = np.append(np.searchsorted(starts, offsets[:-1]), len(ends))  # the first chunk of each text
            opens = np.isin(starts, offsets)
            marked = np.array([s.marked for s in known], dtype=bool)
            for k in range(1, len(known)):
                seam = known[k - 1].tail + known[k].head
                if b"<" in seam and not opens[k] and any(m in seam for m in MARKS):
                    marked[k] = True
            n = before[first[1:]] - before[first[:-1]]
            holds = np.append(0, np.cumsum(marked))
            h = batch.column(2).flatten().to_numpy().reshape(-1, 4)
            plain = (n == 0) | (holds[first[1:]] > holds[first[:-1]]) | (h[:, 2] % 100 >= 100 - PLAIN)
            form = np.where(plain, 0, np.where(h[:, 3] % 100 < SPM, 2, 1))
            one, two = np.sort(h[:, :2] % (n + 1)[:, None], axis=1).T
            outputs = []
            for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                if plain[i]:
                    outputs.append(raw[a:b])
                    continue
                at = []
                for p in (one[i], two[i]):
                    target = before[first[i]] + p
                    # the last chunk that starts with that many code points before it or fewer
                    k = min(int(np.searchsorted(before, target, "right")) - 1, int(first[i + 1]) - 1)
                    at.append(_place(data[starts[k] : ends[k]], int(starts[k]), int(target - before[k])))
                prefix, middle, suffix = raw[a : at[0]], raw[at[0] : at[1]], raw[at[1] : b]
                p, s, m = MARKS
                outputs.append(b"".join((p, prefix, s, suffix, m, middle) if form[i] == 1 else (s, suffix, p, prefix, m, middle)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array([FORMS[f] for f in form], pa.string()),
                    pa.array(one, pa.int64(), mask=plain),
                    pa.array(two - one, pa.int64(), mask=plain),
                    pa.array([o.decode() for o in outputs], pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"), draws(key).alias("h")).mapInArrow(
        cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restore(output: Column, form: Column) -> Column:
    """The text that a form was made from."""
    between = lambda a, b: F.substring_index(F.substring_index(output, b, 1), a, -1)
    middle = F.substring_index(output, MIDDLE, -1)
    return (
        F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
        .otherwise(output)
    )


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
