"""Token counts of flat, unindexed token files.

A flat file is documents' token ids one after the other, little-endian numbers of fixed width,
with an end-of-document id behind each document and no index. Files are cut into blocks
of fixed size. Each block is searched for the separator in one vectorised pass, which gives
the lengths of the documents that lie inside it and the pieces at its two ends; a prefix
scan over a file's block summaries stitches the pieces together and numbers the documents.

Defined cases: an empty file has no documents. Two separators in a row enclose a document
of no tokens. Tokens behind the last separator are a document that is not closed. Documents
never reach into the next file. NULL and empty texts are written as documents of no tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import whole

DTYPES = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


def ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its number in each line. Read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def write(
    docs: DataFrame, path: str, vocabulary: dict[bytes, int], pattern: str, eod: int, *,
    text_col: str = "text", width: int = 2, file_bytes: int = 1 << 30, file_rows: int = 1000,
) -> None:
    """Write flat files, documents in the order a task meets them.

    A token is a byte of text at least, so the longest text tells how many documents surely
    stay below ``file_bytes``; then a task starts its next file, but not before ``file_rows``.
    Spark's text writer puts the tokens' raw bytes down as they are, and the bytes of the
    separator as its line end, on any file system.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        for batch in batches:
            ids = [np.array(own.encode_ordinary(t.as_py()), dtype=DTYPES[width]).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["raw"])

    longest = docs.agg(F.max(F.octet_length(whole(text_col)))).first()[0] or 0
    most = max(file_rows, file_bytes // (width * (longest + 1)))
    separator = int(eod).to_bytes(width, "little").decode("latin-1")
    (
        docs.select(whole(text_col))
        .mapInArrow(tokens, "raw binary")
        .select(F.col("raw").cast("string"))
        .write.option("lineSep", separator).option("encoding", "ISO-8859-1").option("compression", "none")
        .option("maxRecordsPerFile", most)
        .text(path)
    )


def _opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path in it."""
    if path.startswith(("file:", "/")):
        return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


def blocks(spark: SparkSession, path: str, *, width: int = 2, block: int = 1 << 20) -> DataFrame:
    """(file, k, raw): the files below ``path`` in blocks of ``block`` tokens.

    Files are only listed; their blocks are dealt out, and each one's bytes are read where it is
    searched, so files may have any size. Where Arrow does not know the file system, a
    file is read by Spark as one value, up to 2 GB.
    """
    size = block * width
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("length") / size) - 1, F.lit(0)))).alias("k")
    try:
        _opened(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return found.select(name, "content", starts).select(
            "file", "k", F.substring("content", F.col("k").cast("int") * size + 1, F.lit(size)).alias("raw")
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (where, k) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                system, inside = _opened(where)
                with system.open_input_file(inside) as file:
                    raw = file.read_at(size, k * size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), pa.array([raw], pa.binary())], names=["file", "k", "raw"]
                )

    return found.select(name, "path", starts).repartition("file", "k").mapInArrow(read, "file string, k long, raw binary")


def count(flat: DataFrame, eod: int, *, width: int = 2) -> DataFrame:
    """(file, doc, n_tokens, closed): one row per document, numbered in its file from 0.

    ``flat`` gives (file, k, raw), a file's blocks numbered from 0, each of whole tokens.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, tail, inside, ends = [], [], [], []
            for raw in batch.column(2):
                ids = np.frombuffer(raw.as_py() or b"", dtype=DTYPES[width])
                at = np.flatnonzero(ids == eod)
                ends.append(len(at))
                head.append(int(at[0]) if len(at) else len(ids))
                tail.append(len(ids) - int(at[-1]) - 1 if len(at) else 0)
                inside.append((np.diff(at) - 1).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (ends, head, tail)), pa.array(inside, pa.list_(pa.int64()))],
                names=["file", "k", "ends", "head", "tail", "inside"],
            )

    kind = flat.schema["file"].dataType.simpleString()
    summary = flat.select("file", "k", "raw").mapInArrow(
        search, f"file {kind}, k long, ends long, head long, tail long, inside array<long>"
    )
    # The scan: documents closed before a block, and tokens open when it starts. A block
    # without separator passes on what was open, so stretches of such blocks are summed.
    order = Window.partitionBy("file").orderBy("k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stretch = Window.partitionBy("file", "closed_before").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    scanned = (
        summary.withColumn("closed_before", F.coalesce(F.count_if(F.col("ends") > 0).over(before), F.lit(0)))
        .withColumn("doc", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .withColumn("last", F.lead("k").over(order).isNull())
        # the block that closed last belongs to the stretch before; its tail opens this one
        .withColumn("left", F.coalesce(F.last(F.when(F.col("ends") > 0, F.col("tail")), ignorenulls=True).over(before), F.lit(0)))
        .withColumn("open", F.col("left") + F.coalesce(F.sum(F.when(F.col("ends") == 0, F.col("head"))).over(stretch), F.lit(0)))
    )
    first = F.when(F.col("ends") > 0, F.array(F.struct((F.col("open") + F.col("head")).alias("n_tokens"), F.lit(True).alias("closed"))))
    rest = F.transform("inside", lambda n: F.struct(n.alias("n_tokens"), F.lit(True).alias("closed")))
    behind = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("head"))
    unclosed = F.when(F.col("last") & (behind > 0), F.array(F.struct(behind.alias("n_tokens"), F.lit(False).alias("closed"))))
    none = F.array().cast("array<struct<n_tokens:bigint,closed:boolean>>")
    found = F.concat(F.coalesce(first, none), F.coalesce(rest, none), F.coalesce(unclosed, none))
    return scanned.select("file", "doc", F.posexplode(found).alias("i", "d")).select(
        "file", (F.col("doc") + F.col("i")).alias("doc"), "d.n_tokens", "d.closed"
    )


def report(docs: DataFrame, path: str, vocabulary: dict[bytes, int], pattern: str, eod: int, **options) -> DataFrame:
    """Write the documents as flat files below ``path`` and count them there.

    Files are named by the number of their task, with 2^32 more for each file before of the
    same task, and documents by their place in them.
    """
    write(docs, path, vocabulary, pattern, eod, **options)
    found = count(blocks(docs.sparkSession, path), eod)
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("bigint")
    file = number("part-([0-9]+)") + F.coalesce(number(r"-c([0-9]+)\."), F.lit(0)) * F.lit(1 << 32)
    return found.select(file.alias("file"), "doc", "n_tokens", "closed")
