"""Pieces that several text operators share."""

from __future__ import annotations

import pickle
import string
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text; a NULL text counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else.

    ``lower`` would also change letters beyond ASCII, so it serves texts without
    such letters only; a letter map over the rest.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text): the identifier, a hash of the text, and the text, never NULL.

    Rows are told apart by (id, th), so rows that repeat an identifier with another
    text stay apart, and full repetitions are equal in every respect.
    """
    text = whole(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast an object of this package; the result gives it back, once per task.

    Packed with its class, so workers need no copy of the package.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column without NULLs, and where each one starts; one place more than texts."""
    texts = texts.cast(pa.string()) if texts.type != pa.string() else texts
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces_of(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            yield batch.slice(first, stop - first)
            first = stop
