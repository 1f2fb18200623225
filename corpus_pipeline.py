"""Cleaning a corpus in five stages, each one an operator of ``gridclim.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as
Parquet and read again as the next stage's ``docs``. The first four return the columns
of their input; the last one the token ids of each document.

Defined cases: every stage keeps clean rows, whatever NULLs, repeated rows or further columns
they have. NULL texts are clean. Rows without identifier are nobody's near duplicate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclim.llm import decontaminate, minhash, secrets, sentencepiece, toxicity
from gridclim.llm.common import read
from gridclim.llm.queries import PIECES
from gridclim.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is more likely than not go."""
    return toxicity.ordinary_only(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest identifier stays."""
    return minhash.one_of_each(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of benchmark words go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def with_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets inside texts are replaced by a mark; the documents stay."""
    found = secrets.redact(docs, secrets.train(secrets.samples(docs)))
    if "n_chars" not in docs.columns:
        return found
    changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as ids of vocabulary pieces, checked by decoding them."""
    return sentencepiece.report(docs, sentencepiece.Vocabulary.read(PIECES))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", contaminated),
    ("secret_scans", with_secrets),
    ("sentencepiece", tokens),
]

# A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
