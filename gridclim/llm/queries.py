"""One query per operator, each over its whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir
from . import bpe, decontaminate, fim, fingerprint, language, lexical, licenses, minhash, repeats, secrets, sentencepiece, sql, token_counts, toxicity
from .common import read

# Vocabulary files of public tokenizers, on the driver only.
# Fixed values of the rank file: its splitting pattern and a number it leaves free.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_DOCUMENT = 50256
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_PAIRS = "/opt/tokenizers/byte_bpe_50k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(read(spark, sf_dir, "documents"), words=2)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(read(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(read(spark, sf_dir, "documents"), licenses.built_in(spark))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepiece.Vocabulary.read(PIECES)
    return sentencepiece.report(read(spark, sf_dir, "documents"), vocabulary)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(read(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = token_counts.ranks(RANKS)
    return token_counts.report(read(spark, sf_dir, "documents"), scratch_dir(spark), ranks, SPLIT, END_OF_DOCUMENT)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(read(spark, sf_dir, "documents"), bpe.Vocabulary.read(BYTE_PAIRS))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_minhash,
        op3_fingerprints,
        op4_secrets,
        op5_licenses,
        op6_sentencepiece,
        op7_toxicity,
        op8_repeats,
        op9_language,
        op10_token_counts,
        op11_lexical_search,
        op12_bpe,
        op13_fill_in_middle,
    )
}

SQL: dict[str, str] = {
    "op1_decontamination": sql.DECONTAMINATION,
    "op2_minhash": sql.NEAR_DUPLICATES,
    "op5_licenses": sql.LICENSES,
    "op11_lexical_search": sql.LEXICAL_SEARCH,
    "op13_fill_in_middle": sql.FILL_IN_MIDDLE,
}
