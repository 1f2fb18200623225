"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every learning row is counted: each task sums its n-grams into one vector per language,
Spark adds the vectors up, and the resulting matrix of log probabilities (languages times
``2 ** bits``, whatever the size of the corpus) is broadcast. Scoring turns a text into
its n-gram counts and multiplies.

Defined cases: a NULL text or one without letters (``½`` and ``²`` are none) is ``und`` with score 0; so is every
text if nothing could be learned. Languages with equal scores go by name. Rows without
an identifier are scored but not learned from. Repeated rows count as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import share

UNKNOWN = "und"
# Odd multipliers of the rolling hash, one per place in an n-gram.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
# A start value per n-gram length, so that lengths do not share buckets by construction.
STARTS = np.array([0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], dtype=np.uint64)


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the identifier as text, modulo ``divisor``; NULL without identifier."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def gram_counts(text: str, bits: int, longest: int = 3) -> np.ndarray:
    """Counts of the text's 1- to ``longest``-grams in ``2 ** bits`` buckets."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    shift = np.uint64(64 - bits)
    counts = np.zeros(1 << bits, dtype=np.int64)
    for n in range(1, min(longest, len(points)) + 1):
        h = np.full(len(points) - n + 1, STARTS[n - 1])
        for k in range(n):
            h += points[k : len(points) - n + 1 + k] * PLACES[k]
        h ^= h >> np.uint64(29)
        h *= PLACES[0]
        counts += np.bincount((h >> shift).astype(np.int64), minlength=1 << bits)
    return counts


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x buckets, log probabilities
    priors: np.ndarray
    bits: int

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        counts = gram_counts(text, self.bits)
        total = self.priors + self.weights @ counts
        # Neighbouring n-grams overlap, so a plain posterior is far too sure of itself.
        scaled = (total - total.max()) / np.sqrt(counts.sum())
        share = np.exp(scaled)
        best = int(np.argmax(total))
        return self.languages[best], float(share[best] / share.sum())


def train(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", bits: int = 14, smoothing: float = 0.5
) -> Model:
    """Learn from every row with a text and a language.

    The driver receives at most languages times ``2 ** bits`` sums.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                if lang not in sums:
                    sums[lang], rows[lang] = np.zeros(1 << bits, dtype=np.int64), 0
                sums[lang] += gram_counts(text.as_py(), bits)
                rows[lang] += 1
        for lang, v in sums.items():
            used = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(used) + 1), pa.string()),
                    pa.array(np.append(used, -1), pa.int64()),
                    pa.array(np.append(v[used], rows[lang]), pa.int64()),
                ],
                names=["lang", "bucket", "n"],
            )

    summed = (
        docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).cast("string"), F.col(text_col))
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = np.array(summed["lang"].to_pylist(), dtype=object)
    buckets, n = summed["bucket"].to_numpy(), summed["n"].to_numpy()
    languages = sorted(set(names))
    weights = np.zeros((len(languages), 1 << bits))
    priors = np.zeros(len(languages))
    for k, lang in enumerate(languages):
        own = names == lang
        vector = np.zeros(1 << bits)
        vector[buckets[own & (buckets >= 0)]] = n[own & (buckets >= 0)]
        weights[k] = np.log((vector + smoothing) / (vector.sum() + smoothing * len(vector)))
        priors[k] = np.log(n[own & (buckets < 0)].sum() / n[buckets < 0].sum())
    return Model(languages, weights, priors, bits)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for each row."""
    shared = share(docs.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared()
        for batch in batches:
            found = [m.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        score, f"doc_id {kind}, lang_pred string, score double"
    )


def identify(docs: DataFrame) -> DataFrame:
    """Predict all documents, having learned from those whose remainder by 4 is not 2."""
    rest = remainder("doc_id", 4)
    model = train(docs.where(rest != 2))
    return predict(docs, model).select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
