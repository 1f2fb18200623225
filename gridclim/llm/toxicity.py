"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. Both start
with what ordinary text holds most; each goes on with the words that set its class apart, by
the number of documents that hold them. A window of text that shares more with toxic text
compresses better with the toxic dictionary. Windows are runs of whole words. Their
differences in compressed length are summed up per text in a few figures, and a logistic
curve, calibrated on labelled texts kept out of the dictionaries, turns these into a score
between 0 and 1. It is placed so that ``clean_loss`` of the ordinary calibration texts reach 0.5.
How surely a word has to belong to a class, and how long a window is, is chosen on the calibration
texts too, by curves fitted on one half of them and tried on the other.

Dictionaries and calibration learn from a bounded sample of labelled rows, ``sample_rows``
of each class, those with the smallest hash of their identifier; ``sample_bytes`` bounds
the text they may hold together, and a text that no longer fits is passed over. Scoring covers
all rows and whole texts.

Defined cases: NULL and empty texts get the calibrated score of a text without windows.
Without labelled rows of both classes every score is 0. A row with several labels counts
as toxic if one of them says so. Rows that repeat are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import share, whole

STEPS = (1, 2, 3, 4, 6)  # bytes saved, counted per text
FEATURES = 4 + len(STEPS)
NO_LETTERS = re.compile(r"[\W\d_]+")


def words(text: str) -> list[str]:
    return NO_LETTERS.sub(" ", text.lower()).split()


def windows(text: str, size: int) -> list[bytes]:
    """The text's lower-case words in runs of ``size`` bytes or little more; a long word is cut."""
    data = f" {' '.join(words(text))} ".encode("utf-8", "surrogatepass")
    found, start, last = [], 0, len(data) - 1
    while start < last - 1:
        stop = min(start + size, last)
        space = data.find(b" ", stop, start + 4 * size)
        stop = space if space >= 0 else stop
        found.append(data[start : stop + 1])
        start = stop
    return found


class Compressors:
    """Compressors of one dictionary pair, made where they are used."""

    def __init__(self, toxic: bytes, ordinary: bytes, level: int) -> None:
        kind = zstandard.DICT_TYPE_RAWCONTENT
        self.pair = [
            zstandard.ZstdCompressor(
                level=level, write_content_size=False, write_checksum=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind),
            )
            for d in (toxic, ordinary)
        ]

    def gains(self, text: str, size: int) -> np.ndarray:
        """Bytes per window that the toxic dictionary saves over the ordinary one."""
        a, b = (c.compress for c in self.pair)
        return np.array([len(b(w)) - len(a(w)) for w in windows(text, size)], dtype=float)


def features(gains: np.ndarray) -> np.ndarray:
    """Figures of a text's windows: how much on average, how far the best ones go, how many."""
    if not len(gains):
        return np.zeros(FEATURES)
    top = np.sort(gains)[::-1]
    return np.array(
        [gains.mean(), top[0], top[:5].sum() / 5, top[: max(1, len(top) // 10)].mean()]
        + [np.log1p((gains >= k).sum()) for k in STEPS]
    )


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    size: int
    level: int
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant

    def compressors(self) -> Compressors:
        return Compressors(self.toxic, self.ordinary, self.level)

    def score(self, gains: np.ndarray) -> float:
        x = (features(gains) - self.centre) / self.scale
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -50, 50))))


def _rated(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col)).alias("toxic"))
    )


def sample(
    docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, sample_rows: int
) -> DataFrame:
    """(text, toxic): at most ``sample_rows`` labelled rows of each class."""
    rated = _rated(labels, id_col, label_col)
    chosen = None
    for label in (0, 1):
        some = rated.where(F.col("toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select(F.col("_id").alias("id"), "text", "toxic")


def _dictionary(pieces: list[bytes], size: int) -> bytes:
    if len(pieces) < 16:
        return b"".join(pieces)[:size]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too little or too uniform text to choose from
        return b"".join(pieces)[:size]


def _holders(texts: list[tuple[str, int]], label: int) -> tuple[Counter[str], int]:
    """In how many texts of a class each word occurs, and how many texts there are."""
    held: Counter[str] = Counter()
    chosen = [t for t, y in texts if y == label]
    for t in chosen:
        held.update({w for w in words(t) if len(w) >= 4})
    return held, max(1, len(chosen))


def contrasting(
    own: tuple[Counter[str], int], other: tuple[Counter[str], int], *, least: float, ratio: float, size: int
) -> bytes:
    """Words of a class that set it apart, the surest last, where matches cost least.

    They are in at least four of its texts and ``ratio`` times as often as in the other class.
    The rank is the likelihood ratio against being spread evenly, which has to be ``least``.
    First letters lie at multiples of three: dictionaries of this strategy are indexed there.
    """
    (held, n), (elsewhere, m) = own, other
    ranked = []
    for word, count in held.items():
        rest = elsewhere[word]
        if count < 4 or count / n < ratio * rest / m:
            continue
        expected = (count + rest) * n / (n + m)
        surprise = count * np.log(count / expected) + (rest * np.log(rest / (count + rest - expected)) if rest else 0.0)
        if 2 * surprise >= least:
            ranked.append((surprise, word))
    found: list[bytes] = []
    for _, word in sorted(ranked, reverse=True):
        piece = b"  " + f" {word} ".encode("utf-8", "surrogatepass")  # three blanks first
        piece += b" " * (-len(piece) % 3)
        size -= len(piece)
        if size < 0:
            break
        found.append(piece)
    return b"".join(reversed(found))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton's method, the constant last; both classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    each = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), x.T @ (each * (y - p)) - w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _caught(x: np.ndarray, y: np.ndarray, clean_loss: float) -> float:
    """Share of toxic rows beyond all but ``clean_loss`` of the ordinary ones, by curves of the other half."""
    total = 0.0
    for part in (0, 1):
        fold = np.arange(len(y)) % 2 == part
        if len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
            return 0.0
        w = _logistic(x[~fold], y[~fold])
        s, truth = x[fold] @ w[:-1], y[fold]
        total += float((s[truth == 1] > np.quantile(s[truth == 0], 1 - clean_loss)).mean())
    return total / 2


def _border(s: np.ndarray, y: np.ndarray, clean_loss: float) -> float:
    """A place that all but ``clean_loss`` of the ordinary rows lie below, halfway to the next row."""
    clean = np.sort(s[y == 0])[::-1]
    below = clean[min(len(clean) - 1, int(clean_loss * len(clean)))]
    above = s[s > below]
    return float((below + above.min()) / 2 if len(above) else below + 1)


def fit(
    texts: list[tuple[str, int]],
    *,
    sizes: tuple[int, ...] = (16, 20),
    least: tuple[float, ...] = (8, 20, 40),
    ratio: float = 8,
    shared: int = 65536,
    own: int = 4096,
    level: int = 3,
    clean_loss: float = 0.03,
    every: int = 4,
) -> Model:
    """Train on (text, toxic) pairs: calibration on each ``every``th one, dictionaries on the others."""
    learn = [x for i, x in enumerate(texts) if i % every]
    keep = [x for i, x in enumerate(texts) if not i % every]
    common = _dictionary([w for t, y in learn if y == 0 for w in windows(t, 256)[::2]], shared)
    common += b" " * (-len(common) % 3)
    held = [_holders(learn, label) for label in (0, 1)]
    y = np.array([y for _, y in keep], dtype=float)
    zero = np.zeros(FEATURES)
    if not len(y) or y.min() == y.max():
        return Model(common, common, sizes[0], level, zero, zero + 1, np.append(zero, -50.0))
    best, chosen = -1.0, None
    for part in least:
        toxic, ordinary = (
            common + contrasting(held[k], held[1 - k], least=part, ratio=ratio, size=own) for k in (1, 0)
        )
        tools = Compressors(toxic, ordinary, level)
        for size in sizes:
            x = np.array([features(tools.gains(t, size)) for t, _ in keep])
            centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
            x = (x - centre) / scale
            caught = _caught(x, y, clean_loss)
            if caught > best:
                best, chosen = caught, (toxic, ordinary, size, centre, scale, x)
    toxic, ordinary, size, centre, scale, x = chosen
    weights = _logistic(x, y)
    weights[-1] = -_border(x @ weights[:-1], y, clean_loss)
    return Model(toxic, ordinary, size, level, centre, scale, weights)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 3000,
    sample_bytes: int = 48 << 20,
    **options,
) -> Model:
    """Fit on the bounded sample, which is all that reaches the driver."""
    rows = sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, sample_rows=sample_rows)
    # Whole texts in hash order, those that fit.
    rows = rows.withColumn("_h", F.xxhash64("id", "text")).where(F.octet_length("text") <= sample_bytes)
    kept, room = [], sample_bytes
    for r in rows.orderBy("_h", "id").toLocalIterator():
        size = len(r["text"].encode("utf-8", "surrogatepass"))
        if size <= room:
            room -= size
            kept.append((r["text"], int(r["toxic"])))
    return fit(kept, **options)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for each row."""
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared()
        tools = m.compressors()
        for batch in batches:
            found = [m.score(tools.gains(t.as_py(), m.size)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double"
    )


def remainder(id_col: str, divisor: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score all documents, having learned from labels of those whose remainder by 5 is not 0."""
    rest = remainder("doc_id", 5)
    model = train(docs, labels.where(rest != 0))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(rest == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def ordinary_only(
    docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The documents that score below ``threshold``, with all columns."""
    shared = share(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared()
        tools = m.compressors()
        for batch in batches:
            keep = [m.score(tools.gains(t.as_py() or "", m.size)) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
