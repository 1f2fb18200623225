"""Near-duplicate documents by one-permutation MinHash.

1. Each text becomes its set of word shingles. One hash per shingle deals the set into
   bins, the smallest hash of a bin is its value, and an empty bin copies the value of a
   bin that a fixed sequence of trials finds (optimal densification).
2. Documents with equal sets form a class at once; only classes go on.
3. Rows of bins make bands, and classes that agree on a band share a bucket. A bucket of m
   classes gives at most 2 (m - 1) candidates, as stars: around the member that shares most
   buckets overall, the likely centre of its group, and around the smallest member. Buckets
   of four or more are divided by the next band, and again by the one after, with the
   same stars in each part, so that closer members meet without their bucket's centres.
4. Candidates are confirmed on the full sets and joined into components.
5. Buckets up to three members were compared in full by that. Members of larger ones are met
   again by their rarest shingles: two sets of the wanted similarity share one of the first
   ninth of the smaller set (at 80 percent) and the first fifth of the larger one. Only members
   of different components are compared, so a large group costs nothing more.
6. All confirmed links are joined into components.

With 32 bands of 4 bins a pair of similarity 0.8 shares no bucket with probability 5e-8. No
bucket, partner or candidate is capped or dropped: pairs that share a bucket are linked
whenever their sets say so, or are in one component already.

Defined cases: NULL, empty and blank texts have no shingles and are linked with nothing.
Rows with equal identifiers are one document for links, near to whatever one of their texts
is near to; each gets its row. Rows without
identifier are linked with nothing and have a NULL component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import whole
from .components import components
from .hashing import BASES, mix, shingle_set

_U = np.uint64
LEVELS = 3


_TRIALS: dict[tuple[int, int], np.ndarray] = {}


def _trials(bins: int, start: int, count: int = 64) -> np.ndarray:
    """Which bin an empty bin looks at in each of its trials."""
    if (bins, start) in _TRIALS:
        return _TRIALS[bins, start]
    t = np.arange(start, start + count, dtype=np.uint64)[:, None]
    i = np.arange(bins, dtype=np.uint64)[None, :]
    found = _TRIALS[bins, start] = (mix(i * BASES[0] + t * BASES[1] + _U(1)) % _U(bins)).astype(np.int64)
    return found


def sketch(shingles: np.ndarray, bins: int) -> np.ndarray:
    """The densified one-permutation sketch of a sorted, non-empty set of hashes."""
    width = _U(64 - int(bins).bit_length() + 1)
    where, first = np.unique(shingles >> width, return_index=True)
    values = np.zeros(bins, dtype=np.uint64)
    values[where.astype(np.int64)] = shingles[first]
    full = np.zeros(bins, dtype=bool)
    full[where.astype(np.int64)] = True
    open_ = np.flatnonzero(~full)
    start = 0
    while len(open_):
        trials = _trials(bins, start)[:, open_]
        hit = full[trials]
        found = hit.any(axis=0)
        source = trials[hit.argmax(axis=0), np.arange(len(open_))]
        values[open_[found]] = values[source[found]]
        open_ = open_[~found]
        start += len(trials)
    return values


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """A line per band: its key, its key with the next band, and with the two next ones."""
    table = values.reshape(-1, rows)
    key = np.arange(1, len(table) + 1, dtype=np.uint64) * BASES[1]
    levels = []
    for level in range(LEVELS):
        for k in range(rows):
            key = mix(key * BASES[0] + np.roll(table, -level, axis=0)[:, k])
        levels.append(key)
    return np.stack(levels, axis=1).astype(np.int64)


def signatures(
    docs: DataFrame, *, id_col: str, text_col: str, words: int, bins: int, rows: int
) -> DataFrame:
    """(id, n, digest, bands): set size, 128-bit digest of the set, band keys."""
    if bins & (bins - 1) or bins % rows:
        raise ValueError("bins must be a power of two and a multiple of rows")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, keys = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), words)
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                keys.append(bands(sketch(s, bins), rows).ravel() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "n", "digest", "bands"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).mapInArrow(
        sign, f"id {kind}, n long, digest binary, bands array<long>"
    )


#: Bits of the filter that tells which documents' sets are needed: 16 MB, whatever the corpus.
FILTER_BITS = 1 << 27


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def _filter(ids: DataFrame) -> np.ndarray:
    """A bit for each identifier's hash. Other identifiers may have the same bit."""
    at = _place("id")
    words = (
        ids.select((at / 64).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {FILTER_BITS}) % 64 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, s): the full sets of the wanted documents, of (id, text), and of a few others.

    The filter keeps other texts from being cut and moved; what it lets through is harmless.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_filter(wanted))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            hit = (shared.value[at // 64] >> (at % 64).astype(np.uint64)) & _U(1)
            batch = batch.filter(pa.array(hit.astype(bool)))
            sets = [shingle_set(t.as_py(), words).astype(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "s"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.where("id IS NOT NULL").select("id", "text", _place("id")).mapInArrow(cut, f"id {kind}, s array<long>")


def _stars(members: DataFrame) -> DataFrame:
    """(a, b): in each bucket, its two centres with every other member."""
    centres = members.groupBy("h").agg(F.max_by("id", F.struct("score", "id")).alias("c"), F.min("id").alias("d"))
    return (
        members.join(centres, "h")
        .select(F.col("id").alias("x"), F.explode(F.array_distinct(F.array("c", "d"))).alias("y"))
        .where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets share ``percent`` of their union."""
    a = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    size = lambda c: F.size(c).cast("bigint")
    common = size(F.array_intersect("sa", "sb"))
    near = 100 * F.least(size("sa"), size("sb")) >= percent * F.greatest(size("sa"), size("sb"))
    return (
        pairs.join(b, "b")
        .join(a, "a")
        .where(near)
        .select("a", "b", common.alias("common"), (size("sa") + size("sb")).alias("both"))
        .where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("both") - F.col("common")))
        .select("a", "b")
    )


#: Counters of the shingle order: 8 MB, whatever the corpus.
COUNTERS = 1 << 20


def _counts(sets: DataFrame) -> np.ndarray:
    """How many shingles fall to each counter. Several shingles may share one."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy() & (COUNTERS - 1), minlength=COUNTERS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["at", "seen"])

    found = sets.select("s").mapInArrow(add, "at long, seen long").groupBy("at").agg(F.sum("seen").alias("seen")).toArrow()
    out = np.zeros(COUNTERS, dtype=np.int64)
    out[found["at"].to_numpy()] = found["seen"].to_numpy()
    return out


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """(g, component, id, n, at): of each set (id, component, s) the shingles that a set as near may
    share first, with their places, in an order that is the same for all sets and starts with rare ones."""
    shared = sets.sparkSession.sparkContext.broadcast(_counts(sets))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, rows, sizes = [], [], []
            for s in batch.column(2):
                g = s.values.to_numpy()
                order = np.lexsort((g, shared.value[g & (COUNTERS - 1)]))
                firsts.append(g[order[: len(g) + 1 - -(-percent * len(g) // 100)]])
                rows.append(len(firsts[-1]))
                sizes.append(len(g))
            if not rows:
                continue
            of = np.repeat(np.arange(len(rows)), rows)
            at = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(firsts), pa.int64()), batch.column(1).take(pa.array(of)), batch.column(0).take(pa.array(of)),
                    pa.array(np.array(sizes)[of], pa.int64()), pa.array(at, pa.int64()),
                ],
                names=["g", "component", "id", "n", "at"],
            )

    kind = sets.schema["id"].dataType.simpleString()
    return sets.select("id", "component", "s").mapInArrow(cut, f"g long, component {kind}, id {kind}, n long, at long")


def _remainder(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of (id, component, s) that may be as near and are in different components.

    At the first shingle that two sets share, what is left of either bounds what they have in
    common. Which components meet is settled first, so that members of one are never paired.
    """
    firsts = materialise(_rarest(sets, percent))
    low, high = F.lit(2 * percent), F.lit(100 + percent)
    firsts = firsts.withColumn("small", high * (F.col("n") - F.col("at")) >= low * F.col("n"))  # may be the smaller set's
    per = firsts.groupBy("g", "component").agg(
        F.min(F.when(F.col("small"), F.col("n"))).alias("least"), F.max(F.when(F.col("small"), F.col("n"))).alias("most"),
        F.min("n").alias("from"), F.max("n").alias("to"), F.max(F.col("n") - F.col("at")).alias("left"),
    )
    several = per.groupBy("g").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("g")
    per = materialise(per.join(several, "g", "left_semi"))
    a = per.where("least IS NOT NULL").select("g", F.col("component").alias("ca"), "least", "most")
    b = per.select(F.col("g").alias("gb"), F.col("component").alias("cb"), "from", "to", "left")
    fits = (F.col("least") <= F.col("to")) & (F.lit(percent) * F.col("from") <= F.lit(100) * F.col("most"))
    meet = a.join(b, (F.col("g") == F.col("gb")) & (F.col("ca") != F.col("cb")) & fits).select("g", "ca", "cb", "from", "to", "left")
    side = lambda x: firsts.select(
        F.col("g").alias(f"g{x}"), F.col("component").alias(f"c{x}{x}"), F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("at").alias(f"at{x}"), F.col("small").alias(f"small{x}")
    )
    # What a component's sets are at best tells which of the other's members need not be paired with it.
    worth = (
        (F.col("na") <= F.col("to"))
        & (F.lit(percent) * F.col("from") <= F.lit(100) * F.col("na"))
        & (high * F.least(F.col("na") - F.col("ata"), "left") >= F.lit(percent) * (F.col("na") + F.greatest("na", "from")))
    )
    left = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb"))
    near = (
        (F.struct("na", "a") < F.struct("nb", "b"))
        & (F.lit(percent) * F.col("nb") <= F.lit(100) * F.col("na"))
        & (high * left >= F.lit(percent) * (F.col("na") + F.col("nb")))
    )
    return (
        meet.join(side("a").where("smalla"), (F.col("g") == F.col("ga")) & (F.col("ca") == F.col("caa")) & worth)
        .join(side("b"), (F.col("g") == F.col("gb")) & (F.col("cb") == F.col("cbb")) & near)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def links(docs: DataFrame, classes: DataFrame, *, words: int, percent: int) -> DataFrame:
    """(a, b): links that connect classes, given as (id, bands), which hang together by confirmed ones."""
    starts = F.sequence(F.lit(1), F.size("bands"), F.lit(LEVELS))
    buckets = classes.select("id", F.explode(F.transform(starts, lambda i: F.slice("bands", i, F.lit(LEVELS)))).alias("k"))
    buckets = buckets.select("id", *[F.get("k", F.lit(i)).alias(f"h{i}") for i in range(LEVELS)])
    shared = buckets.groupBy("h0").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = materialise(buckets.join(shared, "h0"))
    scores = members.groupBy("id").agg(F.sum("m").alias("score"))
    members = members.join(scores, "id")
    deeper = F.when(F.col("m") > 3, F.array(*[f"h{i}" for i in range(LEVELS)])).otherwise(F.array("h0"))
    pairs = materialise(_stars(members.select("id", "score", F.explode(deeper).alias("h"))).distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = materialise(shingle_sets(docs, wanted, words))
    near = materialise(_confirmed(pairs, sets, percent).distinct())
    large = members.where("m > 3").select("id").distinct()
    groups = components(near).withColumnRenamed("node", "id")
    rest = sets.where(F.size("s") > 0).join(large, "id", "left_semi").join(groups, "id", "left")
    rest = materialise(rest.select("id", F.coalesce("component", "id").alias("component"), "s"))
    more = materialise(_remainder(rest, percent))
    # the stars of the first components stand for their links
    stars = groups.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
    return stars.union(_confirmed(more, sets, percent)).distinct()


def duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    bins: int = 128,
    rows: int = 4,
) -> DataFrame:
    """(id, n, component) for every row: set size and smallest identifier of its group."""
    signed = materialise(signatures(docs, id_col=id_col, text_col=text_col, words=words, bins=bins, rows=rows))
    usable = signed.where("n > 0 AND id IS NOT NULL")
    # Equal identifiers with different texts: the smallest set stands for the identifier.
    classes = materialise(
        usable.groupBy("digest").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    )
    texts = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    groups = components(links(texts, classes.select("id", "bands"), words=words, percent=percent))
    named = classes.select("digest", "id").join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    return (
        signed.select("id", "n", "digest")
        .join(named, "digest", "left")
        .select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    )


def report(docs: DataFrame, **options) -> DataFrame:
    found = duplicates(docs, **options)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each group of near duplicates, with all columns."""
    kept = duplicates(docs, id_col=id_col, **options).where("id = component").select(F.col("id").alias("_kept")).distinct()
    with_id = docs.join(kept, F.col("_kept") == docs[id_col], "left_semi").dropDuplicates([id_col])
    return with_id.union(docs.where(F.col(id_col).isNull()))
