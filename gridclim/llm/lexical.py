"""Ranked lexical search of many queries at once, by the term sets that queries share.

Items are mined for sets of terms that several of them hold: two terms or sets that meet
in most items become one new set, over and over, until no two meet twice. That gives a
graph in which an item is a sum of sets and a set is a sum of two smaller ones. For each
document the partial score of every set is worked out once, from below, and items
add up what they share. All scores are whole numbers, so the order of sums does not matter.

Documents become postings of the items' terms in one pass, kept as a table; document
counts come from it. Scoring is a second pass over the postings, in which each task holds the best
documents of each item; these few are ranked in two steps, so no group grows with the corpus.
The corpus is never held against single items: all items of a block, of about
``block_terms`` terms, are scored in one pass, and more items make more passes.

Defined cases: NULL and empty texts have no terms; such documents count for nothing and are in no
ranking, and such items have none. Documents without identifier count in all statistics but are not ranked. Documents that repeat an
identifier are ranked each by itself. Items that repeat in identifier and text are one item; without identifier they are
ranked under NULL.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import pieces_of, share, utf8, whole
from .hashing import LOWER

TERM = np.ones(256, dtype=bool)  # bytes of terms: digits, letters, and all beyond ASCII
TERM[:128] = [chr(b).isalnum() for b in range(128)]
SALTS = 64


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in a row, A-Z in lower case, and the text that each one is in."""
    data, offsets = utf8(texts)
    inside = TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opens = offsets[:-1][np.diff(offsets) > 0]
    first[opens] = inside[opens]
    starts = np.flatnonzero(first)
    kept = LOWER[data[inside]]
    begin = np.append((np.cumsum(inside) - 1)[starts], len(kept)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(begin), pa.py_buffer(kept))
    return found, np.searchsorted(offsets, starts, "right") - 1


@dataclass(frozen=True)
class Graph:
    """Shared term sets. Nodes are numbered from below: leaves first, then sets, level by level."""

    leaves: list[tuple[str, int]]  # a term and how often an item holds it
    levels: list[tuple[np.ndarray, np.ndarray]]  # per level the two parts of each new set
    parts: np.ndarray  # the nodes of all items in a row
    starts: np.ndarray  # where each item's nodes start

    @property
    def nodes(self) -> int:
        return len(self.leaves) + sum(len(left) for left, _ in self.levels)

    def sums(self, leaves: np.ndarray) -> np.ndarray:
        """Items by documents, from leaves by documents."""
        values = np.empty((self.nodes, leaves.shape[1]), dtype=np.int64)
        values[: len(leaves)] = leaves
        made = len(leaves)
        for left, right in self.levels:
            np.add(values[left], values[right], out=values[made : made + len(left)])
            made += len(left)
        return np.add.reduceat(values[self.parts], self.starts, axis=0)


def mine(items: list[Counter[str]], group: int = 256) -> Graph:
    """Find the term sets that items share.

    Each round counts how many items hold each pair of nodes and joins pairs that meet
    at least twice, the most frequent first and each node once. Items of more than
    ``group`` terms are mined in groups of that many, frequent terms together.
    """
    held = Counter(leaf for item in items for leaf in item.items())
    leaves = sorted(held, key=lambda leaf: (-held[leaf], leaf))
    number = {leaf: k for k, leaf in enumerate(leaves)}
    sets: list[np.ndarray] = []
    owner: list[int] = []
    for k, item in enumerate(items):
        nodes = np.sort(np.array([number[leaf] for leaf in item.items()], dtype=np.int64))
        for a in range(0, len(nodes), group):
            sets.append(nodes[a : a + group])
            owner.append(k)
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    made = len(leaves)
    while True:
        met = [s[i] << 32 | s[j] for s in sets if len(s) > 1 for i, j in (np.triu_indices(len(s), 1),)]
        pairs, times = np.unique(np.concatenate(met), return_counts=True) if met else (np.zeros(0, np.int64),) * 2
        pairs, times = pairs[times > 1], times[times > 1]
        taken: dict[int, int] = {}
        chosen: list[tuple[int, int]] = []
        for pair in pairs[np.argsort(-times, kind="stable")].tolist():
            a, b = pair >> 32, pair & 0xFFFFFFFF
            if a not in taken and b not in taken:
                taken[a], taken[b] = b, a
                chosen.append((a, b))
        if not chosen:
            break
        mate = np.full(made, -1, dtype=np.int64)
        joined = np.full(made, -1, dtype=np.int64)
        for k, (a, b) in enumerate(chosen):
            mate[a], mate[b] = b, a
            joined[a] = made + k  # the smaller one of a pair becomes the set
        levels.append(tuple(np.array(chosen, dtype=np.int64).T))
        for k, s in enumerate(sets):
            both = (mate[s] >= 0) & np.isin(mate[s], s)
            sets[k] = np.sort(np.where(both, joined[s], s)[~both | (joined[s] >= 0)])
        made += len(chosen)
    lengths = np.bincount(owner, weights=[len(s) for s in sets], minlength=len(items)).astype(np.int64)
    parts = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    return Graph(leaves, levels, parts, np.append(0, np.cumsum(lengths)[:-1]))


def postings(docs: DataFrame, terms: list[str], *, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 4 << 20) -> DataFrame:
    """(id, n, terms, tf): each document's number of terms, and which of ``terms`` it holds how often."""
    shared = share(docs.sparkSession, pa.array(terms, pa.string()))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared()
        for batch in pieces_of(batches, 1, batch_bytes):
            words, row = terms_of(batch.column(1))
            at = pc.index_in(words, value_set=known)
            hit = at.is_valid().to_numpy(zero_copy_only=False)
            key = row[hit] * len(known) + at.drop_null().to_numpy()
            key, tf = np.unique(key, return_counts=True)
            ends = np.searchsorted(key, np.arange(batch.num_rows + 1) * len(known))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (key % len(known), tf)]
            n = pa.array(np.bincount(row, minlength=batch.num_rows), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, *lists], names=["id", "n", "terms", "tf"])

    found = docs.select(F.col(id_col).cast("bigint").alias("id"), whole(text_col).alias("text")).mapInArrow(
        post, "id long, n long, terms array<int>, tf array<int>"
    )
    return materialise(found.where("n > 0"))


def best(posted: DataFrame, graph: Graph, term_of: np.ndarray, weights: np.ndarray, docs: int, terms: int, top: int, cells: int = 1 << 22) -> DataFrame:
    """(item, id, score): each task's best ``top`` documents of each item.

    Documents are scored together as long as documents times nodes stay within ``cells``.
    """
    repeats = np.array([r for _, r in graph.leaves], dtype=np.int64)
    shared = share(posted.sparkSession, (graph, term_of, weights))
    step = max(1, cells // max(graph.nodes + len(graph.parts), 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, term_at, weight = shared()
        items = len(own.starts)
        least = np.zeros(items, dtype=np.int64)  # what a document must reach to be among the best so far
        kept = np.zeros((3, 0), dtype=np.int64)  # item, id, score
        fresh: list[np.ndarray] = []

        def settle() -> np.ndarray:
            rows = np.concatenate([kept, *fresh], axis=1)
            fresh.clear()
            rows = rows[:, np.lexsort((rows[1], -rows[2], rows[0]))]
            begin = np.searchsorted(rows[0], np.arange(items))
            rank = np.arange(rows.shape[1]) - begin[rows[0]]
            rows = rows[:, rank < top]
            full = rank[rank < top] == top - 1
            least[rows[0, full]] = rows[2, full]
            return rows

        for batch in batches:
            ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            m = 75 + (25 * n * docs) // terms
            ends = batch.column(2).offsets.to_numpy()
            term, tf = (batch.column(k).values.to_numpy().astype(np.int64) for k in (2, 3))
            for a in range(0, batch.num_rows, step):
                b = min(a + step, batch.num_rows)
                held = slice(ends[a], ends[b])
                row = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                gain = weight[term[held]] * (1_000_000_000 * tf[held] // (1000 * tf[held] + 12 * m[a:b][row]))
                leaves = np.zeros((len(weight), b - a), dtype=np.int64)
                leaves[term[held], row] = gain
                total = own.sums(leaves[term_at] * repeats[:, None])
                item, doc = np.nonzero((total > 0) & (total >= least[:, None]))
                fresh.append(np.stack([item, ids[a:b][doc], total[item, doc]]))
                if sum(f.shape[1] for f in fresh) > 4 * top * items:
                    kept = settle()
        kept = settle() if fresh else kept
        for k in range(0, kept.shape[1], 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 10_000], pa.int64()) for c in kept], names=["item", "id", "score"])

    return posted.where("id IS NOT NULL").select("id", "n", "terms", "tf").mapInArrow(score, "item long, id long, score long")


def _search_block(docs: DataFrame, items: pa.Table, top: int, **columns) -> DataFrame:
    """Rankings of items that the driver holds: (item_id, doc_id, score), not yet the best of all tasks."""
    spark = docs.sparkSession
    words, row = terms_of(items["text"].combine_chunks())
    held: list[Counter[str]] = [Counter() for _ in range(len(items))]
    for r, w in zip(row.tolist(), words.to_pylist()):
        held[r][w] += 1
    some = [k for k, c in enumerate(held) if c]
    if not some:
        return spark.createDataFrame(pa.table({"item_id": items["item_id"][:0], **dict.fromkeys(("item", "doc_id", "score"), pa.array([], pa.int64()))}))
    graph = mine([held[k] for k in some])
    terms = sorted({t for t, _ in graph.leaves})
    posted = postings(docs, terms, **columns)
    n_docs, n_terms = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
    df = np.zeros(len(terms), dtype=np.int64)
    for r in posted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r.t] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    number = {t: k for k, t in enumerate(terms)}
    term_of = np.array([number[t] for t, _ in graph.leaves], dtype=np.int64)
    found = best(posted, graph, term_of, weights, n_docs, n_terms, top)
    names = pa.table({"item": pa.array(range(len(some)), pa.int64()), "item_id": items["item_id"].take(pa.array(some, pa.int64()))})
    return found.join(F.broadcast(spark.createDataFrame(names)), "item").select("item_id", "item", F.col("id").alias("doc_id"), "score")


def search(
    docs: DataFrame, items: DataFrame, *, top: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_terms: int = 1 << 15,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents.

    Items are dealt into blocks by a hash, so a block has about ``block_terms`` terms; only one
    block of items, or one item if that is longer, is on the driver at a time.
    """
    named = items.select(F.col(item_col).alias("item_id"), whole(item_text_col).alias("text")).distinct()
    length = named.agg(F.sum(F.ceil(F.octet_length("text") / 6))).first()[0] or 0
    blocks = max(1, math.ceil(length / block_terms))
    dealt = named.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = []
    for k in range(blocks):
        block = dealt.where(F.col("block") == k).select("item_id", "text").toArrow()
        found.append(_search_block(docs, block, top, id_col=id_col, text_col=text_col).withColumn("block", F.lit(k)))
    every = reduce(DataFrame.unionByName, found)
    key = ("block", "item", "item_id")
    best_first = (F.desc("score"), F.asc("doc_id"))
    some = every.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "salt").orderBy(*best_first))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*best_first)))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
