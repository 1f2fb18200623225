"""Benchmark decontamination: windows of benchmark words looked up in a broadcast hash set.

Every text is cut into words once. Each window start of a document becomes a row with the
window's 64-bit hash, which meets the benchmark's windows in a hash join whose build side
is broadcast after its size is checked, all in one generated loop; a hit counts only if
the words are the same. Only hits and one marker row per document are shuffled, no texts.

Defined cases: a NULL or empty text has no words and no hits. An item without id or
without words marks nothing. Items or documents that repeat are judged alike and each
document row gives one result row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, keyed, whole

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before A-Z are put in lower case.
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, ASCII letters and characters beyond ASCII, A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def window_table(
    benchmark: DataFrame, window: int = 10, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(length, gram, items): each distinct window and the items that hold it.

    An item of fewer words than ``window``, but not none, is one window.
    """
    w = F.col("w")
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - window + 1, F.lit(1)))
    return (
        benchmark.select(F.col(item_col).cast("string").alias("item"), words(whole(text_col)).alias("w"))
        .where(F.col("item").isNotNull() & (F.size("w") > 0))
        .select("item", F.least(F.size(w), F.lit(window)).alias("length"), "w", F.explode_outer(starts).alias("i"))
        .select("item", "length", F.array_join(F.slice(w, F.col("i"), F.lit(window)), " ").alias("gram"))
        .groupBy("length", "gram")
        .agg(F.collect_set("item").alias("items"))
    )


def _runs(at: Column) -> Column:
    """Runs of neighbouring positions in a sorted array, as spans with exclusive ends."""
    first = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
    last = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) != p + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per document row: id, th, n_words, n_hit, spans (of word positions), items.

    ``broadcast_bytes`` bounds the window table that is broadcast. A larger one is met
    by a shuffle of the documents' windows instead, with the same result.
    """
    grams = window_table(benchmark, window, item_col, item_text_col)
    size, lengths = grams.agg(
        F.sum(F.octet_length("gram") + 24 + 32 * F.size("items")), F.sort_array(F.collect_set("length"))
    ).first()
    small = (size or 0) <= broadcast_bytes
    grams = grams.withColumn("h", F.xxhash64(F.split("gram", " ")))

    lengths = lengths or [window]  # at most ``window`` different ones
    w, i, n_words = F.col("w"), F.col("i"), F.col("n_words")
    at = F.col("first") + i

    def key(n: int) -> Column:
        parts = F.xxhash64(*[F.get(w, at + k) for k in range(n)])
        return F.when(i < 0, F.lit(0).cast("bigint")).when(i <= n_words - n, parts)

    rows = (
        keyed(docs, id_col, text_col)
        .select("id", "th", F.split(ascii_lower(F.col("text")), SEPARATORS, -1).alias("w"))
        .select("id", "th", "w", (F.get(w, F.lit(0)) == "").cast("int").alias("first"), (F.get(w, F.size(w) - 1) == "").cast("int").alias("last"))
        .select("id", "th", "w", "first", F.greatest(F.size(w) - F.col("first") - F.col("last"), F.lit(0)).alias("n_words"))
        # Position -1 is the document's marker. Outer, as Spark else cuts words twice for a filter.
        .select("*", F.explode_outer(F.sequence(F.lit(-1), F.greatest(n_words - min(lengths), F.lit(-1)))).alias("i"))
    )
    if len(lengths) == 1:
        rows = rows.select("*", F.lit(lengths[0]).alias("n"), key(lengths[0]).alias("h"))
    else:
        each = F.array(*[F.struct(F.lit(n).alias("n"), key(n).alias("h")) for n in lengths])
        rows = rows.select("*", F.explode_outer(F.when(i < 0, F.slice(each, 1, 1)).otherwise(each)).alias("f")).select(
            "id", "th", "w", "first", "n_words", "i", "f.*"
        )
    markers = grams.sparkSession.range(1).select(
        F.lit(0).alias("length"), F.lit("").alias("gram"), F.lit(None).cast("array<string>").alias("items"), F.lit(0).cast("bigint").alias("h")
    )
    table = grams.select("length", "gram", "items", "h").union(markers)
    gram = F.when(i < 0, F.lit("")).otherwise(F.array_join(F.slice(w, F.greatest(at, F.lit(0)) + 1, F.col("n")), " "))
    if small:
        # The hash is the only key; words are compared for its hits, in a form that is no key.
        known = F.broadcast(table.select(F.col("h").alias("known"), "gram", "length", "items"))
        same = F.startswith(gram, F.col("gram")) & F.startswith(F.col("gram"), gram)
        met = rows.join(known, (F.col("h") == F.col("known")) & same)
    else:
        met = rows.select("id", "th", "n_words", "i", gram.alias("gram")).join(table, "gram")
    real = F.col("length") > 0
    reach = F.when(real, F.sequence(i, i + F.col("length") - 1))
    return (
        met.groupBy("id", "th", "n_words")
        .agg(
            F.count_if(~real).alias("copies"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(reach)))).alias("at"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(real, F.col("items")))))).alias("items"),
        )
        .select(
            "id", "th", "n_words", "at", "items",
            F.explode_outer(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
        )
        .select("id", "th", "n_words", F.size("at").alias("n_hit"), _runs(F.col("at")).alias("spans"), "items")
    )


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest of :func:`hits`: counts of hit words and items per document."""
    n_hit = F.col("n_hit").cast("bigint")
    return hits(docs, benchmark, **options).select(
        F.col("id").alias("doc_id"),
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents without contaminated ones, or with the hit words cut out of their text.

    ``remove`` is ``"documents"`` or ``"spans"``. All columns are kept. With spans, a hit
    word goes together with the separators before it.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"unknown way to remove: {remove}")
    found = (
        hits(docs, benchmark, id_col=id_col, text_col=text_col, **options)
        .where("n_hit > 0")
        .select(F.col("id").alias("_hit_id"), F.col("th").alias("_hit_th"), F.col("spans").alias("_hit_spans"))
        .dropDuplicates(["_hit_id", "_hit_th"])
    )
    same = F.col("_hit_id").eqNullSafe(docs[id_col]) & (F.col("_hit_th") == F.xxhash64(whole(docs[text_col])))
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    t = whole(docs[text_col])
    gaps = F.split(t, RAW_WORD, -1)
    own = F.array_remove(F.split(t, RAW_SEPARATORS, -1), "")
    kept = F.transform(
        own,
        lambda w, i: F.when(
            F.exists("_hit_spans", lambda s: (i >= s["start"]) & (i < s["end"])), F.lit("")
        ).otherwise(F.concat(F.get(gaps, i), w)),
    )
    cut = F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))
    joined = docs.join(found, same, "left")
    return joined.select(
        *[
            F.when(F.col("_hit_spans").isNull(), docs[c]).otherwise(cut).alias(c) if c == text_col else docs[c]
            for c in docs.columns
        ]
    )
