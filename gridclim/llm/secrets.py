"""Secret scans: character Markov models of random strings and of ordinary identifiers.

Two first-order models over characters are counted from labelled samples, and a candidate
token is a secret if the mean log-likelihood ratio per transition, random against ordinary,
passes a threshold. Three fixed patterns come first: assignments to names such as
``password``, access keys, and long hexadecimal strings; the models add what these miss.
All of it is column expressions. The ratios form one literal array of fixed size.

Spans are (start, end) in code points with exclusive end; the matches of a pattern are
found by cutting the text at them, so that the lengths of the pieces give the places.

Defined cases: a NULL or empty text has no spans. Rows are judged one by one, so repeated
rows give equal results. Without samples of a class, the models add nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole

ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a whole run of 32 or more, as runs are taken greedily
# A whole run of token characters, taken in one step; those with a digit and a letter are for the models to judge.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}+"
IDENTIFIER = r"[A-Za-z_-]{4,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SIZE = len(ALPHABET)
NO_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _running(lengths: Column) -> Column:
    """Running sums of a short array."""
    none = F.array().cast("array<int>")
    return F.aggregate(lengths, none, lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))))


def running_sums(lengths: Column, block: int = 256) -> Column:
    """Running sums of an array of any length, block by block, as appending copies an array."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / block).cast("int") - 1, F.lit(0))),
        lambda b: _running(F.slice(lengths, b * block + 1, F.lit(block))),
    )
    ends = lambda parts: _running(F.transform(parts, lambda p: F.coalesce(F.try_element_at(p, F.lit(-1)), F.lit(0))))
    shifted = lambda parts, e: F.zip_with(
        parts, F.concat(F.array(F.lit(0)), F.slice(e, F.lit(1), F.size(e) - 1)), lambda p, o: F.transform(p, lambda x: x + o)
    )
    return let(blocks, lambda parts: let(ends(parts), lambda e: F.flatten(shifted(parts, e))))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where a lambda repeats."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: Column, pattern: str) -> Column:
    """(start, match) of each leftmost match that does not overlap the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))  # without the one behind the last match
    both = F.zip_with(
        gaps, found, lambda g, m: F.struct((F.char_length(g) + F.char_length(m)).alias("step"), m.alias("m"))
    )
    placed = lambda x: F.zip_with(
        x, let(F.transform(x, lambda y: y["step"]), lambda v: running_sums(v)),
        lambda y, e: F.struct((e - F.char_length(y["m"])).alias("start"), y["m"].alias("m")),
    )
    return let(both, placed)


def _spans(text: Column, pattern: str, rank: int, kind: str, keep, there: Column) -> Column:
    spans = F.transform(
        F.filter(_pieces(text, pattern), lambda x: keep(x["m"])),
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            (x["start"] + F.char_length(x["m"])).alias("end"),
        ),
    )
    return F.when(there, spans).otherwise(F.array().cast(NO_SPANS))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the three patterns. Cheap tests come first, as most texts hold none."""
    sign = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    value = lambda m: F.regexp_extract(m, f"^{ASSIGN}$", 1)
    return {
        "assign": _spans(text, ASSIGN, 0, "assign", lambda m: F.char_length(value(m)) >= 8, sign & F.regexp_like(text, F.lit(ASSIGN))),
        "access": _spans(text, ACCESS, 1, "access", lambda m: F.char_length(m) >= 16, F.contains(text, F.lit("AKIA"))),
        "hex": _spans(text, HEX, 2, "hex", lambda m: F.lit(True), F.regexp_like(text, F.lit(HEX))),
    }


@dataclass(frozen=True)
class Models:
    """log P(next | previous, random) - log P(next | previous, ordinary), row by row."""

    ratios: tuple[float, ...]

    def mean_ratio(self, token: Column) -> Column:
        table = F.split(F.lit(" ".join(map(str, self.ratios))), " ").cast("array<double>")  # folded once
        # Characters first, so that no step has to walk through the token again.
        places = F.transform(F.split(token, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)

        def total(p: Column) -> Column:
            pairs = F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda a, b: F.get(table, a * SIZE + b))
            return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)

        return let(places, total) / (F.char_length(token) - 1)


def train(samples: DataFrame, *, text_col: str = "token", label_col: str = "random", smoothing: float = 0.5) -> Models:
    """Count character pairs of labelled strings; at most twice the squared alphabet reaches the driver."""
    t = F.col("t")
    pairs = (
        samples.select(F.col(text_col).alias("t"), F.col(label_col).cast("boolean").alias("random"))
        .where(F.col("random").isNotNull() & (F.char_length("t") > 1))
        .select("random", "t", F.explode_outer(F.sequence(F.lit(1), F.char_length("t") - 1)).alias("i"))
        .select("random", F.substring(t, F.col("i"), F.lit(2)).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()
    )
    counts = {True: [smoothing] * SIZE**2, False: [smoothing] * SIZE**2}
    seen = {True: 0, False: 0}
    for r in pairs:
        a, b = ALPHABET.find(r["pair"][0]), ALPHABET.find(r["pair"][1])
        if a >= 0 and b >= 0:
            counts[r["random"]][a * SIZE + b] += r["count"]
            seen[r["random"]] += r["count"]
    if not seen[True] or not seen[False]:
        return Models(tuple([0.0] * SIZE**2))
    rows = {k: [sum(v[a * SIZE : a * SIZE + SIZE]) for a in range(SIZE)] for k, v in counts.items()}
    return Models(
        tuple(
            round(math.log(counts[True][k] / rows[True][k // SIZE]) - math.log(counts[False][k] / rows[False][k // SIZE]), 4)
            for k in range(SIZE**2)
        )
    )


def samples(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(token, random) from the texts themselves: values of assignments, keys and hexadecimal
    strings are random, words and names in the same texts are ordinary."""
    t = F.col("t")
    random = F.concat(
        F.filter(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(1)), lambda m: F.char_length(m) >= 8),
        F.filter(F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)), lambda m: F.char_length(m) >= 16),
        F.regexp_extract_all(t, F.lit(HEX), F.lit(0)),
    )
    tagged = lambda a, label: F.transform(a, lambda m: F.struct(m.alias("token"), F.lit(label).alias("random")))
    return (
        docs.select(whole(text_col).alias("t"))
        .where(F.regexp_like("t", F.lit(f"{ASSIGN}|{ACCESS}|{HEX}")))
        .select(F.concat(tagged(random, True), tagged(F.regexp_extract_all(t, F.lit(IDENTIFIER), F.lit(0)), False)).alias("s"))
        .select(F.explode_outer("s").alias("s"))
        .select("s.*")
    )


def scan(docs: DataFrame, models: Models, *, text_col: str = "text", threshold: float = 0.25) -> DataFrame:
    """All columns of ``docs`` plus ``assign``, ``access``, ``hex``, ``markov`` and ``secrets``.

    ``markov`` holds tokens of 16 or more characters with letters and digits whose mean
    log-likelihood ratio is above ``threshold`` and that touch no span of the patterns.
    ``secrets`` holds all spans by start, then kind as listed. Columns of these names that
    ``docs`` already has are replaced.
    """
    text = whole(text_col)
    base = base_spans(text)
    named = docs.withColumns(base)
    token = lambda m: F.regexp_like(m, F.lit("[0-9]")) & F.regexp_like(m, F.lit("[A-Za-z]")) & (models.mean_ratio(m) > threshold)
    maybe = _spans(text, TOKEN, 3, "markov", token, F.regexp_like(text, F.lit(TOKEN)))
    listed = F.concat("assign", "access", "hex")
    return (
        named.withColumn("markov", maybe)
        .withColumn(
            "markov",
            F.filter("markov", lambda x: ~F.exists(listed, lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))),
        )
        .withColumn("secrets", F.array_sort(F.concat(listed, F.col("markov"))))
    )


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests per document, with models trained on the documents' own samples."""
    found = scan(docs.select("doc_id", "text"), train(samples(docs)))
    n = lambda c: F.size(c).cast("bigint").alias(f"n_{c}")
    base = F.array_sort(F.concat("assign", "access", "hex"))
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), n("markov"),
        F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("secrets")).alias("spans"),
    )


def redact(docs: DataFrame, models: Models, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced; overlapping spans are replaced as one."""
    found = scan(docs.withColumn("_kept", F.struct(*docs.columns)).select("_kept", text_col), models, text_col=text_col)
    t = whole(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        inside = s["start"] < a["at"]
        gap = F.substring(t, a["at"] + 1, s["start"] - a["at"])
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(inside, a["out"]).otherwise(F.concat(a["out"], gap, F.lit(mark))).alias("out"),
        )

    clean = F.aggregate("secrets", start, step, lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.char_length(t))))
    return found.select(
        *[
            F.when(F.size("secrets") > 0, clean).otherwise(F.col(f"_kept.`{c}`")).alias(c) if c == text_col else F.col(f"_kept.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
