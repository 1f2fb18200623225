"""SentencePiece encoding and decoding by a max-plus scan.

A text is cut into the pieces of a vocabulary so that their scores add up to the most.
The best path up to a place is a maximum of sums, so the effect of a stretch of text is a
matrix in max-plus arithmetic: row s says that the piece across the stretch's start
reaches s characters into it, column t the same for its end. Such matrices combine
associatively. Giant documents are split into chunks of fixed size; each gives its matrix,
a scan over a document's matrices finds the best state at every boundary, and each chunk then
traces its own best path between the states at its two ends, independently of the others.

Where no piece holds two neighbouring characters together, a cut between them is certain, as
in front of every run of blanks. A matrix of a stretch with a certain cut is a sum of a row
vector, a middle and a column vector. Segments between certain cuts repeat, and their paths
are remembered.

Characters without a piece become byte pieces. Among equal scores a longer last piece wins;
across a chunk boundary another of several equal paths may be found.

The vocabulary is read from a model file and never trained. Scores that are log
probabilities are taken as they are. The scores of a file made for pair merging are merge
ranks, whose sums mean nothing; there the pieces get the log probabilities of Zipf's law for
their rank. Merging in rank order, as such a file's own encoder does, gives other pieces for
some words.

Defined cases: NULL and empty texts have no pieces. Decoding undoes encoding exactly, with
leading, repeated and trailing blanks, control characters and the mark character itself. Ids
that are no pieces of the vocabulary decode to nothing. Rows that repeat are encoded alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .common import keyed, pieces_of, share, utf8

MARK = "▁"  # stands for a blank in pieces
UNKNOWN_PENALTY = 10.0
FEW = 591  # code points below are told apart when certain cuts are looked for
NONE = -np.inf
KEPT = 64  # characters of a segment whose path is remembered
PART = 1 << 18  # bytes of text that are cut at once; the arrays of their places take many times as much


@dataclass
class Vocabulary:
    pieces: dict[str, tuple[float, int]]  # with blanks instead of marks
    byte_ids: list[int]
    unknown: float
    size: int
    longest: int
    memory: dict[str, tuple[float, list[int]]] = field(default_factory=dict)
    packed: dict[str, bytes] = field(default_factory=dict)  # ids of segments, four bytes each
    remember: int = 200_000
    joined: np.ndarray = field(init=False)  # which characters stand next to each other in a piece
    # What pieces start with, as a tree: nodes are numbered by length and then in order, 0 is the empty start.
    # A node's place in ``edges`` is its number less 1; an edge is parent << 21 | character.
    edges: np.ndarray = field(init=False)
    node_score: np.ndarray = field(init=False)
    node_id: np.ndarray = field(init=False)  # -1 if the node is no piece

    def __post_init__(self) -> None:
        starts = sorted({piece[:k] for piece in self.pieces for k in range(1, len(piece) + 1)}, key=lambda p: (len(p), p))
        number = {"": 0} | {p: k for k, p in enumerate(starts, 1)}
        self.edges = np.array([number[p[:-1]] << 21 | ord(p[-1]) for p in starts], dtype=np.int64)
        found = [self.pieces.get(p, (NONE, -1)) for p in ("", *starts)]
        self.node_score = np.array([f[0] for f in found])
        self.node_id = np.array([f[1] for f in found], dtype=np.int32)
        self.joined = np.zeros((FEW + 1, FEW + 1), dtype=bool)
        for piece in self.pieces:
            for a, b in zip(piece, piece[1:]):
                self.joined[min(ord(a), FEW), min(ord(b), FEW)] = True
        self.joined[FEW, :] = self.joined[:, FEW] = True  # not told apart, so never a certain cut

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Whole numbers as scores are taken for ranks."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece.replace(MARK, " ")] = (model.get_score(i), i)
        if all(score == int(score) for score, _ in pieces.values()):
            total = sum(1 / k for k in range(1, len(pieces) + 1))
            by_id = sorted(pieces.items(), key=lambda p: p[1][1])
            pieces = {p: (-float(np.log(k * total)), i) for k, (p, (_, i)) in enumerate(by_id, 1)}
        if any(" " in p.lstrip(" ") for p in pieces):
            raise ValueError("a piece has a blank behind another character")
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        return cls(
            pieces,
            [byte_ids[b] for b in range(256)],
            min(score for score, _ in pieces.values()) - UNKNOWN_PENALTY,
            model.get_piece_size(),
            max(map(len, pieces)),
        )

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memory": {}, "packed": {}}

    def steps(self, s: str, i: int, end: int) -> Iterator[tuple[int, float]]:
        """(end, score) of each piece that starts at i."""
        get, single = self.pieces.get, False
        for j in range(i + 1, min(end, i + self.longest) + 1):
            found = get(s[i:j])
            if found is not None:
                single |= j == i + 1
                yield j, found[0]
        if not single:
            yield i + 1, self.unknown

    def ids_of(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        return [found[1]] if found else [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]

    def path(self, s: str, start: int, end: int, bound: int | None = None) -> tuple[float, list[int]]:
        """Score and ids of the best path from start to end; only its last piece crosses ``bound``."""
        bound = end if bound is None else bound
        best, back = [NONE] * (end + 1), [0] * (end + 1)
        best[start] = 0.0
        for i in range(start, min(bound, end)):
            if best[i] == NONE:
                continue
            for j, score in self.steps(s, i, end):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, i
        if best[end] == NONE:
            return NONE, []
        cuts, at = [end], end
        while at > start:
            at = back[at]
            cuts.append(at)
        cuts.reverse()
        return best[end], [x for a, b in zip(cuts, cuts[1:]) for x in self.ids_of(s[a:b])]

    def word(self, w: str) -> tuple[float, list[int]]:
        """Score and ids of a whole word; the first ``remember`` words met are kept."""
        found = self.memory.get(w)
        if found is None:
            found = self._word(w)
            if len(w) <= KEPT and len(self.memory) < self.remember:
                self.memory[w] = found
        return found

    def children(self, nodes: np.ndarray | int, points: np.ndarray) -> np.ndarray:
        """The node that each character leads to, 0 if there is none."""
        wanted = nodes << 21 | points
        at = np.searchsorted(self.edges, wanted)
        return np.where(self.edges[np.minimum(at, len(self.edges) - 1)] == wanted, at + 1, 0)

    def words(self, words: list[str]) -> list[bytes]:
        """The ids that :meth:`_word` gives for each word, four bytes each, all words side by side.

        A word of n characters has n + 1 places. Steps that start at the same distance from their words'
        starts lead to different places, so one array operation takes them all. Long words and those
        with a character that is no piece go one by one.
        """
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        of, stops = np.repeat(np.arange(len(words)), lengths), np.cumsum(lengths)
        first = self.children(0, points)
        alone = lengths > KEPT
        alone[of[self.node_id[first] < 0]] = True
        offset = np.arange(len(points)) - (stops - lengths)[of]
        left = lengths[of] - offset
        at = np.flatnonzero(~alone[of])
        node, steps = first[at], []
        for size in range(1, self.longest + 1):
            ends = self.node_id[node] >= 0
            steps.append((at[ends], np.full(int(ends.sum()), size), node[ends]))
            more = left[at] > size
            at, node = at[more], node[more]
            node = self.children(node, points[at + size])
            at, node = at[node > 0], node[node > 0]
        at, size, node = (np.concatenate(x) for x in zip(*steps))
        order = np.argsort(offset[at].astype(np.int16), kind="stable")
        at, size, node = at[order], size[order], node[order]
        score, piece, source = self.node_score[node], self.node_id[node], at + of[at]
        starts, stops = stops - lengths + np.arange(len(words)), stops + np.arange(len(words))
        best, back = np.full(len(points) + len(words), NONE), np.zeros(len(points) + len(words), dtype=np.int64)
        best[starts], ids = 0.0, np.zeros(len(best), dtype=np.int32)
        bounds = np.searchsorted(offset[at], np.arange(KEPT + 1))
        for a, b in zip(bounds, bounds[1:]):
            to, total = source[a:b] + size[a:b], best[source[a:b]] + score[a:b]
            better = total > best[to]
            to = to[better]
            best[to], back[to], ids[to] = total[better], source[a:b][better], piece[a:b][better]
        on = np.zeros(len(best), dtype=bool)
        place, floor = stops[~alone], starts[~alone]
        while len(place):
            on[place] = True
            place = back[place]
            place, floor = place[place > floor], floor[place > floor]
        flat, before = ids[on].tobytes(), 4 * np.append(0, np.cumsum(on))
        spans = zip(words, alone.tolist(), before[starts].tolist(), before[stops + 1].tolist())
        return [np.array(self._word(w)[1], dtype=np.int32).tobytes() if one else flat[a:b] for w, one, a, b in spans]

    def _word(self, s: str) -> tuple[float, list[int]]:
        """What :meth:`path` gives for the whole of ``s``, in one tight loop."""
        get, longest, n = self.pieces.get, self.longest, len(s)
        best, back, ids = [NONE] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            base = best[i]
            j = i + 1
            found = get(s[i:j])
            score, piece = found if found is not None else (self.unknown, -1)
            if base + score > best[j]:
                best[j], back[j], ids[j] = base + score, i, piece
            for j in range(i + 2, min(n, i + longest) + 1):
                found = get(s[i:j])
                if found is not None and base + found[0] > best[j]:
                    best[j], back[j], ids[j] = base + found[0], i, found[1]
        out, at = [], n
        while at:
            if ids[at] >= 0:
                out.append(ids[at])
            else:
                out.extend(reversed(self.ids_of(s[back[at] : at])))
            at = back[at]
        out.reverse()
        return best[n], out

    def segments(self, s: str) -> list[str]:
        """The text cut wherever no piece can hold the characters on both sides."""
        points = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = np.minimum(points, FEW)
        at = (np.flatnonzero(~self.joined[kinds[:-1], kinds[1:]]) + 1).tolist()
        return [s[a:b] for a, b in zip([0, *at], [*at, len(s)])]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        known, word = self.memory.get, self.word
        return [x for w in self.segments(" " + text) for x in (known(w) or word(w))[1]]

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """What :meth:`encode` gives for each text of a column without NULLs; each distinct segment is looked up once."""
        blank = pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar(""))
        data, ends = utf8(pc.if_else(pc.equal(texts, ""), "", blank))
        at = np.flatnonzero((data & 0xC0) != 0x80)
        kinds = np.minimum(np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32), FEW)
        cut = np.ones(len(at), dtype=bool)
        cut[1:] = ~self.joined[kinds[:-1], kinds[1:]]
        edges = np.searchsorted(at, ends)
        cut[edges[edges < len(at)]] = True
        starts = at[cut]
        bounds = np.append(starts, len(data)).astype(np.int32)
        found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
        words = found.dictionary.to_pylist()
        held = [self.packed.get(w) for w in words]
        new = [k for k, ids in enumerate(held) if ids is None]
        for k, ids in zip(new, self.words([words[k] for k in new])):
            held[k] = ids
            if len(words[k]) <= KEPT and len(self.packed) < self.remember:
                self.packed[words[k]] = ids
        sizes = np.fromiter(map(len, held), dtype=np.int64, count=len(held)) // 4
        places, flat = np.append(0, np.cumsum(sizes)), np.frombuffer(b"".join(held), dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(flat, pa.int32()))
        token_ends = np.append(0, np.cumsum(sizes[found.indices.to_numpy(zero_copy_only=False)]))[np.searchsorted(starts, ends)]
        return pa.ListArray.from_arrays(pa.array(token_ends, pa.int32()), ids.take(found.indices).flatten())

    def decode(self, ids: list[int], names: list[str | int]) -> str:
        """``names`` as from :meth:`names`: a text per id, or the value of a byte piece."""
        parts, raw = [], bytearray()
        for i in ids:
            n = names[i] if 0 <= i < len(names) else ""
            if isinstance(n, int):
                raw.append(n)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "surrogatepass"))
                raw = bytearray()
            parts.append(n)
        if raw:
            parts.append(raw.decode("utf-8", "surrogatepass"))
        text = "".join(parts)
        return text[1:] if text.startswith(" ") else text

    def decoder(self) -> Callable[[pa.ListArray], pa.StringArray]:
        """What :meth:`decode` gives for each list of a column, where NULL counts as empty."""
        pieces = pa.array([n.encode() if isinstance(n, str) else bytes([n]) for n in self.names()] + [b""], pa.binary())

        def run(lists: pa.ListArray) -> pa.StringArray:
            lists = lists.fill_null([]) if lists.null_count else lists
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
            ids = np.where((ids < 0) | (ids >= self.size), self.size, ids)
            _, places, raw = pieces.take(pa.array(ids)).buffers()
            raw, places = raw.to_pybytes() if raw else b"", np.frombuffer(places, dtype=np.int32)[ends].tolist() if len(ids) else ends
            return pa.array([raw[a:b].decode("utf-8", "surrogatepass").removeprefix(" ") for a, b in zip(places, places[1:])], pa.string())

        return run

    def names(self) -> list[str | int]:
        out: list[str | int] = [""] * self.size
        for piece, (_, i) in self.pieces.items():
            out[i] = piece
        for b, i in enumerate(self.byte_ids):
            out[i] = b
        return out

    # Chunks: ``s`` is the chunk and what a piece may reach behind it, ``n`` the chunk's own
    # length, ``before`` the character in front of it.

    def cuts(self, s: str, n: int, before: str) -> list[int]:
        """Certain cuts in a chunk."""
        return [
            m.start() for m in re.finditer(" +", s[:n]) if m.start() > 0 or (before and before != " ")
        ]

    def transfer(self, s: str, n: int, before: str) -> np.ndarray:
        """The chunk's max-plus matrix."""
        size = self.longest
        out = np.full((size, size), NONE)
        cuts = self.cuts(s, n, before)
        first, last = (cuts[0], cuts[-1]) if cuts else (None, None)
        if first is not None:
            middle = sum(self.word(w)[0] for w in self.segments(s[first:last])) if last > first else 0.0
            into = np.array([self.path(s, a, first)[0] if a <= first else NONE for a in range(size)])
            onward = self.ends(s, last, n)
            return into[:, None] + middle + onward[None, :]
        for a in range(min(size, n + 1)):
            out[a] = self.ends(s, a, n)
        return out

    def ends(self, s: str, start: int, n: int) -> np.ndarray:
        """Best scores from a cut to each state at the chunk's end."""
        out = np.full(self.longest, NONE)
        best = {start: 0.0}
        for i in range(start, n):
            if i not in best:
                continue
            for j, score in self.steps(s, i, len(s)):
                if best[i] + score > best.get(j, NONE):
                    best[j] = best[i] + score
        for t in range(self.longest):
            out[t] = best.get(n + t, NONE)
        return out

    def trace(self, s: str, n: int, before: str, entry: int, leave: int) -> list[int]:
        """The ids of a chunk's best path between two states."""
        cuts = [c for c in self.cuts(s, n, before) if c >= entry]
        if not cuts:
            return self.path(s, entry, n + leave, n)[1]
        ids = list(self.path(s, entry, cuts[0])[1])
        for w in self.segments(s[cuts[0] : cuts[-1]]) if cuts[-1] > cuts[0] else ():
            ids.extend(self.word(w)[1])
        return ids + self.path(s, cuts[-1], n + leave, n)[1]


def scan(matrices: list[np.ndarray]) -> list[int]:
    """The best state at each boundary, from 0 in front to 0 behind."""
    size = matrices[0].shape[0]
    score = np.full(size, NONE)
    score[0] = 0.0
    back = []
    for m in matrices:
        total = score[:, None] + m
        back.append(total.argmax(axis=0))
        score = total.max(axis=0)
    states = [0]
    for b in reversed(back):
        states.append(int(b[states[-1]]))
    return states[::-1]


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, as ids take much more room than their text while they are gathered."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)


def _lists(values: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.fromiter(chain.from_iterable(values), dtype=np.int32, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = 1 << 16,
    decoded: str | None = None,
) -> DataFrame:
    """(id, th, ids) for each row; th is the hash of the text that :func:`keyed` gives.

    ``decoded`` names a further column, the text that the ids decode to. It is what :func:`decode`
    adds, but short texts are decoded by the Python worker that has encoded them, so that a task
    has one of them, not two.
    """
    if chunk < 2 * vocabulary.longest:
        raise ValueError("a chunk must be longer than any piece")
    shared = share(docs.sparkSession, vocabulary)
    reach = vocabulary.longest - 1  # characters behind a chunk that its pieces may need
    base = keyed(docs, id_col, text_col)
    kind = base.schema["id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared()
        back = v.decoder() if decoded else None
        for batch in pieces_of(batches, 2, PART):
            ids = v.encode_all(batch.column(2))
            found = [ids, back(ids)] if back else [ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=["id", "th", "ids", decoded][: 2 + len(found)])

    columns = f"id {kind}, th long, ids array<int>" + (f", `{decoded}` string" if decoded else "")
    small = base.where(F.char_length("text") < chunk).mapInArrow(whole, columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                s = " " + batch.column(2)[i].as_py()
                starts = range(0, len(s), chunk)
                at = pa.array([i] * len(starts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), batch.column(1).take(at), pa.array(range(len(starts)), pa.int64()),
                        pa.array([s[a - 1 : a] if a else "" for a in starts], pa.string()),
                        pa.array([s[a : a + chunk + reach] for a in starts], pa.string()),
                        pa.array([min(chunk, len(s) - a) for a in starts], pa.int64()),
                    ],
                    names=["id", "th", "k", "before", "s", "n"],
                )

    giants = (
        base.where(F.char_length("text") >= chunk).groupBy("id", "th").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    )
    pieces = f"id {kind}, th long, k long, before string, s string, n long"
    chunks = materialise(giants.select("id", "th", "text").mapInArrow(cut, pieces).repartition("th", "k"))

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared()
        for batch in batches:
            found = [v.transfer(s.as_py(), n.as_py(), b.as_py()).ravel() for b, s, n in zip(*batch.columns[3:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.list_(pa.float64()))], names=["id", "th", "k", "m"]
            )

    def states(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("k")
        size = int(np.sqrt(len(table["m"].iloc[0])))
        found = scan([np.asarray(m).reshape(size, size) for m in table["m"]])
        return pd.DataFrame({"id": table["id"], "th": table["th"], "k": table["k"], "entry": found[:-1], "leave": found[1:]})

    # One group holds a document's matrices: 2 KB for each chunk.
    ends = (
        chunks.mapInArrow(matrix, f"id {kind}, th long, k long, m array<double>")
        .groupBy("id", "th")
        .applyInPandas(states, f"id {kind}, th long, k long, entry int, leave int")
        .select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("k").alias("_k"), "entry", "leave")
    )

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared()
        for batch in batches:
            ids = [
                v.trace(s.as_py(), n.as_py(), b.as_py(), e.as_py(), x.as_py()) for b, s, n, e, x in zip(*batch.columns[3:])
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _lists(ids)], names=["id", "th", "k", "ids"])

    same = chunks["id"].eqNullSafe(F.col("_id")) & (chunks["th"] == F.col("_th")) & (chunks["k"] == F.col("_k"))
    traced = (
        chunks.join(ends, same)
        .select("id", "th", "k", "before", "s", "n", "entry", "leave")
        .mapInArrow(trace, f"id {kind}, th long, k long, ids array<int>")
        .groupBy("id", "th")
        .agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))
        .select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.flatten("parts.ids").alias("ids"))
    )
    copies = giants.select("id", "th", "copies")
    large = (
        copies.join(traced, copies["id"].eqNullSafe(F.col("_id")) & (copies["th"] == F.col("_th")))
        .select("id", "th", "ids", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy"))
        .drop("_copy")
    )
    return small.union(decode(large, vocabulary, text_col=decoded) if decoded else large)


def decode(encoded: DataFrame, vocabulary: Vocabulary, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the text of the ids; NULL ids decode to an empty text."""
    shared = share(encoded.sparkSession, vocabulary)
    kept = [c for c in encoded.columns if c != text_col]
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = shared().decoder()
        for batch in _parts(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, back(batch.column(at))], names=[*kept, text_col])

    out = encoded.select(*kept)
    return out.mapInArrow(run, T.StructType([*out.schema.fields, T.StructField(text_col, T.StringType())]))


def report(docs: DataFrame, vocabulary: Vocabulary, **options) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    return encode(docs, vocabulary, decoded="decoded", **options).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.xxhash64("decoded") == F.col("th")).alias("round_trip"),
    )
