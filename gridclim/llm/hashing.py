"""Vectorised 64-bit hashing of bytes and words for Arrow-batched code."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_rng = np.random.default_rng(20240229)  # any fixed seed: the same values in every task
VALUES = _rng.integers(1, 2**63, size=(2, 256), dtype=np.uint64)
BASES = (_rng.integers(1, 2**62, size=2, dtype=np.uint64) << _U(1)) | _U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of the two bases and of their inverses, as far as they were needed."""

    def __init__(self) -> None:
        self._have: dict[tuple[int, bool], np.ndarray] = {}

    def get(self, which: int, n: int, inverse: bool = False) -> np.ndarray:
        have = self._have.get((which, inverse))
        if have is None or len(have) < n:
            base = int(BASES[which])
            if inverse:
                base = pow(base, -1, 2**64)
            steps = np.full(max(n, 1 << 14), base, dtype=np.uint64)
            steps[0] = 1
            have = self._have[which, inverse] = np.cumprod(steps, dtype=np.uint64)
        return have[:n]


POWERS = Powers()


class Prefix:
    """Hashes of any substring of a byte array from one running sum."""

    def __init__(self, data: np.ndarray, which: int) -> None:
        self.which = which
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(VALUES[which][data] * POWERS.get(which, len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = POWERS.get(self.which, len(self.sums), inverse=True)
        return mix((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length."""
        down = POWERS.get(self.which, len(self.sums), inverse=True)
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * down[:n])


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words between blanks and control spaces, A-Z in lower case."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = ~SPACE[data]
    if not inside.any():
        return np.zeros(0, dtype=np.uint64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    kept = LOWER[data[inside]]
    begin = (np.cumsum(inside) - 1)[starts]  # of each word among the kept bytes
    lengths = np.diff(np.append(begin, len(kept)))
    place = np.arange(len(kept)) - np.repeat(begin, lengths)
    terms = VALUES[0][kept] * POWERS.get(0, int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, begin) + lengths.astype(np.uint64))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``words`` words.

    A text of fewer words, but not none, is one shingle.
    """
    w = word_hashes(text)
    if not len(w):
        return w
    words = min(words, len(w))
    total = np.full(len(w) - words + 1, _U(words))
    for k in range(words):
        total = mix(total * BASES[0] + w[k : len(w) - words + 1 + k])
    return np.unique(total)
