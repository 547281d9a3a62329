"""Words and their tokens as arrays, for an encoder that meets most words again.

A word is found by a 64-bit hash and then compared, so that two words with
equal hashes are not confused. A word of usual length takes about 50 bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute

from .letters import utf8

#: Bytes of a word that its hash reads.
HASHED = 64
_POWERS = np.cumprod(np.full(HASHED, 0x9E3779B97F4A7C15, np.uint64))
_SIZE, _MIX = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of the size of each word and the first bytes of its UTF-8."""
    raw, edges = utf8(words)
    sizes = np.diff(edges)
    some = np.minimum(sizes, HASHED)
    stops = np.cumsum(some)
    within = np.arange(some.sum()) - np.repeat(stops - some, some)
    sums = np.zeros(len(within) + 1, np.uint64)
    np.cumsum((raw[np.repeat(edges[:-1], some) + within] + np.uint64(1)) * _POWERS[within], out=sums[1:])
    out = sums[stops] - sums[stops - some] + sizes.astype(np.uint64) * _SIZE
    out ^= out >> np.uint64(32)
    return out * _MIX


class WordStore:
    """``words`` and, as lists in the same rows, their ``tokens``."""

    def __init__(self, kind: np.dtype) -> None:
        self.words = pa.array([], pa.string())
        self.tokens = pa.ListArray.from_arrays(pa.array([0], pa.int32()), pa.array(np.empty(0, kind)))
        self.hashes, self.rows = np.empty(0, np.uint64), np.empty(0, np.int64)  # ascending hashes, and their rows
        self.turns, self.turn = np.empty(0, np.int64), 0  # when a row was used last

    def __len__(self) -> int:
        return len(self.words)

    def find(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The row of each word, -1 where it has none."""
        rows = np.full(len(words), -1)
        if len(self):
            place = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
            at = np.flatnonzero(self.hashes[place] == hashes)
            found = self.rows[place[at]]
            same = pa.compute.equal(self.words.take(pa.array(found)), words.take(pa.array(at))).to_numpy(zero_copy_only=False)
            rows[at[same]] = found[same]
            self.turns[found[same]] = self.turn
        return rows

    def add(self, words: pa.Array, hashes: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The new rows of ``words``, which have none yet; ``tokens`` of all of
        them in a row, and how many each one has."""
        rows = np.arange(len(self), len(self) + len(words))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(tokens))
        self.words, self.tokens = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.tokens, lists])
        self.turns = np.concatenate([self.turns, np.full(len(words), self.turn)])
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.rows = np.insert(self.hashes, at, hashes[order]), np.insert(self.rows, at, rows[order])
        return rows

    def trim(self, most: int, longest: int) -> None:
        """Drop words of over ``longest`` bytes, and of more than ``most`` words
        all but the half of that number that were used last. Rows change."""
        self.turn += 1
        usual = np.diff(utf8(self.words)[1]) <= longest
        if len(self) <= most and usual.all():
            return
        kept = np.flatnonzero(usual)
        if len(kept) > most:
            kept = np.sort(kept[np.argsort(-self.turns[kept], kind="stable")[: most // 2]])
        self.words, self.tokens, self.turns = self.words.take(pa.array(kept)), self.tokens.take(pa.array(kept)), self.turns[kept]
        place = np.full(len(usual), -1)
        place[kept] = np.arange(len(kept))
        rows = place[self.rows]
        self.hashes, self.rows = self.hashes[rows >= 0], rows[rows >= 0]
