"""Sets of word shingles as sorted 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words in hand before their shingles are hashed, and bytes of a text that are split at once.
AT_ONCE, PIECE = 1 << 15, 1 << 20
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about a megabyte that end between words; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end]
        at = end


class Shingler:
    """Distinct ``words``-word shingles: words are runs without white space (space, tab to carriage return), A-Z as a-z."""

    def __init__(self, words: int):
        self.words = words

    def word_hashes(self, data: bytes) -> np.ndarray:
        found = [np.fromiter(map(xxhash.xxh3_64_intdigest, split), dtype=np.uint64, count=len(split)) for split in (x.translate(LOWER).split() for x in pieces(data))]
        return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, dtype=np.uint64), *found])

    def sets(self, texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
        """The sorted set of each text, in order; without a word it is empty, with fewer than a shingle's the whole is one."""
        held, total = [], 0
        for text in texts:
            held.append(self.word_hashes(text or b""))
            total += len(held[-1])
            if total >= AT_ONCE or len(held) >= 1000:
                yield from self._hashed(held)
                held, total = [], 0
        yield from self._hashed(held)

    def _hashed(self, held: list[np.ndarray]) -> Iterator[np.ndarray]:
        if not held:
            return
        flat, n = np.concatenate(held), self.words
        with np.errstate(over="ignore"):
            all_ = self._windows(flat, n)
            at = 0
            for w in held:
                if len(w) >= n:
                    own = np.sort(all_[at : at + len(w) - n + 1])
                    yield own[np.append(True, own[1:] != own[:-1])]
                else:
                    yield self._windows(w, len(w))
                at += len(w)

    @staticmethod
    def _windows(w: np.ndarray, n: int) -> np.ndarray:
        count = len(w) - n + 1
        if not n or count < 1:
            return np.zeros(0, dtype=np.uint64)
        total = np.full(count, U(n))
        for i in range(n):
            total = total * U(0x9E3779B97F4A7C15) + w[i : i + count]
        return mix(total)


def binary_texts(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a binary column, one at a time."""
    return (x.as_py() for x in column)
