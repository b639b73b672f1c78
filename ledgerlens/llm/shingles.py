"""Words and word shingles as 64-bit numbers, one array per text."""

from __future__ import annotations

import numpy as np
import xxhash

#: Cached words of one Python worker; the cache starts anew beyond it.
WORD_CACHE = 100_000

# A-Z become a-z; every other byte stays.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


class _WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


_numbers = _WordNumbers()


def forget() -> None:
    """Empties the cache of this worker."""
    _numbers.clear()


def split_words(text: str, lower: bool = False) -> list[bytes]:
    """UTF-8 words between ASCII blanks."""
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.translate(LOWER) if lower else raw).split()


def word_numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_numbers.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of each number."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def windows(numbers: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp number of every run of ``size`` values, which must be spread already.

    Runs of 1, 2, 4, ... values are joined as the binary digits of ``size`` ask for, which
    needs a few passes over the array instead of one per value.
    """
    n = len(numbers) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total, done, block, width = None, 0, numbers, 1
    base = int(_BASE)
    while width <= size:
        if size & width:
            part = block[done : done + n]
            total = part.copy() if total is None else total * np.uint64(base) + part
            done += width
        if 2 * width <= size:
            block = block[:-width] * np.uint64(base) + block[width:]
        width *= 2
        base = base * base % (1 << 64)
    return mix(total)


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """Distinct shingles of the lower-cased words, ascending; a text of fewer words is one
    shingle, one without words has none."""
    numbers = word_numbers(split_words(text, lower=True))
    if not len(numbers):
        return numbers
    return np.unique(windows(numbers, min(size, len(numbers)))) if len(numbers) >= size else mix(
        windows(numbers, len(numbers)) + np.uint64(len(numbers))
    )
