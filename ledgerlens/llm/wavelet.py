"""A wavelet matrix: a sequence of numbers as bit planes with rank and select.

Numbers are coded by falling frequency, so that the upper planes are almost all zeros and
compress well. Plane by plane, from the top bit down, the sequence is parted into those with
a zero and those with a one, each in order. A plane keeps its bits in chunks that are
compressed one by one, and the count of ones in front of each chunk; a rank or a select
opens one chunk.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import zstandard

#: Bits of a chunk.
CHUNK = 1 << 16
#: Numbers below this are counted in a table over all of them.
TABLE = 1 << 22


@dataclass
class Plane:
    """Bits of one level. ``ones`` counts those in front of each chunk, ``ends`` says where
    the chunks end in ``body``; ``zeros`` is the number of zeros."""

    n: int
    zeros: int
    ones: np.ndarray
    ends: np.ndarray
    body: bytes
    _open: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict, repr=False)

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        total = np.add.reduceat(bits, np.arange(0, n, CHUNK), dtype=np.int64)
        raw, small = memoryview(packed), zstandard.ZstdCompressor(level=1)
        parts = []
        for at in range(0, len(packed), CHUNK // 8):
            part = raw[at : at + CHUNK // 8]
            squeezed = small.compress(part)
            parts.append(squeezed if len(squeezed) < len(part) else part)
        ones = np.cumsum(total) - total
        return cls(n, n - int(total.sum()), ones, np.cumsum([len(p) for p in parts]), b"".join(parts))

    def _bytes(self, chunk: int) -> bytes:
        begin = int(self.ends[chunk - 1]) if chunk else 0
        part = self.body[begin : int(self.ends[chunk])]
        size = -(-min(CHUNK, self.n - chunk * CHUNK) // 8)
        return part if len(part) == size else zstandard.ZstdDecompressor().decompress(part, max_output_size=size)

    def bits(self) -> np.ndarray:
        """All bits, as booleans."""
        packed = np.frombuffer(b"".join(self._bytes(c) for c in range(len(self.ends))), dtype=np.uint8)
        return np.unpackbits(packed, count=self.n, bitorder="little").view(bool)

    def _chunk(self, chunk: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a chunk and the ones in front of each."""
        if chunk not in self._open:
            if len(self._open) >= 64:
                self._open.clear()
            count = min(CHUNK, self.n - chunk * CHUNK)
            bits = np.unpackbits(np.frombuffer(self._bytes(chunk), dtype=np.uint8), count=count, bitorder="little")
            self._open[chunk] = bits, np.r_[0, np.cumsum(bits, dtype=np.int64)]
        return self._open[chunk]

    def look(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bit at each place (0 at the end) and the ones in front of it."""
        bit, rank = np.zeros(len(places), dtype=np.int64), np.full(len(places), self.n - self.zeros, dtype=np.int64)
        for chunk in np.unique(places[places < self.n] // CHUNK).tolist():
            here = np.flatnonzero((places // CHUNK == chunk) & (places < self.n))
            bits, before = self._chunk(chunk)
            inside = places[here] - chunk * CHUNK
            bit[here], rank[here] = bits[inside], self.ones[chunk] + before[inside]
        return bit, rank

    def select(self, numbers: np.ndarray, bit: int) -> np.ndarray:
        """Places of the given (from 0) ones or zeros."""
        before = self.ones if bit else np.arange(len(self.ones)) * CHUNK - self.ones
        places = np.empty(len(numbers), dtype=np.int64)
        chunks = np.searchsorted(before, numbers, side="right") - 1
        for chunk in np.unique(chunks).tolist():
            here = chunks == chunk
            found = np.flatnonzero(self._chunk(chunk)[0] == bit)
            places[here] = chunk * CHUNK + found[numbers[here] - before[chunk]]
        return places


@dataclass
class WaveletMatrix:
    """``alphabet`` holds the number of each code, ``counts`` how often it occurs."""

    n: int
    alphabet: np.ndarray
    counts: np.ndarray
    planes: list[Plane]

    @classmethod
    def of(cls, numbers: np.ndarray) -> WaveletMatrix:
        """Of unsigned 32-bit numbers."""
        if len(numbers) and int(numbers.max()) < TABLE:
            times = np.bincount(numbers)
            found = np.flatnonzero(times)
            order = np.argsort(-times[found], kind="stable")
            alphabet, counts = found[order], times[found][order]
            code_of = np.zeros(len(times), dtype=np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
            code_of[alphabet] = np.arange(len(alphabet))
            codes = code_of[numbers]
        else:
            found, codes, times = np.unique(numbers, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), dtype=np.uint32)
            place[order] = np.arange(len(order))
            alphabet, counts, codes = found[order], times[order], place[codes]
        levels = max(1, (len(alphabet) - 1).bit_length()) if len(alphabet) else 0
        planes = []
        for level in reversed(range(levels)):
            bits = (codes >> level & 1).astype(bool)
            planes.append(Plane.of(bits))
            if level:
                codes = np.concatenate([codes[~bits], codes[bits]])
        return cls(len(numbers), alphabet.astype(np.int64), counts.astype(np.int64), planes)

    def numbers(self) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane up."""
        codes = np.zeros(self.n, dtype=np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for level, plane in enumerate(reversed(self.planes)):
            bits = plane.bits()
            merged = np.empty_like(codes)
            merged[~bits] = codes[: plane.zeros]
            merged[bits] = codes[plane.zeros :] | codes.dtype.type(1 << level)
            codes = merged
        return self.alphabet.astype(np.uint32)[codes] if self.n else np.empty(0, dtype=np.uint32)

    def access(self, places: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        at, code = np.asarray(places, dtype=np.int64), np.zeros(len(places), dtype=np.int64)
        for plane in self.planes:
            bit, rank = plane.look(at)
            code = code << 1 | bit
            at = np.where(bit == 1, plane.zeros + rank, at - rank)
        return self.alphabet[code]

    def _bits(self, number: int) -> list[int] | None:
        code = np.flatnonzero(self.alphabet == number)
        return None if not len(code) else [int(code[0]) >> level & 1 for level in reversed(range(len(self.planes)))]

    def rank(self, number: int, places: np.ndarray) -> np.ndarray:
        """How often the number occurs in front of each place."""
        bits, places = self._bits(number), np.asarray(places, dtype=np.int64)
        if bits is None:
            return np.zeros(len(places), dtype=np.int64)
        at = np.r_[0, places]
        for plane, bit in zip(self.planes, bits, strict=True):
            rank = plane.look(at)[1]
            at = plane.zeros + rank if bit else at - rank
        return at[1:] - at[0]

    def select(self, number: int, which: np.ndarray | None = None) -> np.ndarray:
        """Places of the given (from 0; all) occurrences of the number."""
        bits = self._bits(number)
        if bits is None:
            return np.empty(0, dtype=np.int64)
        low = np.zeros(1, dtype=np.int64)
        for plane, bit in zip(self.planes, bits, strict=True):
            rank = plane.look(low)[1]
            low = plane.zeros + rank if bit else low - rank
        total = int(self.counts[np.flatnonzero(self.alphabet == number)[0]])
        at = low[0] + (np.arange(total) if which is None else np.asarray(which, dtype=np.int64))
        for plane, bit in zip(reversed(self.planes), reversed(bits), strict=True):
            at = plane.select(at - plane.zeros if bit else at, bit)
        return at
