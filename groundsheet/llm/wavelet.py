"""Token ids as wavelet matrices, one per shard.

A wavelet matrix holds a sequence as bit planes, highest bit first.  Each plane is followed by a
stable partition of the sequence by that bit, so rank on the planes answers access, count and
select without decoding the sequence.

Format of a payload (little-endian): magic ``WM01``, u64 length, u32 number of planes, per plane
u64 zeros and u32 compressed length, then the planes as zstandard frames of ``packbits`` bytes.
Ranks are rebuilt per plane from byte popcounts when the plane is first used.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WM01"


def _kind(planes: int) -> type:
    return np.uint16 if planes <= 16 else np.uint32


def build(ids: np.ndarray, planes: int) -> bytes:
    """Payload of ``ids``, unsigned numbers below ``2 ** planes``."""
    level, head, bodies = np.asarray(ids, _kind(planes)), [], []
    press = zstandard.ZstdCompressor(level=1)
    for plane in range(planes):
        bits = (level & level.dtype.type(1 << (planes - 1 - plane))) != 0
        body = press.compress(np.packbits(bits).tobytes())
        left = level[~bits]
        head.append(struct.pack("<QI", len(left), len(body)))
        bodies.append(body)
        level = np.concatenate([left, level[bits]])
    return b"".join([MAGIC, struct.pack("<QI", len(level), planes), *head, *bodies])


class WaveletMatrix:
    """Reader of one payload; a plane is decompressed when it is first needed."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("no wavelet matrix")
        self.length, self.planes = struct.unpack_from("<QI", payload, 4)
        at = 16 + 12 * self.planes
        self._zeros, self._frames = [], []
        for plane in range(self.planes):
            zeros, size = struct.unpack_from("<QI", payload, 16 + 12 * plane)
            self._zeros.append(zeros)
            self._frames.append(payload[at : at + size])
            at += size
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return self.length

    def _plane(self, plane: int) -> tuple[np.ndarray, np.ndarray]:
        if plane not in self._open:
            packed = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._frames[plane]), np.uint8)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self._open[plane] = packed, before
        return self._open[plane]

    def _ones(self, plane: int, at: int) -> int:
        """Set bits before position ``at`` of a plane."""
        packed, before = self._plane(plane)
        byte, bit = divmod(at, 8)
        return int(before[byte]) + (int(packed[byte]) >> (8 - bit)).bit_count() if bit else int(before[byte])

    def access(self, at: int) -> int:
        """Token at a position."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        value = 0
        for plane in range(self.planes):
            ones = self._ones(plane, at)
            bit = self._ones(plane, at + 1) - ones
            value = value << 1 | bit
            at = self._zeros[plane] + ones if bit else at - ones
        return value

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        low, high = 0, stop
        for plane in range(self.planes):
            a, b = self._ones(plane, low), self._ones(plane, high)
            if token >> (self.planes - 1 - plane) & 1:
                low, high = self._zeros[plane] + a, self._zeros[plane] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token in ``[start, stop)``."""
        stop = self.length if stop is None else min(stop, self.length)
        if token < 0 or token >> self.planes or start >= stop:
            return 0
        (a, b), (c, d) = self._range(token, start), self._range(token, stop)
        return (d - c) - (b - a)

    def _select(self, plane: int, bit: bool, nth: int) -> int:
        packed, before = self._plane(plane)
        seen = before if bit else 8 * np.arange(len(before)) - before
        byte = int(np.searchsorted(seen, nth, side="right")) - 1
        left = nth - int(seen[byte])
        bits = np.unpackbits(packed[byte : byte + 1])
        return 8 * byte + int(np.flatnonzero(bits == bit)[left])

    def select(self, token: int, nth: int) -> int:
        """Position of the ``nth`` occurrence of a token, from 0."""
        if nth < 0 or token < 0 or token >> self.planes:
            raise IndexError(nth)
        low, high = self._range(token, self.length)
        if nth >= high - low:
            raise IndexError(nth)
        at = low + nth
        for plane in reversed(range(self.planes)):
            bit = bool(token >> (self.planes - 1 - plane) & 1)
            at = self._select(plane, bit, at - self._zeros[plane] if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """The whole sequence, by undoing the partitions from the last plane up."""
        level = np.zeros(self.length, _kind(self.planes))
        for plane in reversed(range(self.planes)):
            packed = zstandard.ZstdDecompressor().decompress(self._frames[plane])
            bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.length).view(bool)
            zeros, above = self._zeros[plane], np.empty_like(level)
            above[~bits] = level[:zeros]
            above[bits] = level[zeros:] | level.dtype.type(1 << (self.planes - 1 - plane))
            level = above
        return level.astype(np.uint32)
