"""Hashes of words and of runs of words, for whole blocks of texts at once.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. A word's hash
is a polynomial over its bytes (read off prefix sums) put through a 64-bit
finaliser; a run's hash is a polynomial over its words' hashes. Everything is
array arithmetic modulo 2**64, a bounded number of bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

AT_ONCE = 1 << 20  # bytes hashed together; a longer text goes alone
BASE = 0x9E3779B97F4A7C15 | 1
RUN_BASES = (0xC2B2AE3D27D4EB4F | 1, 0x165667B19E3779F9 | 1)

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for ``i < n``."""
    if len(_POWERS[0]) < n:
        size = max(n, AT_ONCE + 1)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """The words of some texts laid end to end: hash of each word, its text,
    and where it begins and ends in ``data``."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        raw = b" ".join(texts)
        self.raw = raw
        data = np.frombuffer(raw, np.uint8)
        blank = BLANK[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
        self.begin, self.end = edge[::2], edge[1::2]
        up, down = powers(len(data) + 1)
        values = BYTE[LOWER[data] if lower else data]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(data)], dtype=np.uint64)])
        self.hash = mixed((sums[self.end] - sums[self.begin]) * down[self.begin]
                          ^ (self.end - self.begin).astype(np.uint64))
        size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        text_end = np.cumsum(size)
        self.first = np.searchsorted(self.begin, text_end - size)  # of each text, in words
        self.count = np.diff(np.append(self.first, len(self.begin)))

    def runs(self, n: int, base: int = RUN_BASES[0]) -> np.ndarray:
        """Hash of the ``n`` words from each word on (the last ``n - 1`` words
        of the block begin none)."""
        m = max(0, len(self.hash) - n + 1)
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h = h * np.uint64(base) + self.hash[k:k + m]
        return mixed(h)

    def whole(self, n: int) -> np.ndarray:
        """Which of the :meth:`runs` stay inside one text."""
        m = max(0, len(self.hash) - n + 1)
        text = np.repeat(np.arange(len(self.count)), self.count)
        return text[:m] == text[n - 1:n - 1 + m] if m else np.zeros(0, bool)


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Half-open index ranges of texts of about ``AT_ONCE`` bytes together."""
    at = 0
    total = 0
    for i, t in enumerate(texts):
        if i > at and total + len(t) > AT_ONCE:
            yield at, i
            at, total = i, 0
        total += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, bytes of equal weight together (sorted
    numbers share their high bytes)."""
    import zstandard as zstd

    parts = []
    for a in arrays:
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        parts.append(np.array([len(a)], "<u4").tobytes() + a.dtype.str.encode().ljust(4) + planes)
    return zstd.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(data: bytes) -> list[np.ndarray]:
    import zstandard as zstd

    raw, at, out = zstd.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n, kind = int(np.frombuffer(raw, "<u4", 1, at)[0]), np.dtype(raw[at + 4:at + 8].decode().strip())
        at += 8
        size = n * kind.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n) if n else np.zeros((kind.itemsize, 0), np.uint8)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size
    return out


def gaps(x: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers, in the narrowest type that holds them."""
    d = np.diff(x, prepend=x[:1] * 0)
    top = int(d.max()) if len(d) else 0
    return d.astype("<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def ungapped(d: np.ndarray) -> np.ndarray:
    return np.cumsum(d, dtype=np.uint64)
