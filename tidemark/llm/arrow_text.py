"""Vectorised work on the bytes of Arrow text columns (numpy inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240229)
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INV = U(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
LOWER_CODES = CODES[LOWER]
STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", BASE), ("down", BASE_INV)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * U(0x7FB5D329728EA185)
    h = (h ^ (h >> U(27))) * U(0x81DADEF4BC2DD44D)
    return h ^ (h >> U(33))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (as int64) of a text or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


#: Bytes of text whose prefix sums are held at once; a longer word is held whole.
BLOCK = 2 << 20


def _word_hashes(text: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of some rows in order, and each word's first byte."""
    word = ~SPACE[text]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = rows[:-1][rows[:-1] < rows[1:]]
    first[begins] |= word[begins]
    last = word.copy()
    last[:-1] &= ~word[1:]
    ends = rows[1:][rows[:-1] < rows[1:]] - 1
    last[ends] |= word[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(text) + 1)
    total = np.empty(len(text) + 1, np.uint64)
    total[0] = 0
    np.cumsum(LOWER_CODES[text] * up[: len(text)], out=total[1:])
    return mix((total[end] - total[start]) * down[start]), start


class Words:
    """The words of some rows: hashes of the lower-cased words in order, and where each row's begin.

    Long texts are worked on in blocks that end between words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        base, n = int(offsets[0]), int(offsets[-1] - offsets[0])
        rows = offsets - base
        text = data[base : base + n]
        hashes, starts, low = [], [], 0
        while low < n:
            high = min(n, low + BLOCK)
            if high < n:
                gaps = np.flatnonzero(SPACE[text[low + BLOCK // 2 : high]])
                if len(gaps):
                    high = low + BLOCK // 2 + int(gaps[-1]) + 1
                else:
                    high = next((x + 1 + int(g[0]) for x in range(high, n, BLOCK) if len(g := np.flatnonzero(SPACE[text[x : x + BLOCK]]))), n)
            inside = np.append(np.append(low, rows[(rows > low) & (rows < high)]), high) - low
            found, start = _word_hashes(text[low:high], inside)
            hashes.append(found)
            starts.append(start + low)
            low = high
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.row = np.searchsorted(np.concatenate(starts) if starts else np.zeros(0, np.int64), rows)

    def shingles(self, width: int) -> list[np.ndarray]:
        """Each row's distinct shingle hashes, sorted; a shorter row has one of all its words."""
        h, n = self.hash, len(self.hash)
        wide = np.zeros(max(0, n - width + 1), np.uint64)
        for j in range(width):
            wide += h[j : n - width + 1 + j] * STEP[j]
        wide = mix(wide + U(width))
        out = []
        for a, b in zip(self.row[:-1].tolist(), self.row[1:].tolist()):
            if b - a >= width:
                out.append(np.unique(wide[a : b - width + 1]))
            elif b > a:
                out.append(mix(np.array([np.sum(h[a:b] * STEP[: b - a], dtype=np.uint64) + U(b - a)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out
