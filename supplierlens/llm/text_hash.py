"""Words of many texts and their hashes, as numpy arrays over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about this many bytes, which bounds the working arrays
#: (about 60 bytes for each byte of text). A longer text is a piece of its own and its
#: words are hashed in blocks of this size.
PIECE_BYTES = 1 << 20

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants drawn from ``seed``."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)
    return mixed(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_BYTE = constants(256, 1)
_BASE = int(constants(1, 2)[0]) | 5
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, PIECE_BYTES), _powers(_UNBASE, PIECE_BYTES)


@dataclass
class Texts:
    """UTF-8 bytes of some rows; row i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts(column: pa.Array) -> Iterator[Texts]:
    """The rows of a string column, null as empty, in pieces of about PIECE_BYTES."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None and whole.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Texts(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Words of some rows: byte ranges, hashes, and ``bounds``: row i has words bounds[i]:bounds[i+1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def words(part: Texts, lower: bool = True) -> Words:
    """Runs of non-blank bytes of each row. With ``lower``, A-Z count as a-z."""
    if len(part.data) <= PIECE_BYTES:
        starts, ends, hashes = _hashed(part.data, part.offsets, lower)
    else:  # one long text: blocks end at a blank, or hold one word that is longer than a block
        found, at, data = [], 0, part.data
        blanks = np.flatnonzero(_IS_BLANK[data])
        while at < len(data):
            end = min(at + PIECE_BYTES, len(data))
            if end < len(data):
                k = int(np.searchsorted(blanks, end, "right")) - 1
                if k >= 0 and blanks[k] > at:
                    end = int(blanks[k])
                else:
                    end = int(blanks[k + 1]) if k + 1 < len(blanks) else len(data)
            s, e, h = _hashed(data[at:end], np.array([0, end - at]), lower)
            found.append((s + at, e + at, h))
            at = end
        starts, ends, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    return Words(starts, ends, hashes, np.searchsorted(starts, part.offsets, "left"))


def _hashed(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_IS_BLANK[data], out=inside[1:-1])
    body = inside[1:-1]
    opens, closes = body & ~inside[:-2], body & ~inside[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]  # a word ends where its row ends
    opens[cut] = body[cut]
    closes[cut - 1] = body[cut - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, range_hashes(_BYTE[_LOWER[data] if lower else data], starts, ends)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``values[starts[i]:ends[i]]``: differences of one running polynomial."""
    n = len(values)
    up, down = (_UP, _DOWN) if n <= PIECE_BYTES else (_powers(_BASE, n), _powers(_UNBASE, n))
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=running[1:])
    hashes = (running[ends] - running[starts]) * down[starts]
    return mixed(hashes + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words of one text; of all its words if they are fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    c = constants(k + 1, 3)
    if n < k:
        return mixed((hashes * c[:n]).sum(dtype=np.uint64, keepdims=True) + c[k:] * np.uint64(n))
    out = hashes[:n - k + 1] * c[0]
    for i in range(1, k):
        out += hashes[i:n - k + 1 + i] * c[i]
    return mixed(out)
