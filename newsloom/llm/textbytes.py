"""UTF-8 bytes of Arrow string columns as NumPy arrays: words and their hashes without a Python
object for each word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once, at least one row; each takes about 80 bytes of arrays.
SLICE_BYTES = 2 << 20
#: Bytes from which a word is hashed by itself.
LONG_WORD = 256

_MASK = (1 << 64) - 1


def splitmix(n: int, seed: int) -> np.ndarray:
    """n well mixed 64-bit numbers from a seed; the same everywhere."""
    x = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(seed & _MASK)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = splitmix(256, 77)
_STEP = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_BACK = pow(_STEP, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_STEP and _BACK to the powers 0 to n-1. Kept for texts of usual size only."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (_STEP, _BACK):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        made.append(np.multiply.accumulate(x))
    if n <= 4 * SLICE_BYTES:
        _powers[:] = made
    return made[0], made[1]


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, back) from which span_hashes() hashes any byte span in constant time."""
    forth, back = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * forth[:-1], out=sums[1:])
    return sums, back


def span_hashes(sums: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw = (sums[ends] - sums[starts]) * back[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Lower case for A-Z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words [^\x20\x09-\x0D]+.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of whole rows of at most so many bytes, or one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends with its row."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each row's first word with the end appended)."""
    low = LOWER[data]
    starts, ends = spans(kind[low], offsets)
    sums, back = prefix_hashes(low)
    hashes = span_hashes(sums, back, starts, ends)
    # A sum modulo 2**64 is the same for some long strings that differ; so few words are long that they take
    # another hash.
    for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(low[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return hashes, np.searchsorted(starts, offsets)
