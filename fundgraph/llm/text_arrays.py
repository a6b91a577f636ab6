"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.  No Python object is made per word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Sub-batches of about this many bytes keep temporary arrays small whatever the batch holds.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_random = np.random.Generator(np.random.PCG64(20_240_607))
#: A random number for each byte and an odd multiplier make the polynomial hash.
_BYTE = _random.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    return _powers(base, 1 << max(10, (n - 1).bit_length()))[:n]


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, 1 << 64))
        done *= 2
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the offsets of the texts (one more than texts); nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first text, last text + 1, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word never crosses from one text to the next."""
    n = len(data)
    inside = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = np.zeros(n + 1, bool)
    start[:n] = inside
    start[1:n] &= ~inside[:-1] | first[1:n]
    end = np.zeros(n + 1, bool)
    end[1:] = inside
    end[1:n] &= ~inside[1:] | first[1:n]
    return np.flatnonzero(start[:n]), np.flatnonzero(end)


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Sums of symbol * P ** place: any stretch's hash is a difference, see :func:`stretch_hash`."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(_P, len(symbols)), out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches: equal contents give equal hashes, wherever they stand."""
    inverse = powers(_P_INVERSE, len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def fields_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text that each place lies in."""
    return np.searchsorted(offsets, starts, "right") - 1


def whole_groups(batches: Iterator[pa.RecordBatch], column: str, rows: int = 200_000) -> Iterator[pa.Table]:
    """Tables of complete groups from batches sorted by ``column``: some ``rows`` at a time, or one group if that has more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) < rows:
            continue
        t = pa.Table.from_batches(held)
        key = t.column(column).to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left")) if key[0] != key[-1] else 0
        if cut:
            yield t.slice(0, cut)
            held = t.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)
