"""Words and their hashes over whole Arrow columns, vectorised; used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is a piece of its own.
PIECE = 1 << 21
_MASK = (1 << 64) - 1


def _bytes_table(keep) -> np.ndarray:
    """Byte -> byte: A-Z lower-cased, bytes outside ``keep`` to a blank."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[[b for b in range(256) if not keep(b)]] = 32
    return table


#: Words are runs of bytes other than blanks and controls 9 to 13.
SPACED = _bytes_table(lambda b: b != 0x20 and not 9 <= b <= 13)
#: Words are runs of letters, digits and bytes of 128 and above.
ALNUM = _bytes_table(lambda b: b >= 0x80 or chr(b).isalnum())


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


BASE = 0x9E3779B97F4A7C55
_BYTE = _constants(256, 11)
_STEP = _constants(64, 23) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base & _MASK, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 places where its rows begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes together, in order, of all rows."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some rows, and the n + 1 places where the rows' words begin."""
    begin = int(offsets[0])
    low = table[data[begin : int(offsets[-1])]]
    rows = offsets - begin
    n = len(low)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    inside = low != 32
    edge = np.empty(n, bool)
    edge[0] = True
    np.logical_not(inside[:-1], out=edge[1:])
    edge[rows[:-1][rows[:-1] < n]] = True
    starts = np.flatnonzero(edge & inside)
    power, inverse = _power_tables(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[low] * power[:n], out=sums[1:])
    # A word ends at the next blank or where the next row begins.
    stop = np.empty(n + 1, bool)
    stop[:n] = ~inside
    stop[rows] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    hashes = _mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, rows)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each place on (size - 1 fewer than words)."""
    n = len(hashes) - size + 1
    total = np.full(max(n, 0), np.uint64(size), np.uint64)
    for k in range(size if n > 0 else 0):
        total = total + _mix(hashes[k : k + n] ^ _STEP[k])
    return _mix(total)


def sets_of_runs(hashes: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """Per row its sorted distinct runs; with fewer words the whole row is one; without, none."""
    every = runs(hashes, size)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(every[a : b - size + 1]))
        elif b > a:
            out.append(runs(hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
