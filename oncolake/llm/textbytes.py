"""Text columns as byte arrays: what the numpy operators share inside a task.

Arrow keeps a text column as one run of UTF-8 bytes with offsets, so whole batches are handled by
array operations without a Python object per row. A batch is cut into pieces of about
``PIECE_BYTES`` (one longer text is a piece of its own), which bounds the memory of the temporaries.
Workers live longer than their tasks, so memory goes back to the system after each batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18

#: Space and the control characters from tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_SEED = np.random.default_rng(20240229)
BYTE_CODE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch whose texts have about ``limit`` bytes; every row is in one of them."""
    if not batch.num_rows:
        return
    _, starts = utf8(batch.column(batch.schema.get_field_index(column)))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(starts, starts[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end
    release_memory()


def release_memory() -> None:
    """Give free memory of this process back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def mix(value: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64, by doubling."""
    out = np.ones(max(count, 1), np.uint64)
    filled = 1
    while filled < count:
        step = min(filled, count - filled)
        top = np.uint64(pow(int(base), filled, 1 << 64))
        out[filled : filled + step] = out[:step] * top
        filled += step
    return out


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < count:
        size = max(count, PIECE_BYTES + 4096)
        if count > size // 2 and count > 2 * PIECE_BYTES:
            return powers(BASE, count), powers(UNBASE, count)  # one very long text: not kept
        _POWERS["up"], _POWERS["down"] = powers(BASE, size), powers(UNBASE, size)
    return _POWERS["up"][:count], _POWERS["down"][:count]


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that depend on their content alone."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words of all rows, and the number of the first word of each row."""
    black = ~SPACES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[:-1] = black
    edge[1:-1] &= ~black[:-1]
    cuts = starts[:-1][starts[:-1] < len(data)]
    edge[cuts] = black[cuts]  # a word never runs over the end of its row
    begins = np.flatnonzero(edge)
    last = np.zeros(len(data) + 1, bool)
    last[1:] = black
    last[1:-1] &= ~black[1:]
    inner = starts[1:][starts[1:] > 0]
    last[inner] = black[inner - 1]
    ends = np.flatnonzero(last)
    return begins, ends, np.searchsorted(begins, starts)


def rows_of(starts: np.ndarray) -> np.ndarray:
    """The row number of every element between the offsets."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))
