"""Words of Arrow text columns as numpy arrays: batches in pieces of bounded size, word borders, 64-bit word hashes.

Everything works on UTF-8 bytes and whole texts. A text longer than a piece is cut at separators, so memory follows the
piece and not the text; only word hashes, 8 bytes a word, are held for a whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES, PIECE_ROWS = 1 << 21, 1024


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator: spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Separators of the contract's words: space and the controls 9 to 13.
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: All that is no letter: bytes of other scripts count as letters.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[65:91] = NO_LETTER[97:123] = NO_LETTER[128:] = False


def pieces(column: pa.Array, lower: bool = False, most: int = PIECE_BYTES, rows: int = PIECE_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows. Null counts as empty. A single long text is one piece."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), row + rows, len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def borders(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word. A word ends at the end of its text too."""
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (~before[:-1] | cut[:-1]))
    after = np.ones(len(data), dtype=bool)
    if len(data):
        after[:-1] = ~inside[1:] | cut[1:-1]
    return starts, np.flatnonzero(inside & after) + 1


def _hash_piece(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = borders(data, offsets, separators)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    first = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    powers = np.full(int(lengths.max()), BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = BYTE_VALUES[FOLD[data[~separators[data]]]] * powers[place]
    return splitmix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE, most: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and for each text the number of the first of its words (one more at the end)."""
    found, at, low = [], [], 0
    while low < len(data):
        high = min(low + most, len(data))
        if high < len(data):
            gaps = np.flatnonzero(separators[data[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            else:
                rest = np.flatnonzero(separators[data[high:]])
                high = high + int(rest[0]) + 1 if len(rest) else len(data)
        part = offsets[(offsets >= low) & (offsets < high)] - low
        hashes, starts = _hash_piece(data[low:high], part, separators)
        found.append(hashes)
        at.append(starts + low)
        low = high
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    starts = np.concatenate(at) if at else np.zeros(0, np.int64)
    return hashes, np.searchsorted(starts, offsets)


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each word as one number, first byte highest, 0 behind a shorter word."""
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    last = max(len(data) - 1, 0)
    for k in range(8):
        byte = np.where(lengths > k, data[np.minimum(starts + k, last)], 0) if len(starts) else np.zeros(0, np.uint8)
        out |= byte.astype(np.uint64) << np.uint64(8 * (7 - k))
    return out


def pack_text(word: str) -> int:
    return int.from_bytes(word.encode()[:8].ljust(8, b"\0"), "big")


def columns(schema: str, batch_rows: int, **values) -> pa.RecordBatch:
    """A record batch of the given columns, in the schema's order."""
    names = [part.strip().split()[0] for part in schema.split(",")]
    return pa.RecordBatch.from_arrays([values[n] for n in names], names=names)
