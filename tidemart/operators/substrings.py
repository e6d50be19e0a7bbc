"""Which words of a dictionary may begin where in a text: a search over whole columns of texts, by a filter of fixed size.

A word is marked in the filter by its first bytes, as many as one of GRAM_SIZES allows, and by all its bytes.  Every place of
a text is looked up by its first bytes, the few that pass by the bytes of every length that words have.  What passes may
still be no word, so the caller joins it with the dictionary; a word is never missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes by which words are looked for first: each word by the largest size that it reaches.
GRAM_SIZES = (1, 2, 3, 5, 8)
FILTER_BITS = 24  # whatever the dictionary; a fuller filter lets more pass, which costs time but changes nothing
PLACES_AT_ONCE = 1 << 17
_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_size(length: int) -> int:
    return max(n for n in GRAM_SIZES if n <= length)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as a number; ``data`` ends in eight bytes that do not count."""
    return np.ndarray(len(data) - 8, dtype="<u8", buffer=data, strides=(1,))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt * 0x632BE5AB)) * _ODD
    return x ^ (x >> np.uint64(32))


def _spots(eights: np.ndarray, length: int, kind: int) -> np.ndarray:
    """Places in the filter of ``length`` bytes, eight at most."""
    few = eights & np.uint64((1 << 8 * length) - 1)
    return (_mixed(few, 2 * length + kind) * _ODD) >> np.uint64(64 - FILTER_BITS)


def gram_spots(eights: np.ndarray, size: int) -> np.ndarray:
    return _spots(eights, size, 0)


def word_spots(eights: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Places in the filter of the ``length`` bytes from each of ``at``."""
    if length <= 8:
        return _spots(eights[at], length, 1)
    x = np.full(len(at), length, dtype=np.uint64)
    for k in [*range(0, length - 8, 8), length - 8]:
        x = _mixed(x ^ eights[at + k], 1) * _ODD
    return x >> np.uint64(64 - FILTER_BITS)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, with eight more, and where each value begins and the last ends; nulls are empty."""
    values = column.fill_null(b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    bounds = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]] if data else np.zeros(0, np.uint8)
    return np.concatenate((data, np.zeros(8, np.uint8))), bounds - bounds[0]


def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(length, spot): two places in the filter for each word, of one binary column without empty ones."""
    for batch in batches:
        data, bounds = _bytes_of(batch.column(0))
        eights, lengths, found = _eights(data), np.diff(bounds), []
        for length in np.unique(lengths).tolist():
            at = bounds[:-1][lengths == length]
            spots = np.concatenate((gram_spots(eights[at], gram_size(length)), word_spots(eights, at, length)))
            found.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(spots), length)), pa.array(spots.astype(np.int64))], ["length", "spot"]))
        yield from found


def _passing(bits: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return (bits[spots >> np.uint64(6)] >> (spots & np.uint64(63))) & np.uint64(1) != 0


def candidates(batches: Iterator[pa.RecordBatch], bits: np.ndarray, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """(key, found): what may be a word in each text of (key, text), once per row and block of places."""
    by_size: dict[int, list[int]] = {}
    for length in lengths:
        by_size.setdefault(gram_size(length), []).append(length)
    for batch in batches:
        data, bounds = _bytes_of(batch.column(1))
        eights = _eights(data)
        for first in range(0, len(eights), PLACES_AT_ONCE):
            block = eights[first:first + PLACES_AT_ONCE].copy()
            for size, own in by_size.items():
                at = np.flatnonzero(_passing(bits, gram_spots(block, size))) + first
                row = np.searchsorted(bounds, at, "right") - 1
                room = bounds[row + 1] - at
                for length in own:
                    fits = room >= length
                    places, rows = at[fits], row[fits]
                    passed = _passing(bits, word_spots(eights, places, length))
                    places, rows = places[passed], rows[passed]
                    if not len(places):
                        continue
                    slices = data[places[:, None] + np.arange(length)]
                    found = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(places), [None, pa.py_buffer(slices.tobytes())])
                    once = pa.table({"row": rows, "found": found.cast(pa.binary())}).group_by(["row", "found"]).aggregate([])
                    for part in once.to_batches():
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(part.column("row")), part.column("found")], ["_text", "_found"])
