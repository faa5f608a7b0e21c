"""Terms of many texts at once, as numbers into the list of the different ones.

A term is a run of kept characters, of which only A-Z are lower-cased. In UTF-8 every byte of a character outside ASCII is at
least 0x80, so runs of bytes are runs of characters.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _byte_table(kept: str) -> bytes:
    """Kept ASCII characters and all bytes from 0x80 on stay, A-Z become a-z, the rest become blanks."""
    return bytes(b if b >= 0x80 or chr(b) in kept else 0x20 for b in range(256)).lower()


#: Letters A-Z and everything outside ASCII.
LETTERS = _byte_table(string.ascii_letters)
#: The same with the digits 0-9.
LETTERS_AND_DIGITS = _byte_table(string.ascii_letters + string.digits)


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts have about ``most`` bytes together; a longer text is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, base = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts of a binary column; a null is empty."""
    return [t or b"" for t in column.to_pylist()]


def numbered(words: list[list[bytes]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, the number of each word in order, and how many words each text has."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    coded = pa.array(chain.from_iterable(words), pa.binary(), size=int(counts.sum())).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def terms(texts: list[bytes], table: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``numbered`` for the terms of the texts."""
    return numbered([t.translate(table).split() for t in texts])


def tally(codes: np.ndarray, counts: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words of each text: the text's place, the word's number and how often it is there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    pairs, n = np.unique(owner * max(kinds, 1) + codes, return_counts=True)
    return pairs // max(kinds, 1), pairs % max(kinds, 1), n


def lists(owner: np.ndarray, rows: int, *values: pa.Array) -> list[pa.ListArray]:
    """Values as one list per row, for ascending owners."""
    offsets = pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32())
    return [pa.ListArray.from_arrays(offsets, v) for v in values]
