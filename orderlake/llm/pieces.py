"""Token ids of texts by way of a bounded table of the pieces seen so far.

A worker meets the same pieces (words) again and again. The table gives each a number, its ids are stored once, and a
text's ids are gathered from there. When the table has grown to its limit, in pieces or in bytes, the pieces seen once are forgotten.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np


class _Numbers(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


#: What Python needs for a piece besides its characters: the string, its entry in the dictionary, its number.
_OVERHEAD = 150


class PieceTable:
    """``encode`` gives the ids of each of a list of pieces as bytes (native 32-bit numbers); ``flag`` marks pieces (say,
    ends of sentences)."""

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        flag: Callable[[str], bool] = lambda piece: False,
        max_pieces: int = 300_000,
        max_bytes: int = 64 << 20,
    ):
        self.encode, self.flag, self.max_pieces, self.max_bytes = encode, flag, max_pieces, max_bytes
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.starts, self.flags = array("i"), array("q", [0]), array("b")
        self.hits = np.zeros(0, np.int64)
        self.held = 0  # characters of all pieces

    def _full(self) -> bool:
        n = len(self.flags)
        return n > self.max_pieces or n * _OVERHEAD + self.held + 4 * len(self.ids) > self.max_bytes

    def _forget(self) -> None:
        """Keep at most a fourth of the table: the pieces that were seen most."""
        names, hits = list(self.numbers), self.hits
        ids, starts, flags = (np.array(c) for c in (self.ids, self.starts, self.flags))
        least = 2
        while np.count_nonzero(hits >= least) > min(self.max_pieces // 2, len(names) // 4):
            least *= 2
        kept = np.flatnonzero(hits >= least)
        lengths = np.diff(starts)[kept]
        ends = np.cumsum(lengths)
        self.clear()
        held = sum(len(names[i]) for i in kept.tolist())
        if len(kept) and len(kept) * _OVERHEAD + held + 4 * ends[-1] < self.max_bytes // 2:
            self.held = held
            self.numbers.update({names[i]: n for n, i in enumerate(kept.tolist())})
            self.ids = array("i", ids[np.repeat(starts[kept] - (ends - lengths), lengths) + np.arange(ends[-1])].tobytes())
            self.starts, self.flags = array("q", np.concatenate([[0], ends]).tobytes()), array("b", flags[kept].tobytes())
            self.hits = np.ones(len(kept), np.int64)

    def _learn(self, pieces: list[str]) -> None:
        found = self.encode(pieces)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        self.starts.frombytes((len(self.ids) + np.cumsum(lengths)).tobytes())
        self.ids.frombytes(b"".join(found))
        self.flags.frombytes(bytes(map(self.flag, pieces)))
        self.hits = np.concatenate([self.hits, np.zeros(len(pieces), np.int64)])
        self.held += sum(map(len, pieces))

    def ids_of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids one after the other, the number of ids of each text, and the places behind flagged pieces."""
        if self._full():
            self._forget()
        numbers, before = self.numbers, len(self.flags)
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(counts.sum()))
        if len(numbers) > before:
            self._learn(list(islice(numbers, before, None)))
        self.hits += np.bincount(at, minlength=len(self.hits))
        starts, ids = np.frombuffer(self.starts, np.int64), np.frombuffer(self.ids, np.int32) if self.ids else np.zeros(0, np.int32)
        flags = np.frombuffer(self.flags, np.int8) if self.flags else np.zeros(0, np.int8)
        lengths = starts[at + 1] - starts[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.repeat(starts[at] - (ends - lengths), lengths) + np.arange(total)]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        upto = np.concatenate([[0], ends])
        return out, np.diff(upto[bounds]), ends[flags[at] != 0]


def grouped(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Neighbouring texts in groups of about ``most`` characters; a longer text is a group of its own."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > most:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group
