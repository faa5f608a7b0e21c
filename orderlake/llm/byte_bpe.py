"""Byte-level BPE: encoding in two tiers, and decoding.

Texts are cut into pre-tokens by the tokenizer's pattern. A minimal perfect hash of the vocabulary answers for pre-tokens that
are one token as a whole; for the others a heap holds the candidate merges of a linked list of byte parts, and the
merge of lowest rank, leftmost first, is taken until none is left. That is O(n log n) for pre-tokens of any length.

Defined cases: a null text is empty and has no ids. Ids that the vocabulary lacks raise in ``decode``; null ids decode to
no bytes. Special tokens are never made: their text is ordinary text. Input columns are carried through; the
one named like the result is replaced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.pieces import PieceTable, grouped


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64, blank, rank) in the order of their ranks."""
    with open(path, "rb") as file:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, file)))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must count from 0 without gaps")
    return [token for _, token in pairs]


@dataclass
class PerfectHash:
    """Minimal perfect hash by displacement: every key has one of exactly ``len(keys)`` slots."""

    displacements: list[int]
    slots: list[int]
    n: int

    @staticmethod
    def _hashes(key: bytes, n: int) -> tuple[int, int, int]:
        h = xxhash.xxh3_64_intdigest(key)
        return h & 0xFFFFF, (h >> 20) % n, (h >> 40) % max(n - 1, 1) + 1

    @classmethod
    def of(cls, keys: list[bytes], per_bucket: int = 4) -> PerfectHash:
        n = len(keys)
        buckets: list[list[int]] = [[] for _ in range(max(1, n // per_bucket))]
        hashes = [cls._hashes(k, n) for k in keys]
        for i, (bucket, _, _) in enumerate(hashes):
            buckets[bucket % len(buckets)].append(i)
        displacements, slots, free = [0] * len(buckets), [-1] * n, 0
        for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
            held = buckets[b]
            if len(held) == 1:  # the rest goes straight to what is left
                while slots[free] >= 0:
                    free += 1
                slots[free], displacements[b] = held[0], -free - 1
                continue
            d = 0
            while held:
                # The second hash alone can collide, so the displacement has two parts.
                places = {cls._slot(hashes[i][1], hashes[i][2], d, n) for i in held}
                if len(places) == len(held) and all(slots[p] < 0 for p in places):
                    for i in held:
                        slots[cls._slot(hashes[i][1], hashes[i][2], d, n)] = i
                    displacements[b] = d
                    break
                d += 1
                if d > 64 * n + 1024:
                    raise ValueError("no perfect hash found: repeated keys?")
        return cls(displacements, slots, n)

    @staticmethod
    def _slot(first: int, step: int, d: int, n: int) -> int:
        return (first + (d % n) * step + d // n) % n

    def get(self, key: bytes) -> int:
        """The number of the key that has this key's slot; the caller compares the bytes."""
        bucket, first, step = self._hashes(key, self.n)
        d = self.displacements[bucket % len(self.displacements)]
        return self.slots[-d - 1 if d < 0 else self._slot(first, step, d, self.n)]


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one pre-token: a heap of candidate merges over parts linked by their starts.

    An entry is (rank, start, end) in one number, so the least is the merge of lowest rank, of several the leftmost. A part
    that was merged into another one has 0 for its successor.
    """
    n, rank_of = len(word), ranks.get
    shift = (n + 1).bit_length()
    mask, high = (1 << shift) - 1, 2 * shift
    heap = []
    for i in range(n - 1):
        rank = rank_of(word[i : i + 2])
        if rank is not None:
            heap.append(rank << high | i << shift | i + 2)
    heapify(heap)
    after, before = list(range(1, n + 2)), list(range(-1, n))
    while heap:
        entry = heappop(heap)
        i, end = entry >> shift & mask, entry & mask
        j = after[i]
        if j <= i or j >= n or after[j] != end:
            continue  # one of the two parts has been merged with another meanwhile
        after[j], after[i] = 0, end
        if end < n:
            before[end] = i
            last = after[end]
            rank = rank_of(word[i:last])
            if rank is not None:
                heappush(heap, rank << high | i << shift | last)
        if i:
            first = before[i]
            rank = rank_of(word[first:end])
            if rank is not None:
                heappush(heap, rank << high | first << shift | end)
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


#: A blank between two characters that are no white space starts a pre-token, and a line break there is one.
_PLAIN_BREAK = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


#: Points and commas that may belong to a longer pre-token.
_ODD_POINTS = re.compile(r"(?:\A|[\W_])[.,]|[.,](?:[^\w\s]|_)")


def _evenly_spaced(text: str) -> bool:
    """White space is single blanks and line breaks between words, and nothing else."""
    words = text.split()
    breaks = len(words) - 1
    single = sum(map(len, words)) + breaks == len(text)
    return single and text.count(" ") + text.count("\n") == breaks and "\0" not in text


def cut_at_spaces(text: str) -> list[str]:
    """Pieces that pre-tokens never cross; most of them are single pre-tokens."""
    if not text:
        return []
    if not _evenly_spaced(text):
        return _PLAIN_BREAK.split(text)
    text = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
    if not _ODD_POINTS.search(text):
        text = text.replace(".", "\0.").replace(",", "\0,")
    return text.split("\0")


class ByteBpe:
    """An encoder for one worker."""

    def __init__(self, tokens: list[bytes], perfect: PerfectHash, pattern: str):
        self.tokens, self.perfect = tokens, perfect
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.token_bytes = _tokens(tokens)
        self.pattern = regex.compile(pattern)
        self.table = PieceTable(self._encode_pieces)

    def words(self, piece: str) -> list[str]:
        """The pre-tokens of a piece; the pattern is asked where they aren't plain to see."""
        body = piece[1:] if piece[0] == " " else piece
        if body.isalpha():
            return [piece]
        return self.pattern.findall(piece)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        out = []
        for piece in pieces:
            ids = array("i")
            for word in self.words(piece):
                ids.extend(self.encode_word(word.encode("utf-8", "surrogatepass")))
            out.append(ids.tobytes())
        return out

    def encode_word(self, word: bytes) -> list[int]:
        token = self.perfect.get(word)
        return [token] if self.tokens[token] == word else merge_bytes(word, self.ranks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths, _ = self.table.ids_of([cut_at_spaces(t) for t in texts])
        return ids, lengths


def pack_vocabulary(path: str) -> tuple[str, list[bytes], PerfectHash]:
    """What the workers need, built once, with a name of its own; its size is that of the vocabulary."""
    tokens = read_ranks(path)
    return xxhash.xxh3_128_hexdigest(b"\0".join(tokens)), tokens, PerfectHash.of(tokens)


_ENCODERS: dict[tuple[str, str], ByteBpe] = {}


def _worker_encoder(vocabulary: tuple[str, list[bytes], PerfectHash], pattern: str) -> ByteBpe:
    """One encoder per worker process, kept for the tasks that follow."""
    name, tokens, perfect = vocabulary
    if (name, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name, pattern] = ByteBpe(tokens, perfect, pattern)
    return _ENCODERS[name, pattern]


def _decoded(tokens: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.array([b"".join(tokens[values[a:e]].tolist()) for a, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())


def _tokens(listed: list[bytes]) -> np.ndarray:
    return np.array([*listed, b""], object)[:-1]


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", into: str = "ids", decoded_into: str | None = None) -> DataFrame:
    """The rows with their token ids (``array<int>``), and with the bytes they decode to where ``decoded_into`` names a column.

    Both steps then share one worker and its vocabulary; ``decode`` alone does the same to any column of ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pack_vocabulary(vocabulary))
    results = [into, decoded_into] if decoded_into else [into]
    own = [c for c in docs.columns if c.lower() not in {r.lower() for r in results}]
    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text}`").alias("_text_to_encode"))
    kinds = (T.ArrayType(T.IntegerType()), T.BinaryType())
    schema = T.StructType([*rows.schema.fields[:-1], *(T.StructField(r, k) for r, k in zip(results, kinds, strict=False))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker_encoder(shared.value, pattern)
        for batch in batches:
            texts, done = [t or "" for t in batch.column(len(own)).to_pylist()], 0
            for group in grouped(texts):
                ids, lengths = bpe.encode(group)
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                here = batch.slice(done, len(group))
                done += len(group)
                found = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))]
                if decoded_into:
                    found.append(_decoded(bpe.token_bytes, ids, bounds))
                yield pa.RecordBatch.from_arrays([*here.columns[: len(own)], *found], names=[*own, *results])

    return rows.mapInArrow(each, schema)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the bytes (``binary``) that their ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    own = [c for c in encoded.columns if c.lower() != into.lower()]
    rows = encoded.select(*[F.col(f"`{c}`") for c in own])
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.BinaryType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared.value)
        for batch in batches:
            lists = batch.column(own.index(ids))
            values, bounds = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(tokens, values, bounds)], names=[*own, into])

    return rows.mapInArrow(each, schema)
