"""Packing documents into training sequences: dynamic programming over cuts, in document order.

Documents are taken in the order of their key, each followed by the end token, and cut into windows of at most
``length`` tokens. Cuts are free at ends of documents, cost a little at ends of sentences and more elsewhere; a window also
costs its padding. ``best[j] = cut[j] + min(best[i] + length - (pos[j] - pos[i]))`` over the cuts ``i`` at most ``length`` before
``j``: of ``best[i] + pos[i]`` only the minimum over a sliding range is needed, which a monotone queue keeps. Places
inside a long stretch without sentence end are candidates too, so padding stays small whatever the text is. A window whose
size is a power of two is not padded, so a run's remainder is split into such sizes where that is cheaper than
padding it.

Documents are range-partitioned by key; each partition packs runs of about ``run_tokens`` tokens one after the other, so
memory doesn't grow with the corpus. Sequence numbers are the partition's number and a counter.

Defined cases: a null text is empty and is packed as the end token alone; a null key comes first; rows that repeat a key are
packed one after the other, ordered by a hash of their texts. Columns other than key and text are not part of the result.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from orderlake.llm.pieces import PieceTable, grouped

SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？")
#: White space of Python that the tokenizer's pattern takes for ordinary characters.
_SEPARATORS = re.compile("[\x1c-\x1f]")


@dataclass(frozen=True)
class Costs:
    """In tokens of padding: a cut at the end of a sentence, and one elsewhere; the widest stretch without candidate."""

    sentence: int = 2
    inside: int = 24
    stretch: int = 48


def choose_cuts(candidates: np.ndarray, costs: np.ndarray, length: int, inside: int) -> list[int]:
    """Places where windows end, for cuts at sorted candidates (the last is the end of all tokens).

    Neighbouring candidates must be at most ``length`` apart. The queue holds candidates in ascending order of place and of
    ``best + place``; what is too far behind leaves in front, what is not better than a newer one leaves at the back.
    """
    place, cost = [0, *candidates.tolist()], [0, *costs.tolist()]
    end = place[-1]
    best, come_from = [0] * len(place), [0] * len(place)
    queue = deque([(0, 0, 0)])  # best + place, place, number
    for j in range(1, len(place)):
        p = place[j]
        while queue[0][1] < p - length:
            queue.popleft()
        least, _, i = queue[0]
        best[j], come_from[j] = cost[j] + length - p + least, i
        value = best[j] + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, p, j))
    # The remainder may go into windows of sizes that are powers of two, which need no padding.
    last, tail = len(place) - 1, []
    for i in range(last - 1, -1, -1):
        size = end - place[i]
        if size > length:
            break
        split = best[i] + inside * (size.bit_count() - 1)
        if split < best[last]:
            best[last], come_from[last] = split, i
            tail = np.cumsum([1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1])[:-1].tolist()
    cuts, j = [end], come_from[last]
    cuts += [place[j] + t for t in reversed(tail)]
    while j:
        cuts.append(place[j])
        j = come_from[j]
    return cuts[::-1]


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places of possible cuts and what they cost."""
    ends = np.union1d(doc_ends, sentence_ends)
    before = np.concatenate([[0], ends[:-1]])
    steps = (ends - before - 1) // costs.stretch  # places to add in front of each end
    base = np.repeat(before, steps)
    nth = np.arange(len(base)) - np.repeat(np.cumsum(steps) - steps, steps) + 1
    places = np.concatenate([ends, base + nth * costs.stretch])
    price = np.concatenate([np.where(np.isin(ends, doc_ends), 0, costs.sentence), np.full(len(base), costs.inside)])
    order = np.argsort(places, kind="stable")
    return places[order], price[order]


#: Points and commas that may belong to a longer run of symbols.
_ODD_POINTS = re.compile(r"[^\w\s][.,]|[.,](?:[^\w\s]|_)|_[.,]")
#: The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
_PLAIN_BYTES = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PLAIN_BYTES)}
#: Separates words that are encoded in one call; it is one token where it stands alone.
_MARK = "|"


def words_of(text: str) -> list[str]:
    """Pieces whose tokens, one after the other, are the text's: words, and points and commas by themselves.

    Texts whose characters are all in Latin-1 are put in lower case here, which is what the tokenizer does to them.
    """
    if _ODD_POINTS.search(text):
        return text.split()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.replace(".", " .").replace(",", " ,").split()
    return text.lower().replace(".", " .").replace(",", " ,").split()


class WordTokenizer:
    """Ids of whole texts by way of their words; the tokenizer drops white space and no token crosses it."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.mark = self._ids(_MARK)
        self.table = PieceTable(self._encode_words, flag=lambda w: w.endswith(SENTENCE_ENDS))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Plain words go straight to the merges; the others through the whole tokenizer, many in one call."""
        found: dict[str, bytes] = {}
        merge, others = self.tokenizer.model.tokenize, []
        for w in words:
            if w.isalpha() and w.islower() and max(w) < "\u0100":
                letters = w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_LETTERS)
                found[w] = array("i", [t.id for t in merge(letters)]).tobytes()
            else:
                others.append(w)
        for group in grouped(others, 1 << 16):
            ids = np.array(self._ids(f" {_MARK} ".join([*group, ""])), np.int32)
            ends = np.flatnonzero(ids == self.mark[0])
            if len(self.mark) == 1 and len(ends) == len(group):
                raw, starts = ids.tobytes(), np.concatenate([[0], ends[:-1] + 1])
                for w, a, e in zip(group, (4 * starts).tolist(), (4 * ends).tolist(), strict=True):
                    found[w] = raw[a:e]
            else:
                found |= {w: array("i", self._ids(w)).tobytes() for w in group}
        return [found[w] for w in words]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids one after the other, the number of ids of each text, and the places behind ends of sentences."""
        if any(map(_SEPARATORS.search, texts)):
            all_ids = [self._ids(t) for t in texts]
            lengths = np.array(list(map(len, all_ids)), np.int64)
            return np.concatenate([np.array(i, np.int32) for i in all_ids]), lengths, np.zeros(0, np.int64)
        return self.table.ids_of([words_of(t) for t in texts])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _worker_tokenizer(definition: str) -> WordTokenizer:
    """One tokenizer per worker process, kept for the tasks that follow."""
    if definition not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[definition] = WordTokenizer(definition)
    return _TOKENIZERS[definition]


class _Run:
    """Tokens of neighbouring documents that are packed together."""

    def __init__(self):
        self.keys, self.ids, self.doc_ends, self.sentence_ends, self.size = [], [], [], [], 0

    def add(self, keys: list, ids: np.ndarray, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> None:
        self.keys += keys
        self.ids.append(ids)
        self.doc_ends.append(doc_ends + self.size)
        self.sentence_ends.append(sentence_ends + self.size)
        self.size += len(ids)

    def pieces(self, length: int, costs: Costs) -> dict[str, list | np.ndarray]:
        """Rows (key, start, length, tokens, doc_tokens, sequence, offset); sequences count from 0."""
        ids, doc_ends = np.concatenate(self.ids), np.concatenate(self.doc_ends)
        places, price = candidates(doc_ends, np.concatenate(self.sentence_ends), costs)
        window_ends = np.array(choose_cuts(places, price, length, costs.inside), np.int64)
        ends = np.union1d(doc_ends, window_ends)
        starts = np.concatenate([[0], ends[:-1]])
        doc, window = np.searchsorted(doc_ends, ends), np.searchsorted(window_ends, ends)
        doc_starts, window_starts = np.concatenate([[0], doc_ends[:-1]]), np.concatenate([[0], window_ends[:-1]])
        raw = memoryview(ids.astype("<u4").tobytes())
        return {
            "key": [self.keys[d] for d in doc.tolist()],
            "start": starts - doc_starts[doc],
            "length": ends - starts,
            "tokens": [raw[4 * a : 4 * e].tobytes() for a, e in zip(starts.tolist(), ends.tolist(), strict=True)],
            "doc_tokens": (doc_ends - doc_starts)[doc],
            "sequence": window,
            "offset": starts - window_starts[window],
        }


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    length: int = 4096,
    key: str = "doc_id",
    text: str = "text",
    costs: Costs = Costs(),
    run_tokens: int = 1 << 20,
) -> DataFrame:
    """One row per piece: key, ``start``, ``length``, ``tokens`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence. ``tokenizer`` is the path of a definition for ``tokenizers``."""
    if costs.stretch > length:
        raise ValueError("a sequence must be able to hold the widest stretch without candidate")
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text_"))
    rows = rows.repartitionByRange(F.col(key)).sortWithinPartitions(key, F.xxhash64("text_"))
    longs = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([rows.schema[key], *(T.StructField(c, T.LongType()) for c in longs[:2])])
    schema.add("tokens", T.BinaryType())
    for c in longs[2:]:
        schema.add(c, T.LongType())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_tokenizer(shared.value)
        sequences, run = TaskContext.get().partitionId() << 32, _Run()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequences, run
            p = run.pieces(length, costs)
            columns = [pa.array(p["key"], key_type), pa.array(p["start"]), pa.array(p["length"]), pa.array(p["tokens"], pa.binary())]
            columns += [pa.array(p["doc_tokens"]), pa.array(p["sequence"] + sequences), pa.array(p["offset"])]
            sequences += int(p["sequence"][-1]) + 1
            run = _Run()
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            key_type, keys, done = batch.schema.field(0).type, batch.column(0).to_pylist(), 0
            for group in grouped([t or "" for t in batch.column(1).to_pylist()]):
                ids, lengths, sentences = words.encode(group)
                ends = np.cumsum(lengths)
                # An end id behind each document moves what follows by one.
                run.add(
                    keys[done : done + len(group)],
                    np.insert(ids, ends, end_id),
                    ends + np.arange(1, len(ends) + 1),
                    sentences + np.searchsorted(ends, sentences, "left"),
                )
                done += len(group)
                if run.size >= run_tokens:
                    yield from flush()
        if run.size:
            yield from flush()

    return rows.mapInArrow(each, schema)
