"""Exact removal of long repeated strings: q-gram buckets, refined by identifiers of later offsets.

Every byte covered by a string of ``min_bytes`` bytes that also starts anywhere else, in the same or another
text, is found and removed. The identifier of a string of ``2h`` bytes is made from those of its halves, so that the identifiers of
q-grams give those of all longer strings (``_ladder``), and a string of any length has one made from those at a few offsets (``_cover``).
Buckets begin as equal q-grams. Each round sorts what is left by (bucket, identifier at later offsets); the pair is the new bucket, which
the next round refines in turn:

* Of each ``min_bytes`` window only the q-gram with the least identifier counts (equal windows pick the
  same one), so one suffix stands for a run of windows, a *phrase*, in its q-gram's bucket.
* Round 1: buckets with one member are final. The others are refined by the identifiers at all offsets of a phrase's extent: phrases
  equal in all of it are repeated.
* Round 2: phrases that stand alone, next to others of their bucket, are cut into blocks of offsets from the anchor. Their bucket is
  refined by the identifiers at the block's common core; buckets with one member are final. Then by those at the block's whole extent: equal blocks are repeated.
* Round 3: buckets of blocks that stand alone are refined by the identifiers of single windows.

Identifiers are made of the bytes alone, so a phrase finds those of its later offsets in its own text, and the table of all suffixes' buckets is
never written: at sf0.01 and 400 bytes it would hold 2,409,972 suffixes and 11.0 times the input's size (sorted by bucket, Parquet with zstd), for each
doubling; the phrases are 17,930 (116 windows each) and 0.085 times.

Buckets are counted, never gathered: a passage that a third of all texts share costs one partial count per task.
Identifiers are 64-bit hashes; a wrong match needs two different strings that agree in their bucket and in the identifier
that refines it. Rounds are written tables, so lost executors repeat tasks only.

Defined cases: a null text is empty; texts shorter than ``min_bytes`` lose nothing; exact copies remove each other
entirely (from ``min_bytes`` on); an empty table stays empty. Texts of any length are scanned in bounded segments. Input columns are
carried through; one named like a result column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import drop_tables, free_name, release, written

RESULT = ("n_bytes", "spans", "kept")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xBF58476D1CE4E5B9)
_BYTE_IDS = np.random.default_rng(400).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Windows that are looked at together.
SEGMENT = 1 << 17
#: Offsets to the anchor that form one block in round 2.
BLOCK = 32
_WIDTH = 1 << 20


@dataclass(frozen=True)
class Extent:
    """Length of the strings that count, and of the q-grams that buckets start from (a power of two)."""

    size: int
    gram: int

    @property
    def core(self) -> int:
        """Length of what all windows of a block have in common; 0 where it has no q-gram."""
        return self.size - BLOCK + 1 if self.size - BLOCK + 1 >= self.gram else 0

    def step(self, length: int) -> int:
        """The longest strings of the ladder that are not longer."""
        return self.gram << (length // self.gram).bit_length() - 1

    @staticmethod
    def of(size: int) -> Extent:
        if size < 8:
            raise ValueError("strings of less than 8 bytes can't be told apart by q-grams")
        return Extent(size, min(64, 1 << ((size // 2).bit_length() - 1)))


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bucket identifier of a string from those of its two halves."""
    x = first * _MULTIPLIER
    x ^= second
    x *= _SECOND
    x ^= x >> np.uint64(29)
    x *= _MULTIPLIER
    x ^= x >> np.uint64(32)
    return x


def _ladder(raw: np.ndarray, extent: Extent) -> dict[int, np.ndarray]:
    """By length, for the q-gram's and its doublings up to ``size``: identifiers of the strings that start at each place."""
    ids, h, found = _BYTE_IDS[raw], 1, {}
    while h * 2 <= extent.size:
        ids = _pair(ids[:-h], ids[h:])
        h *= 2
        if h in (extent.gram, extent.step(extent.size), extent.core and extent.step(extent.core)):
            found[h] = ids
    return found


def _cover(ids: np.ndarray, step: int, start: np.ndarray, end: np.ndarray, most: int) -> np.ndarray:
    """Identifiers of strings of ``step`` to ``most`` bytes, from those of ``step`` bytes at offsets 0, step, 2 step, ... and at their end."""
    name = ids[start]
    for offset in range(step, most, step):
        name = _pair(name, ids[np.minimum(start + offset, end - step)])
    return name


def _anchors(ids: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` identifiers the place of the least, of several the last."""
    at, h = np.arange(len(ids), dtype=np.int32), 1

    def lesser(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(ids[b] <= ids[a], b, a)

    while h * 2 <= width:
        at = lesser(at[:-h], at[h:])
        h *= 2
    rest = width - h
    return lesser(at[: len(at) - rest], at[rest:]) if rest else at


def phrases(raw: np.ndarray, offsets: np.ndarray, extent: Extent) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor in texts laid end to end: first window, last window, anchor, identifiers of q-gram and whole extent.

    No run crosses a text's border; segments may cut one, which only leaves more to the later rounds.
    """
    n, size = int(offsets[-1]), extent.size
    change = np.zeros(n + 1, np.int32)
    border = np.zeros(n + 1, bool)
    long_enough = np.flatnonzero(np.diff(offsets) >= size)
    np.add.at(change, offsets[long_enough], 1)
    np.add.at(change, offsets[long_enough + 1] - size + 1, -1)
    border[offsets[long_enough]] = True
    valid = np.cumsum(change[:n]) > 0
    for start in range(0, n - size + 1, SEGMENT):
        stop = min(start + SEGMENT, n - size + 1)
        here = np.flatnonzero(valid[start:stop])
        if not len(here):
            continue
        ladder = _ladder(raw[start : stop - 1 + size], extent)
        ids = ladder[extent.gram]
        at = _anchors(ids, size - extent.gram + 1)[here]
        fresh = np.ones(len(here), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (np.diff(here) > 1) | border[start + here[1:]]
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(here)) - 1
        begin, last, at = here[first], here[last], at[first].astype(np.int64)
        full = _whole(ladder, extent, begin, last, at, 2 * size)
        yield start + begin, start + last, start + at, ids[at].view(np.int64), full.view(np.int64)


def _span(first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Where the anchor lies behind the first window, and how many windows follow that one."""
    return (anchor - first) * _WIDTH + (last - first)


def _whole(ladder: dict[int, np.ndarray], extent: Extent, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, most: int) -> np.ndarray:
    """Identifiers of runs of windows with all their bytes, as they lie about the anchor."""
    step = extent.step(extent.size)
    return _pair(_cover(ladder[step], step, first, last + extent.size, most), _span(first, last, anchor).view(np.uint64))


def _text_key(raw) -> tuple[int, int]:
    d = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _encoded(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _pieces(texts: list[bytes], most: int = 2 << 20) -> Iterator[list[bytes]]:
    """Texts in groups of bounded total size; a longer text is a group of its own."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > most:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _phrase_rows(docs: DataFrame, extent: Extent) -> DataFrame:
    """(bucket, full, k1, k2, place): ``place`` packs the run's first window, its anchor and its length."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _pieces(_encoded(batch.column(0))):
                blob = b"".join(texts)
                offsets = np.cumsum([0, *map(len, texts)])
                keys = np.array([_text_key(t) for t in texts], np.int64)
                for first, last, at, bucket, full in phrases(np.frombuffer(blob, np.uint8), offsets, extent):
                    doc = np.searchsorted(offsets, first, "right") - 1
                    columns = [bucket, full, keys[doc, 0], keys[doc, 1], first - offsets[doc], _span(first, last, at)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "full", "k1", "k2", "first", "span"])

    return docs.mapInArrow(each, "bucket long, full long, k1 long, k2 long, first long, span long")


@dataclass(frozen=True)
class Open:
    """Strings that a round left open: bucket, first window, ``_span``, number of members, and the text of each."""

    bucket: np.ndarray
    first: np.ndarray
    span: np.ndarray
    n: np.ndarray
    text: np.ndarray

    def __getitem__(self, rows) -> Open:
        return Open(*(c[rows] for c in (self.bucket, self.first, self.span, self.n, self.text)))

    @property
    def anchor(self) -> np.ndarray:
        return self.first + self.span // _WIDTH

    @property
    def last(self) -> np.ndarray:
        return self.first + self.span % _WIDTH

    def spread(self, counts: np.ndarray) -> tuple[Open, np.ndarray]:
        """Each string ``counts`` times, with numbers from 0."""
        at = np.repeat(np.arange(len(counts)), counts)
        return self[at], np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)


def _blocks(ladder: dict[int, np.ndarray], strings: Open, extent: Extent) -> tuple[np.ndarray, np.ndarray, Open]:
    """Refined buckets and whole identifiers of the blocks of phrases."""
    lowest = (strings.anchor - strings.last) // BLOCK
    of, i = strings.spread((strings.anchor - strings.first) // BLOCK - lowest + 1)
    k = (of.anchor - of.last) // BLOCK + i
    top = of.anchor - k * BLOCK
    first, last = np.maximum(of.first, top - BLOCK + 1), np.minimum(of.last, top)
    bucket = _pair(of.bucket.view(np.uint64), k.view(np.uint64))
    if extent.core:
        step = extent.step(extent.core)
        bucket = _pair(bucket, _cover(ladder[step], step, top, top + extent.core, extent.core))
    full = _whole(ladder, extent, first, last, of.anchor, extent.size + BLOCK)
    return bucket, full, Open(bucket, first, _span(first, last, of.anchor), of.n, of.text)


def _windows(ladder: dict[int, np.ndarray], strings: Open, extent: Extent) -> tuple[np.ndarray, np.ndarray, Open]:
    """Buckets and identifiers of the single windows of blocks."""
    of, i = strings.spread(strings.span % _WIDTH + 1)
    first, step = of.first + i, extent.step(extent.size)
    full = _cover(ladder[step], step, first, first + extent.size, extent.size)
    return of.bucket, full, Open(of.bucket, first, np.zeros(len(first), np.int64), of.n, of.text)


def _from_texts(texts: DataFrame, extent: Extent, single: bool) -> DataFrame:
    """The blocks of the listed phrases, or the windows of the listed blocks, of each text."""

    def of_group(batch: pa.RecordBatch, offsets: list[int], blob: bytes) -> Iterator[pa.RecordBatch]:
        listed = batch.column("listed")
        text = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy(zero_copy_only=False))
        bucket, first, span, n = (np.asarray(c, np.int64) for c in listed.flatten().flatten())
        strings = Open(bucket, first + np.array(offsets)[text], span, n, text)
        strings, raw = strings[np.argsort(strings.first, kind="stable")], np.frombuffer(blob, np.uint8)
        keys = [batch.column(c).to_numpy() for c in ("k1", "k2")]
        i = 0
        while i < len(strings.first):
            begin = int(strings.first[i])
            j = int(np.searchsorted(strings.first, begin + SEGMENT))
            part = strings[i:j]
            ladder = _ladder(raw[begin : int(part.last.max()) + extent.size], extent)
            part = Open(part.bucket, part.first - begin, part.span, part.n, part.text)
            bucket, full, found = (_windows if single else _blocks)(ladder, part, extent)
            first = found.first + begin - np.array(offsets)[found.text]
            columns = [bucket.view(np.int64), full.view(np.int64), found.n, keys[0][found.text], keys[1][found.text], first, found.span]
            out = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "full", "n", "k1", "k2", "first", "span"])
            yield from (out.slice(at, 20_000) for at in range(0, out.num_rows, 20_000))
            i = j

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            group, offsets, start = [], [], 0
            for row in range(batch.num_rows):
                offsets.append(sum(map(len, group[-1:])) + (offsets[-1] if offsets else 0))
                group.append(unpack.decompress(batch.column("z")[row].as_py()))
                if offsets[-1] + len(group[-1]) > SEGMENT or row + 1 == batch.num_rows:
                    yield from of_group(batch.slice(start, row + 1 - start), offsets, b"".join(group))
                    group, offsets, start = [], [], row + 1

    return texts.mapInArrow(each, "bucket long, full long, n long, k1 long, k2 long, first long, span long")


def _kinds(rows: DataFrame, n) -> DataFrame:
    """Each bucket refined by the whole identifiers: the number of strings in it, and one place where it stands."""
    place = F.struct("k1", "k2", "first", "span")
    return rows.groupBy("bucket", "full").agg(F.sum(n).alias("n"), F.min(place).alias("place"))


def _undecided(kinds: DataFrame, keep) -> DataFrame:
    """Kinds of the buckets in which a string stands alone among others of another kind."""
    of_bucket = kinds.groupBy("bucket").agg(F.sum("n").alias("total"), F.min("n").alias("least"))
    open_buckets = keep(of_bucket.where((F.col("least") == 1) & (F.col("total") > 1)).select("bucket"), "open_buckets")
    return kinds.join(open_buckets, "bucket", "left_semi")


def _listed(kinds: DataFrame) -> DataFrame:
    item = F.struct("bucket", F.col("place.first").alias("first"), F.col("place.span").alias("span"), F.col("n").cast("long").alias("n"))
    return kinds.groupBy("place.k1", "place.k2").agg(F.collect_list(item).alias("listed"))


def _repeated(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """Rows whose string is there more than once."""
    return rows.join(kinds.where("n > 1").select("bucket", "full"), ["bucket", "full"], "left_semi")


def _keyed(docs: DataFrame, text: str, carried: str, once: bool = False) -> DataFrame:
    """Each row with its text's key and the text packed, so that it shuffles at about half its size.

    With ``once`` a task gives each text once, so that one which very many rows hold is not worked on for each of them.
    """
    schema = T.StructType(
        [docs.schema[carried], *(T.StructField(c, T.LongType()) for c in ("k1", "k2", "n_bytes")), T.StructField("z", T.BinaryType())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        seen: set[tuple[int, int]] = set()  # keys of the task's texts
        for batch in batches:
            texts = _encoded(batch.column(1))
            keys = [_text_key(t) for t in texts]
            if once:
                fresh = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
                batch, texts, keys = batch.take(pa.array(fresh, pa.int64())), [texts[i] for i in fresh], [keys[i] for i in fresh]
            keys = np.array(keys, np.int64).reshape(-1, 2)
            sizes = pa.array(list(map(len, texts)), pa.int64())
            packed = pa.array([pack.compress(t) for t in texts], pa.binary())
            columns = [batch.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1]), sizes, packed]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(carried, text).mapInArrow(each, schema)


def _unite(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, e in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((a, e))
    return out


def _cut(marked: DataFrame, carried: str, size: int, as_text: bool) -> DataFrame:
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [
            marked.schema[carried],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
        ]
    )
    arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            spans, kept = [], []
            for z, marks in zip(batch.column("z").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                text = unpack.decompress(z)
                cuts = _unite([(m["first"], m["first"] + m["width"] + size) for m in marks or []])
                spans.append([{"start": a, "end": e} for a, e in cuts])
                edges = [0, *(x for c in cuts for x in c), len(text)]
                kept.append(b"".join(text[a:e] for a, e in zip(edges[::2], edges[1::2], strict=True)))
            if as_text:
                kept = [k.decode("utf-8", "ignore") for k in kept]
            columns = [batch.column(carried), batch.column("n_bytes"), pa.array(spans, arrow_span)]
            columns.append(pa.array(kept, pa.string() if as_text else pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return marked.mapInArrow(each, schema)


def remove_repeats(docs: DataFrame, text: str = "text", min_bytes: int = 400, kept_as_text: bool = False) -> DataFrame:
    """The rows with ``n_bytes``, ``spans`` (maximal removed byte runs) and ``kept`` (the other bytes, binary).

    As text, ``kept`` leaves out what is left of characters that a removed run begins or ends in.
    """
    spark, extent = docs.sparkSession, Extent.of(min_bytes)
    own = [c for c in docs.columns if c.lower() not in RESULT]
    carried = free_name(["k1", "k2", "z", "n_bytes", "marks", "text_"], "carried")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias(carried), F.col(f"`{text}`").alias("text_"))
    done: list[DataFrame] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        # Besides cutting lineage, this leaves joins of plain tables, whose hot keys Spark splits at run time.
        done.append(written(df, name))
        release(spark)
        return done[-1]

    # Round 1: q-gram buckets, refined by whole phrases.
    runs = keep(_phrase_rows(rows.select("text_"), extent), "phrases")
    shared = keep(runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "shared_buckets")
    runs = keep(runs.join(shared, "bucket", "left_semi"), "shared_phrases")
    drop_tables(done[:2])
    del done[:2]
    kinds = keep(_kinds(runs, F.lit(1)), "phrase_kinds")
    place = ["k1", "k2", "first", (F.col("span") % _WIDTH).alias("width")]
    marks = [keep(_repeated(runs, kinds).select(*place).distinct(), "marks1")]
    packed = _keyed(rows, "text_", carried)
    # Round 2: buckets of undecided phrases refined by their blocks. A string that stands alone is in one text only; copies of other texts
    # raise counts that are over 1 anyway.
    listed = keep(_listed(_undecided(kinds, keep)), "open_phrases")
    once = _keyed(rows, "text_", carried, once=True).select("k1", "k2", "z")
    texts = keep(once.join(listed, ["k1", "k2"]), "open_texts")
    blocks = keep(_from_texts(texts, extent, single=False), "blocks")
    kinds = keep(_kinds(blocks, F.col("n")), "block_kinds")
    alone = blocks.where("n = 1")
    marks.append(keep(_repeated(alone, kinds).select(*place), "marks2"))
    # Round 3: buckets of undecided blocks refined by their windows.
    listed = keep(_listed(_undecided(kinds, keep)), "open_blocks")
    windows = keep(_from_texts(texts.drop("listed").join(listed, ["k1", "k2"]), extent, single=True), "windows")
    kinds = keep(_kinds(windows, F.col("n")), "window_kinds")
    alone = windows.where("n = 1")
    marks.append(keep(_repeated(alone, kinds).select(*place), "marks3"))
    drop_tables([t for t in done if all(t is not m for m in marks)])
    every = marks[0].unionByName(marks[1]).unionByName(marks[2])
    of_text = written(every.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "width")).alias("marks")), "marks")
    drop_tables(marks)
    cut = _cut(packed.join(of_text, ["k1", "k2"], "left"), carried, min_bytes, kept_as_text)
    return cut.select(f"{carried}.*", "n_bytes", "spans", "kept")
