"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the ``k`` least distinct hashes of a text's shingles (all, if it has fewer). Sketches of parts merge into the
sketch of the whole, and estimate the number of distinct shingles, resemblance and containment; for texts with at most
``k`` distinct shingles the estimates are exact.

``compare_neighbours`` sketches every document, the edited text that takes its end from the next document, and says how alike
they are. Documents are dealt out by ranges of the key whose borders are keys that exist; the first document of a range is
sent to the range before as well, so every document meets its successor in one task and texts move once, packed.

Defined cases: a null text is empty; texts without words have the empty sketch, two of which are fully alike, while an empty
and another one are not alike at all. Equal texts have equal sketches. Repeated keys follow each other ordered by a hash
of their texts, null keys come last. Columns other than key and text are not part of the result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import free_name
from orderlake.llm.shingles import encoded, grouped_bytes, shingle_hashes

K = 256


def sketches(texts: list[bytes], k: int = K, size: int = 5) -> list[np.ndarray]:
    """The k least distinct shingle hashes of each text, ascending."""
    hashes, bounds = shingle_hashes(texts, size)
    out = []
    for a, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        mine = hashes[a:e]
        if e - a > 8 * k:
            # Repeats can push the k-th distinct hash back, so take more until there are k.
            take = 4 * k
            while True:
                low = np.unique(np.partition(mine, take)[:take]) if take < len(mine) else np.unique(mine)
                if len(low) >= k or take >= len(mine):
                    break
                take *= 4
        else:
            low = np.unique(mine)
        out.append(low[:k])
    return out


def merged(parts: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of all parts together."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, np.uint64)


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) / ((float(sketch[k - 1]) + 1.0) / 2.0**64)


def _least_of_both(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """Size of the union's sketch, and how many of its hashes are in both."""
    both = np.sort(np.concatenate([a, b]))
    same = both[1:] == both[:-1]
    distinct = np.cumsum(np.concatenate([[True], ~same])) if len(both) else np.zeros(0, np.int64)
    n = min(k, int(distinct[-1]) if len(both) else 0)
    return n, int(np.count_nonzero(same & (distinct[1:] <= n)))


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the distinct shingles of both texts that both have."""
    n, shared = _least_of_both(a, b, k)
    return shared / n if n else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the distinct shingles of the first text that the second has too."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, k) * distinct_count(merged([a, b], k), k)
    return min(1.0, common / distinct_count(a, k))


def as_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8").astype(np.uint64)


def fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint", k: int = K) -> DataFrame:
    """The rows with the text's sketch (``binary``, little-endian 64-bit hashes, ascending)."""
    own = [c for c in docs.columns if c.lower() != into.lower()]
    hidden = free_name([*own, into], "text_")
    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text}`").alias(hidden))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(into, T.BinaryType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                s.astype("<u8").tobytes()
                for group in grouped_bytes(encoded(batch.column(len(own)).to_pylist()))
                for s in sketches(group, k)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], pa.array(found, pa.binary())], names=[*own, into])

    return rows.mapInArrow(each, schema)


def merge_fingerprints(sketched: DataFrame, by: list[str], sketch: str = "fingerprint", k: int = K) -> DataFrame:
    """One sketch per group of rows: that of all the group's shingles together.

    Hashes are counted once per group and ranked by the engine, so a group's rows are never gathered in one place.
    """
    schema = T.StructType([*(sketched.schema[c] for c in by), T.StructField("h", T.LongType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(s or b"", "<u8") for s in batch.column(len(by)).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(parts)), [len(p) for p in parts]))
            # As signed numbers in the same order.
            h = np.concatenate([*parts, np.zeros(0, np.uint64)]) ^ np.uint64(1 << 63)
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(len(by))), pa.array(h.view(np.int64))], names=schema.names)

    hashes = sketched.select(*by, sketch).mapInArrow(each, schema).distinct()
    least = hashes.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).where(F.col("r") <= k)
    lists = least.groupBy(*by).agg(F.array_sort(F.collect_list("h")).alias("h"))
    packed = T.StructType([*(sketched.schema[c] for c in by), T.StructField(sketch, T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.array(h, np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype("<u8").tobytes() for h in batch.column(len(by)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(by)], pa.array(found, pa.binary())], names=packed.names)

    return lists.mapInArrow(pack, packed)


def _borders(docs: DataFrame, key: str, parts: int) -> list[int]:
    """Keys that exist, descending, the greatest first: each is the first of a range."""
    shares = [i / parts for i in range(1, parts)] or [0.5]
    inner, greatest = docs.agg(F.percentile_approx(F.col(key), shares, 100 * parts), F.max(key)).head()
    return sorted({*(inner or []), greatest} - {None}, reverse=True)


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per document: key, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (base64), ``near_edited``
    and ``near_next``. The next document is that of the next smaller key, after the last the first; the edited text has the last
    third of the characters replaced by as many from the next document's beginning."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{text}`").alias("text_"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    borders = _borders(docs, key, parts)
    ascending = np.array(borders[::-1], np.int64)
    n = max(1, len(borders))
    dealt = "part int, guest boolean, k long, tie long, z binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            keys = batch.column(0)
            value = keys.fill_null(0).to_numpy(zero_copy_only=False)
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            # Range r holds keys from border r downwards to above border r + 1; the least keys and nulls are in the last.
            part = np.where(known, n - 1 - np.searchsorted(ascending, value, "left"), n - 1)
            first = known & np.isin(value, ascending)
            texts = encoded(batch.column(1).to_pylist())
            ties = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=7).digest(), "big") for t in texts], np.int64)
            z = pa.array([pack.compress(t) for t in texts], pa.binary())
            for rows, to, guest in ((np.arange(len(texts)), part, False), (np.flatnonzero(first), (part - 1) % n, True)):
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(to[rows].astype(np.int32)),
                        pa.array(np.full(len(rows), guest)),
                        keys.take(at),
                        pa.array(ties[rows]),
                        z.take(at),
                    ],
                    names=["part", "guest", "k", "tie", "z"],
                )

    # Guests come behind the range's own documents; of several with the border's key the first is the successor.
    order = ["part", "guest", F.col("k").desc_nulls_last(), "tie"]
    ranged = docs.mapInArrow(deal, dealt).repartitionById(n, F.col("part")).sortWithinPartitions(*order)
    schema = T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("n_chars", T.LongType()),
            *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
            *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")),
        ]
    )

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        """Rows (key, text, own) in order; every row but the last is followed by its successor."""
        texts = [t for _, t, _ in rows]
        mine = sketches(encoded(texts), k)
        edited = []
        for t, following in zip(texts, texts[1:], strict=False):
            third = len(t) // 3
            edited.append(t[: len(t) - third] + following[:third])
        raw = encoded(edited)
        theirs = sketches(raw, k) if raw else []
        columns: list[list] = [[] for _ in schema.names]
        for i, (name, t, own) in enumerate(rows[:-1]):
            if own:
                values = (name, len(t), hashlib.sha256(raw[i]).hexdigest(), as_text(mine[i]), as_text(theirs[i]))
                values += (resemblance(mine[i], theirs[i], k), resemblance(mine[i], mine[i + 1], k))
                for column, v in zip(columns, values, strict=True):
                    column.append(v)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=schema.names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        start, size = None, 0
        for batch in batches:
            for guest, name, z in zip(*(batch.column(c).to_pylist() for c in ("guest", "k", "z")), strict=True):
                t = unpack.decompress(z).decode("utf-8", "surrogatepass")
                start = start or (name, t)
                rows.append((name, t, not guest))
                size += len(t)
                if size > 1 << 20:
                    yield compared(rows)
                    rows, size = rows[-1:], len(t)
        if rows:
            if rows[-1][2]:  # only where all keys are null: there are no borders, and the first row follows the last
                rows.append((*start, False))
            yield compared(rows)

    return ranged.mapInArrow(walk, schema)
