"""Near-duplicate classes over bags of word shingles: BagMinHash signatures, bands, exact verification.

A text is a bag of five-word shingles with counts. For every shingle, count ranges (0,1], (1,2], (2,4], (4,8], ... are the nodes of
a hierarchy; each has a Poisson process of a rate as wide as the node, seeded by the shingle. A point carries a slot and a place
in the node, and belongs to a bag if the place is within the bag's count. The first point of each slot is the signature:
two bags agree in a slot with the probability of their weighted Jaccard similarity. Points are generated in order of time and only
as far as a bag's slots can need them.

Then: bags that agree in a band are put in one family (links go from each member of a bucket to the bucket's least member, so a bucket
of any size costs one link per member). Within a family all bags are compared exactly, multiset against multiset, in square
blocks of bounded size dealt out over tasks; a block reports the links that join its classes, not its pairs. Classes are the
components of links of similarity ``threshold`` or more.

Defined cases: a null text is empty. Texts without words have no bag; they are alike only if they are equal. Equal texts
are always in one class. A class is named by its least key; null keys are in classes like others but name one only when it
has no other key. ``near_duplicates`` returns the key and the class alone, ``keep_one`` all columns of the rows that stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import drop_tables, release, written
from orderlake.llm.components import connected_components
from orderlake.llm.shingles import encoded, grouped_bytes, mix, shingle_hashes

BANDS, ROWS = 40, 5
#: Text keys that a task remembers.
SEEN = 1 << 18
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count) of each distinct shingle of each text."""
    hashes, bounds = shingle_hashes(texts, size)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(fresh)
    return owner[first], hashes[first], np.diff(np.append(first, len(owner)))


def _nodes(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray):
    """The count ranges that each shingle's count reaches into: owner, seed, lower end, width, count."""
    parts, low, level = [], 0, 0
    while len(owner):
        width = max(low, 1)
        parts.append((owner, mix(hashes + np.uint64(level * int(_GOLD) % 2**64)), np.full(len(owner), low), np.full(len(owner), width), counts))
        low, level = low + width, level + 1
        deeper = counts > low
        owner, hashes, counts = owner[deeper], hashes[deeper], counts[deeper]
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int, slots: int) -> np.ndarray:
    """The first arrival time in each slot, for n bags; infinite where a bag is empty."""
    out = np.full(n * slots, np.inf)
    weight = np.bincount(owner, counts, n) if len(owner) else np.zeros(n)
    limit = np.divide(1.8 * slots * np.log(slots + 1.0), weight, out=np.zeros(n), where=weight > 0)
    todo = weight > 0
    while todo.any():
        mine = todo[owner]
        bag, seed, low, width, count = _nodes(owner[mine], hashes[mine], counts[mine])
        time, point, step = np.zeros(len(bag)), 0, 1
        while len(bag):
            numbers = np.arange(point, point + step, dtype=np.uint64)
            drawn = mix(seed[:, None] + (numbers * np.uint64(2) + np.uint64(1)) * _GOLD)
            gaps = -np.log(((drawn >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / width[:, None]
            gaps[:, 0] += time
            times = np.cumsum(gaps, axis=1)
            drawn = mix(drawn ^ _GOLD)
            slot = ((drawn >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)
            place = low[:, None] + 1 + ((drawn & np.uint64(0xFFFFFFFF)) % width[:, None].astype(np.uint64)).astype(np.int64)
            kept = (times <= limit[bag][:, None]) & (place <= count[:, None])
            np.minimum.at(out, (bag[:, None] * slots + slot)[kept], times[kept])
            time, point = times[:, -1], point + step
            going = time <= limit[bag]
            bag, seed, low, width, count, time = (c[going] for c in (bag, seed, low, width, count, time))
            step = 1 if point < 4 else min(64, point // 2)
        # A slot that got no point in time needs a longer time for its bag.
        todo &= np.isinf(out.reshape(n, slots)).any(axis=1)
        limit = limit * 2.0
    return out.reshape(n, slots)


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One number per band, the band's own number mixed in."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        out = mix(out * _GOLD + bits[:, :, r])
    return out.view(np.int64)


def text_key(text) -> Column:
    """128 bits that name a text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _signed(slim: DataFrame) -> DataFrame:
    """(key, text key, band numbers) of each row; no bands for a text without words, or one that the task has had before."""
    schema = T.StructType([*slim.schema.fields[:2], T.StructField("bands", T.ArrayType(T.LongType()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # a text whose key was forgotten only has its bands twice
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            fresh = [k not in seen and not seen.add(k) for k in batch.column(1).to_pylist()]
            texts, done = encoded(batch.column(2).to_pylist()), 0
            for group in grouped_bytes([t if f else b"" for t, f in zip(texts, fresh, strict=True)]):
                owner, hashes, counts = bags(group)
                times = signatures(owner, hashes, counts, len(group), BANDS * ROWS)
                full = np.isfinite(times).all(axis=1)
                values = band_hashes(np.where(full[:, None], times, 0.0))
                offsets = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[full].ravel()))
                here = batch.slice(done, len(group))
                done += len(group)
                yield pa.RecordBatch.from_arrays([here.column(0), here.column(1), lists], names=schema.names)

    return slim.mapInArrow(each, schema)


def _packed(df: DataFrame) -> DataFrame:
    """The last column, a text, packed; it shuffles at about half its size."""
    schema = T.StructType([*df.schema.fields[:-1], T.StructField("z", T.BinaryType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([pack.compress(t) for t in encoded(batch.columns[-1].to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], z], names=schema.names)

    return df.mapInArrow(each, schema)


def alike(texts: list[bytes], threshold: float, columns: int = 4096) -> np.ndarray:
    """Which texts have bags of weighted Jaccard similarity ``threshold`` or more: shared occurrences, counted exactly."""
    hashes, bounds = shingle_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    size = np.diff(bounds).astype(np.float64)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    # The i-th occurrence of a shingle is an item of its own, which makes bags sets.
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    nth = np.arange(len(owner)) - np.maximum.accumulate(np.where(fresh, np.arange(len(owner)), 0))
    items = mix(hashes + nth.astype(np.uint64) * _GOLD)
    _, item, seen = np.unique(items, return_inverse=True, return_counts=True)
    common = seen[item] > 1
    owner, item = owner[common], item[common]
    _, item = np.unique(item, return_inverse=True)
    by_item = np.argsort(item, kind="stable")
    owner, item = owner[by_item], item[by_item]
    shared = np.zeros((len(texts), len(texts)), np.float32)
    top = int(item[-1]) + 1 if len(item) else 0
    for start in range(0, top, columns):
        a, e = np.searchsorted(item, [start, start + columns])
        present = np.zeros((len(texts), columns), np.float32)
        present[owner[a:e], item[a:e] - start] = 1.0
        shared += present @ present.T
    shared = shared.astype(np.float64)
    near = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
    np.fill_diagonal(near, True)  # what only one text has wasn't counted
    return near


def _least_reachable(near: np.ndarray) -> np.ndarray:
    """For each row the least row of its component."""
    label = np.arange(len(near))
    while True:
        lower = np.where(near, label[None, :], len(near)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _verified(families: DataFrame, slim: DataFrame, first_rows: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links (a, b) that join what a family's blocks hold of each class."""
    sizes = written(families.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "family_sizes")
    members = families.join(sizes, "root").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    # One row per text: copies differ in their keys, so that no text's rows meet in one task.
    members = members.join(first_rows, "k").withColumnsRenamed({"k": "k_", "key_": "key__"})
    same = F.col("key_").eqNullSafe(F.col("key__")) & (F.col("k") == F.col("k_"))
    texts = _packed(slim).join(members, same).select("k", "root", "z", "blocks", "own").dropDuplicates(["k"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = texts.select("k", "root", "z", "own", other)
    dealt = dealt.select("k", "root", "z", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    parts = int(families.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j", "k")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def links(keys: list[bytes], texts: list[bytes]) -> pa.RecordBatch:
            label = _least_reachable(alike(texts, threshold))
            pairs = [(k, keys[r]) for i, (k, r) in enumerate(zip(keys, label.tolist(), strict=True)) if r != i]
            return pa.RecordBatch.from_arrays([pa.array([p[s] for p in pairs], pa.binary()) for s in (0, 1)], names=["a", "b"])

        at, keys, texts = None, [], []
        for batch in batches:
            for k, root, z, i, j in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (root, i, j) != at:
                    if len(keys) > 1:
                        yield links(keys, texts)
                    at, keys, texts = (root, i, j), [], []
                keys.append(k)
                texts.append(unpack.decompress(z))
        if len(keys) > 1:
            yield links(keys, texts)

    return dealt.mapInArrow(each, "a binary, b binary")


def _slim(docs: DataFrame, key: str, text: str) -> DataFrame:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("key_"), text_key(content).alias("k"), content.alias("text_"))


def _rooted(docs: DataFrame, key: str, text: str, threshold: float, block: int) -> DataFrame:
    """(key_, k, root) of every row: rows with one root are one class."""
    spark, slim = docs.sparkSession, _slim(docs, key, text)
    signed = written(_signed(slim), "signatures")
    # A text is here once for each task that has it, so a bucket is of one text if its least and greatest are the same.
    bucket = signed.select("k", F.explode("bands").alias("bucket"))
    least = bucket.groupBy("bucket").agg(F.min("k").alias("b"), F.max("k").alias("last")).where("b < last").select("bucket", "b")
    least = written(least, "bucket_centres")
    links = bucket.join(least, "bucket").select(F.col("k").alias("a"), "b").where("a != b")
    families = connected_components(links, "families")
    release(spark)
    first_rows = signed.groupBy("k").agg(F.min("key_").alias("key_"))
    classes = connected_components(_verified(families, slim, first_rows, threshold, block), "classes")
    release(spark)
    # Rows of one text have one key of the text, so copies are in a class whether it has links or not.
    return signed.select("key_", "k").join(classes, "k", "left").withColumn("root", F.coalesce("root", "k"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, block: int = 400) -> DataFrame:
    """One row per row of ``docs``: key, ``class_id`` (least key of the class) and ``class_size`` (its rows)."""
    rooted = written(_rooted(docs, key, text, threshold, block), "rooted")
    named = rooted.groupBy("root").agg(F.min("key_").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    named = written(named, "class_names")  # a join of two plain tables, so that a large class is split
    return rooted.join(named, "root").select(F.col("key_").alias(key), "class_id", "class_size")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, block: int = 400) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: the one with the least key of each class stays."""
    rooted = _rooted(docs, key, text, threshold, block)
    order = F.struct(F.col("key_").isNull().alias("last"), "key_", "k")
    stay = written(rooted.groupBy("root").agg(F.min(order).alias("s")).select("s.key_", "s.k"), "stay")
    stay = stay.withColumnsRenamed({"key_": "stay_key_", "k": "stay_k"})
    same = F.col(f"`{key}`").eqNullSafe(F.col("stay_key_")) & (text_key(F.coalesce(F.col(f"`{text}`"), F.lit(""))) == F.col("stay_k"))
    kept = docs.join(stay, same)
    # A row that is there twice is a copy of itself.
    return kept.dropDuplicates(["stay_key_", "stay_k"]).select(*[F.col(f"`{c}`") for c in docs.columns])
