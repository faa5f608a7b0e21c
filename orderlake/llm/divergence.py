"""Source divergence audit: how far the term frequencies of each source of a language are from the others'.

Which terms count (those in at least ``least_docs`` documents of their language) is found by iceberg prefix refinement. A
term is its bytes and an end mark; level by level the prefixes of all terms are counted by the documents that hold
them, a prefix with too few documents goes with everything below it, and the prefixes that stay are extended (to 6, 12, 24, 48, ...
bytes). A prefix that reaches the end mark is a complete term and stays for good. A document counts once for each
prefix, however many of its terms have it.

Texts are read once, into a written table of each document's different terms in order, with how much of each term is that of the one
before it: a term begins a prefix of its document where it has less in common than the prefix is long. A level
adds up counts in its tasks before anything is shuffled. What stays is told to the next level's tasks as a bitmap of hashes (at most
8 MB, whatever the corpus): a false hit only costs a count, since every level counts the prefixes themselves and the last join is on whole terms.

Frequencies are ``p = 1 + (scale * (count + smoothing)) div (N + smoothing * V)`` in whole numbers. Sources are compared in
blocks of terms: a block has at most a few million numbers (sources times terms), mostly far fewer, and its sums are added up afterwards. A language with
very many sources has each block compared for 256 sources at a time.

Defined cases: null text, language and source are ''. Every row is a document of its own, also where keys or texts repeat; a group
whose documents have no terms still has its rows in ``pair``. A language without kept terms gives pairs of value 0
and no terms. Equal values are ranked by the item's bytes. An empty table gives no rows; a text of any length is read whole, in one
task. Other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm import terms
from orderlake.llm.common import drop_tables, written

#: Most bits of a level's bitmap, as a power of two, and how many there are for each entry below that.
BITMAP_BITS, BITS_EACH = 26, 16
#: Numbers of one block of the comparison: at least, and at most where a block has so many sources that its sums would be as many;
#: and sources that one task compares with all others.
BLOCK_CELLS, MOST_CELLS, SLICE = 1 << 16, 1 << 22, 256
#: Bytes of the first level's prefixes; each level has twice those of the one before.
FIRST_CUT = 6
#: A task counts so many bytes of prefixes at a time before they go to Spark.
HELD_BYTES = 32 << 20
#: Seed of Spark's xxhash64.
_SEED = 42


def _common(kinds: pa.Array, owner: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For each text's terms in order what a term has in common with the one before: a number of bytes that is exact from 24 on, and
    below that the greatest of 0, 6 and 12."""
    words = kinds.to_numpy(zero_copy_only=False)
    fixed = np.append(words.astype("S24"), np.bytes_(b""))
    parts = fixed.view(np.uint64).reshape(-1, 3)
    common = np.zeros(len(code), np.int32)
    if len(code) > 1:
        a, b = code[:-1], code[1:]
        same = owner[:-1] == owner[1:]
        first, second = parts[:, 0], fixed.view(np.uint32).reshape(-1, 6)[:, 2]
        six = np.uint64(0xFFFFFFFFFFFF)  # the bytes of a number stand from the lowest to the highest
        common[1:][same & ((first[a] ^ first[b]) & six == 0)] = 6
        same &= (first[a] == first[b]) & (second[a] == second[b])
        common[1:][same] = 12
        same &= (parts[a, 1] == parts[b, 1]) & (parts[a, 2] == parts[b, 2])
        for i in np.flatnonzero(same).tolist():
            common[i + 1] = len(commonprefix([words[a[i]], words[b[i]]]))
    return common


def _as_bytes(owner: np.ndarray, rows: int, values: np.ndarray) -> pa.Array:
    """Numbers of 32 bits, for ascending owners, as one binary value per row."""
    offsets = (4 * np.searchsorted(owner, np.arange(rows + 1))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(values.astype(np.int32))])


def _term_rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """One row per document: language, source, its different terms in order, how often each is there, and ``common`` (see above).

    Each of them is one binary value, the terms with blanks between them: to Spark a row is a few values and not hundreds.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in terms.slices(batch, 2):
                kinds, codes, counts = terms.terms(terms.bytes_of(part.column(2)), terms.LETTERS)
                order = pc.array_sort_indices(kinds)
                standing = np.empty(len(kinds), np.int64)
                standing[order.to_numpy()] = np.arange(len(kinds))
                kinds = kinds.take(order)
                owner, code, n = terms.tally(standing[codes], counts, len(kinds))
                [listed] = terms.lists(owner, len(counts), kinds.take(pa.array(code)))
                own = [pc.binary_join(listed, b" "), *(_as_bytes(owner, len(counts), x) for x in (n, _common(kinds, owner, code)))]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *own], names=["lang", "source", "terms", "counts", "common"])

    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]
    rows = docs.select(*named, F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(each, "lang string, source string, terms binary, counts binary, common binary")


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The documents with terms, one language at a time."""
    for batch in batches:
        batch = batch.filter(pc.greater(pc.binary_length(batch.column("terms")), 0))
        for lang in pc.unique(batch.column("lang")).to_pylist():
            yield lang, batch.filter(pc.equal(batch.column("lang"), lang))


def _numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32)


def _hits(bitmap: np.ndarray, lang: str, words: pa.Array) -> np.ndarray:
    """The words, or prefixes, of a language that are in the bitmap."""
    before, digest = lang.encode("utf-8", "surrogatepass") + b"\0", xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(before + w, _SEED) for w in words.to_numpy(zero_copy_only=False)), np.uint64, len(words))
    at = hashes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bitmap(entries: DataFrame, term: str) -> np.ndarray | None:
    """Hashes of (language, term) as bits; None without entries. The bits are put together by Spark, one word per row."""
    n = entries.count()
    if not n:
        return None
    bits = min(BITMAP_BITS, max(10, (BITS_EACH * n - 1).bit_length()))
    at = F.xxhash64(F.concat(F.col("lang").cast("binary"), F.lit(bytearray(1)), F.col(term))).bitwiseAND((1 << bits) - 1)
    words = entries.select(F.shiftright(at, 6).alias("w"), F.expr("1L").alias("one"), at.bitwiseAND(63).cast("int").alias("b"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, b)")).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def fresh_terms(batch: pa.RecordBatch, cut: int, least: int) -> pa.Array:
    """The terms of at least ``least`` bytes that begin a prefix of ``cut`` bytes of their document."""
    words = pc.split_pattern(batch.column("terms"), b" ").flatten()
    words = words.filter(pa.array(_numbers(batch.column("common")) < cut))
    return words.filter(pc.greater_equal(pc.binary_length(words), least)) if least else words


def _prefixes(rows: DataFrame, cut: int, before: int, alive) -> DataFrame:
    """(lang, prefix, n): documents by prefix of ``cut`` bytes, of terms whose prefix of ``before`` bytes is alive. A shorter prefix is a
    complete term; terms that ended before this level are counted already."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                found = pa.chunked_array(parts).value_counts()
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(found)), found.field(0), found.field(1)], names=["lang", "prefix", "n"])
            held.clear()

        for lang, batch in _by_lang(batches):
            # Deep levels are about few terms, which are picked before anything is sliced or hashed.
            words = fresh_terms(batch, cut, before)
            if alive:
                shorter = pc.binary_slice(words, 0, before).dictionary_encode()
                # All terms of a document with one shorter prefix stay or go together, so its first one stays first.
                words = words.filter(pa.array(_hits(alive.value, lang, shorter.dictionary)[shorter.indices.to_numpy()]))
            prefixes = pc.binary_slice(words, 0, cut)
            held.setdefault(lang, []).append(prefixes)
            size += prefixes.nbytes
            if size > HELD_BYTES:
                yield from counted()
                size = 0
        yield from counted()

    return rows.mapInArrow(each, "lang string, prefix binary, n long")


def frequent_terms(rows: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, docs): the terms in at least ``least_docs`` documents of their language, by prefix refinement."""
    context = rows.sparkSession.sparkContext
    before, cut, alive, levels = 0, FIRST_CUT, None, []
    while True:
        counted = _prefixes(rows, cut, before, alive).groupBy("lang", "prefix").agg(F.sum("n").alias("docs"))
        level = written(counted.where(F.col("docs") >= least_docs), "prefixes")
        complete = F.octet_length("prefix") < cut
        levels.append(level.where(complete).select("lang", F.col("prefix").alias("term"), "docs"))
        bitmap = _bitmap(level.where(~complete), "prefix")
        if bitmap is None:
            break
        alive = context.broadcast(bitmap)
        before, cut = cut, cut * 2
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    kept = written(found, "kept_terms")
    drop_tables(levels)
    return kept


def _counts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, n): occurrences of the kept terms in the groups that have them."""
    bitmap = _bitmap(kept, "term")
    if bitmap is None:
        return rows.select("lang", "source", F.lit(None).cast("binary").alias("term"), F.lit(0).cast("long").alias("n")).limit(0)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, batch in _by_lang(batches):
            split = pc.split_pattern(batch.column("terms"), b" ")
            coded = split.flatten().dictionary_encode()
            sources = batch.column("source").dictionary_encode()
            kinds = max(len(coded.dictionary), 1)
            code = coded.indices.to_numpy().astype(np.int64)
            group = np.repeat(sources.indices.to_numpy().astype(np.int64), split.value_lengths().to_numpy())
            used = _hits(shared.value, lang, coded.dictionary)[code]
            key = group[used] * kinds + code[used]
            order = np.argsort(key, kind="stable")
            found, first = np.unique(key[order], return_index=True)
            if not len(found):
                continue
            n = _numbers(batch.column("counts")).astype(np.int64)[used][order]
            columns = [
                pa.repeat(lang, len(found)),
                sources.dictionary.take(pa.array(found // kinds)),
                coded.dictionary.take(pa.array(found % kinds)),
                pa.array(np.add.reduceat(n, first)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n"])

    some = rows.mapInArrow(each, "lang string, source string, term binary, n long")
    return some.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(kept.select("lang", "term"), ["lang", "term"])


def _frequency(count: Column, total: Column, v: Column, scale: int, smoothing: int) -> Column:
    """p, in decimals on the way, so that no count is too large."""
    wide = "decimal(38,0)"
    upper = F.lit(scale).cast(wide) * (count.cast("decimal(19,0)") + smoothing)
    return 1 + F.call_function("div", upper.cast(wide), (total.cast("decimal(19,0)") + smoothing * v.cast("decimal(19,0)")).cast(wide))


def _distances(entries: DataFrame) -> DataFrame:
    """(lang, source, item, value): sums of |p - q| over terms for all pairs of sources. Entries are (lang, block, slice, source,
    in_slice, p, term); one without a term gives the source's p where it lacks a term."""

    def each(table: pa.Table) -> pa.Table:
        lang, names = table.column("lang")[0], table.column("source").combine_chunks().dictionary_encode()
        source = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        p = table.column("p").to_numpy()
        base = table.column("term").is_null().to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0, bool)
        own = np.zeros(len(names.dictionary), bool)
        own[source[table.column("in_slice").to_numpy(zero_copy_only=False)]] = True
        coded = table.column("term").combine_chunks().dictionary_encode()
        term = coded.indices.to_numpy(zero_copy_only=False)
        filled = np.zeros((len(names.dictionary), max(len(coded.dictionary), 1)), np.int64)
        if len(coded.dictionary):
            filled[source[base]] = p[base][:, None]
            filled[source[~base], term[~base].astype(np.int64)] = p[~base]
        chosen = np.flatnonzero(own)
        value = np.concatenate([np.abs(filled - filled[s]).sum(1) for s in chosen] or [np.zeros(0, np.int64)])
        left = np.repeat(chosen, len(filled))
        right = np.tile(np.arange(len(filled)), len(chosen))
        other = left != right
        columns = [
            pa.array([lang.as_py()] * int(other.sum()), pa.string()),
            names.dictionary.take(pa.array(left[other])),
            names.dictionary.take(pa.array(right[other])),
            pa.array(value[other], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=["lang", "source", "item", "value"])

    sums = entries.groupBy("lang", "block", "slice").applyInArrow(each, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = 30,
    smoothing: int = 5,
    scale: int = 1_000_000_000,
    top: int = 50,
) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` has the distance to each other source of the language, ``term`` the ``top``
    kept terms that are most above the language's frequency."""
    rows = written(_term_rows(docs, text, lang, source), "document_terms")
    kept = frequent_terms(rows, least_docs)
    counts = written(_counts(rows, kept), "term_counts")
    groups = rows.select("lang", "source").distinct()
    v = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("lang").orderBy("source")
    groups = groups.join(totals, ["lang", "source"], "left").join(v, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    whole = Window.partitionBy("lang")
    groups = groups.withColumns(
        {
            "slice": F.floor((F.row_number().over(order) - 1) / SLICE),
            "sources": F.count(F.lit(1)).over(whole),
            "lang_total": F.sum("total").over(whole),
        }
    )
    # A language without kept terms has no frequencies; its sources are all alike.
    base = F.when(F.col("v") > 0, _frequency(F.lit(0), F.col("total"), F.greatest("v", F.lit(1)), scale, smoothing)).otherwise(0)
    cells = F.least(F.greatest(4 * F.col("sources") * F.col("sources"), F.lit(BLOCK_CELLS)), F.lit(MOST_CELLS))
    groups = groups.withColumns({"base": base, "blocks": F.ceil(F.greatest(F.col("v") * F.col("sources"), F.lit(1)) / cells)})
    groups = written(groups, "source_groups")
    drop_tables([rows])

    p = counts.join(groups, ["lang", "source"]).withColumn("p", _frequency(F.col("n"), F.col("total"), F.col("v"), scale, smoothing))
    # Every kept term stands in some group, so the groups' entries name all of a block's terms.
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    columns = ["lang", "source", "slice", "sources"]
    entries = p.select(*columns, block.alias("block"), "p", "term")
    bases = groups.select(
        *columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("base").alias("p"), F.lit(None).cast("binary").alias("term")
    )
    every = F.sequence(F.lit(0).cast("long"), F.floor((F.col("sources") - 1) / SLICE))
    entries = entries.unionByName(bases).withColumn("for", F.explode(every))
    entries = entries.select("lang", "source", "block", F.col("for").alias("slice"), (F.col("for") == F.col("slice")).alias("in_slice"), "p", "term")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = _distances(entries).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))

    everywhere = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    own = p.join(everywhere, ["lang", "term"])
    q = _frequency(F.col("lang_n"), F.col("lang_total"), F.col("v"), scale, smoothing)
    above = own.withColumn("value", F.col("p") - q).where(F.col("value") > 0)
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    ranked = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pairs.unionByName(ranked)
