"""Line dedup by content-defined chunks of lines. Native: DataFrame functions only.

Blank lines (spaces, tabs, carriage returns only) belong to the solid line before them, those at the start to the first one. Every
solid line has a hash; a rolling hash over the last two of them, where it is not above its neighbour's before or after (a
least value of two neighbours), makes a border, so an inserted or removed line moves borders only near itself. A
chunk is the two solid lines of a border, alone or with one more before or after. Chunks that occur more than once in the whole
table are compared byte by byte (Spark's equality on the solid lines), and the lines of every occurrence but the first, by
document key and place, are removed. Every run of three solid lines has a border that depends on these lines only, so a repeated
passage of three lines or more is removed wholly, wherever it stands; one of two lines is if it has a border in both places. Each
removed line has an equal one at an earlier place, so the first of equal lines always stays.

Hashes of borders are counted first, and only chunks whose border repeats have their text compared. Counts combine before they are
shuffled and joins meet a written table, so a chunk that a third of all documents hold is split over tasks.

Defined cases: a null text stays null and has one line; a text with fewer than two solid lines loses nothing; a text that loses all its
solid lines becomes empty. Rows that repeat a key with the same text are one document and keep or lose the same. A null key comes
last. A text of any length is one row, worked on in time that grows with its lines. An empty table gives an empty result. Other
columns are carried through; one named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import drop_tables, release, written

RESULT = ("n_lines", "n_removed", "n_chunks_removed")
#: Factor and modulus of the rolling hash.
FACTOR, MODULUS = 1_000_003, 2_147_483_647
#: What a blank line consists of.
BLANKS = " \t\r"


def _fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator of one row: the optimizer would else repeat an array's whole expression inside the
    functions that run for each of its elements."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def line_hash(line: Column) -> Column:
    """28 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def is_solid(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) != ""


def counted(size: Column, first: int = 1) -> Column:
    """The numbers from ``first`` to ``size``; none where that is less."""
    return F.when(size >= first, F.sequence(F.lit(first), size)).otherwise(F.array().cast("array<int>"))


def with_borders(df: DataFrame, text: str) -> DataFrame:
    """Add ``solid_`` (the solid lines) and ``borders_`` (numbers, from 2, of those that end a border's pair)."""
    df = _fixed(df, solid_=F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), is_solid))
    df = _fixed(df, hashes_=F.transform("solid_", line_hash))
    # The first line has no pair, so nothing is compared with it.
    pair = lambda h, i: F.when(i > 0, (h + F.lit(FACTOR) * F.get("hashes_", i - 1)) % MODULUS)
    df = _fixed(df, rolled_=F.transform("hashes_", pair))

    def border(i: Column) -> Column:
        own, before, after = F.get("rolled_", i - 1), F.get("rolled_", i - 2), F.get("rolled_", i)
        return F.coalesce(own <= before, F.lit(False)) | F.coalesce(own <= after, F.lit(False)) | (F.size("solid_") == 2)

    return _fixed(df, borders_=F.filter(counted(F.size("solid_"), 2), border)).drop("hashes_", "rolled_")


def _lines(first: Column, n: int) -> Column:
    # Taken one by one: inside a function of an array's elements a slice copies the whole array.
    return F.concat_ws("\n", *[F.get("solid_", first - 1 + i) for i in range(n)])


def _chunks(df: DataFrame) -> DataFrame:
    """(key_, text_hash_, first, n, body) of the chunks at the borders ``at_``."""

    def shapes(i: Column) -> Column:
        # First line and number of lines as one number: only those of plain types are made distinct by hash.
        here = F.array((i - 1) * 4 + 2, F.greatest(i - 2, F.lit(1)) * 4 + 3, (i - 1) * 4 + 3)
        return F.filter(here, lambda c: F.shiftright(c, 2) + c.bitwiseAND(3) - 1 <= F.size("solid_"))

    def chunk(c: Column) -> Column:
        first, n = F.shiftright(c, 2), c.bitwiseAND(3)
        return F.struct(first.alias("first"), n.alias("n"), F.when(n == 2, _lines(first, 2)).otherwise(_lines(first, 3)).alias("body"))

    df = _fixed(df, places_=F.array_distinct(F.flatten(F.transform("at_", shapes))))
    return df.select("key_", "text_hash_", F.inline(F.transform("places_", chunk)))


def remove_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with the text without repeated chunks, ``n_lines``, ``n_removed`` lines and ``n_chunks_removed`` (runs of
    neighbouring lines that were removed)."""
    own = [c for c in docs.columns if c.lower() not in RESULT]
    content = F.col(f"`{text}`")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own if c != text]).alias("carried_") if len(own) > 1 else F.lit(None).alias("carried_"),
        F.col(f"`{key}`").alias("key_"),
        F.xxhash64(content).alias("text_hash_"),
        content.alias("text_"),
    )
    same = F.col("key_").eqNullSafe(F.col("k_")) & F.col("text_hash_").eqNullSafe(F.col("t_"))
    renamed = {"key_": "k_", "text_hash_": "t_"}

    # Borders whose pair of lines occurs again, by hash. Merge joins whatever their number is, so that the plan is the same at every size.
    narrow = with_borders(base.select("key_", "text_hash_", "text_"), "text_")
    hashed = F.transform("borders_", lambda i: F.struct(i.alias("at"), F.xxhash64(_lines(i - 1, 2)).alias("h")))
    borders = narrow.select("key_", "text_hash_", F.inline(hashed))
    hashes = borders.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    seen_twice = written(hashes.where("n > 1").select("h"), "chunk_hashes")
    again = borders.join(seen_twice.hint("merge"), "h", "left_semi").groupBy("key_", "text_hash_").agg(F.collect_set("at").alias("at_"))
    again = written(again.withColumnsRenamed(renamed), "repeated_borders")
    release(docs.sparkSession)

    # The texts of the chunks there, compared as they are.
    once = base.select("key_", "text_hash_", "text_").join(again.hint("merge"), same).drop("k_", "t_")
    chunks = written(_chunks(with_borders(once, "text_")), "repeated_chunks", "zstd")
    release(docs.sparkSession)
    place = F.struct(F.col("key_").isNull().alias("last"), "key_", "text_hash_", "first")
    firsts = chunks.groupBy("body").agg(F.min(place).alias("first_place"), F.count(F.lit(1)).alias("times"))
    firsts = written(firsts.where("times > 1").drop("times"), "first_chunks", "zstd")
    release(docs.sparkSession)
    later = chunks.join(firsts.hint("merge"), "body").where(~place.eqNullSafe(F.col("first_place")))
    lines = F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)
    gone = later.select("key_", "text_hash_", F.explode(lines).alias("line")).groupBy("key_", "text_hash_").agg(F.collect_set("line").alias("gone_"))
    gone = written(gone.withColumnsRenamed(renamed), "lines_to_remove")
    drop_tables([seen_twice, again, chunks, firsts])
    release(docs.sparkSession)
    joined = _without(base.join(gone.hint("merge"), same, "left").drop("k_", "t_"))
    columns = [F.when(F.col("gone_").isNull(), F.col("text_")).otherwise(F.col("rest_")).alias(text) if c == text else F.col(f"carried_.`{c}`").alias(c) for c in own]
    return joined.select(*columns, *RESULT)


def _without(df: DataFrame) -> DataFrame:
    """Add what stays without the solid lines ``gone_`` and the blank ones behind them, and the counts."""
    df = _fixed(df, lines_=F.split(F.coalesce(F.col("text_"), F.lit("")), "\n"))
    all_lines = counted(F.size("lines_"))
    df = _fixed(df, solid_at_=F.filter(all_lines, lambda i: is_solid(F.get("lines_", i - 1))))
    kept = F.array_except(counted(F.size("solid_at_")), F.coalesce("gone_", F.array().cast("array<int>")))

    def unit(u: Column) -> Column:
        first = F.when(u == 1, F.lit(1)).otherwise(F.get("solid_at_", u - 1))
        return F.sequence(first, F.coalesce(F.get("solid_at_", u), F.size("lines_") + 1) - 1)

    df = _fixed(df, kept_=F.when(F.size("solid_at_") == 0, all_lines).otherwise(F.flatten(F.transform(kept, unit))))
    runs = F.size(F.array_except("gone_", F.transform("gone_", lambda u: u + 1)))
    return df.select(
        "*",
        F.array_join(F.transform("kept_", lambda i: F.get("lines_", i - 1)), "\n").alias("rest_"),
        F.size("lines_").cast("long").alias("n_lines"),
        (F.size("lines_") - F.size("kept_")).cast("long").alias("n_removed"),
        F.when(F.col("gone_").isNull(), F.lit(0)).otherwise(runs).cast("long").alias("n_chunks_removed"),
    )
