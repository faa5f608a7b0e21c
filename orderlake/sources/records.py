"""Records of quoted CSV files that may span lines, read by many tasks per file.

Spark deals a file out in ranges of bytes and gives each line to one range. Whether a line begins a record or goes on
inside a quoted field depends on all lines before it, but only through one bit: is a field open or not. So each line is a small function
of that bit, and so is a range, as the composition of its lines:

* from outside, a line that leaves a quoted field open leads inside, any other line stays outside;
* from inside, a line may leave the field open, close it and end its record, or fit no record at all. The last means that the record's
  first line was no record; it is rejected alone, and reading goes on as from outside.

A first pass over the files reports each range's function and its first line that doesn't leave an open field open. Composed
in the order of the ranges, one row per range, they tell which ranges begin inside a record that will be closed and
which end in one. Only those few are known to the second pass, which cuts lines into records. A record that
crosses borders is put together from its ranges' parts and belongs to the range it begins in.

``cut`` gives the same records for every way to deal out a file. A task holds the lines of one batch and of the record that is
open; an open field that nothing closes within a range is held to the range's end.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the tasks run travels to them as it is here, so that executors needn't have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Possessive quantifiers keep the tests linear in the length of a line.
_BODY = r'(?:[^"]++|"")*+'
_FIELD = rf'(?:"{_BODY}"|[^",]*+)'
_WHOLE = rf"\A{_FIELD}(?:,{_FIELD})*+\r?\z"
_OPENS = rf'\A(?:{_FIELD},)*+"{_BODY}\z'
_STAYS = rf'\A{_BODY}(?:"(?:,{_FIELD}(?=,))*+,"{_BODY})?\z'
_CLOSES = rf'\A{_BODY}"(?:,{_FIELD})*+\r?\z'

# What a line is from outside (in the lower two bits), what it is from inside (in the next two), and whether it is blank.
WHOLE, OPENS, BROKEN = 0, 1, 2
STAYS, CLOSES, BREAKS = 0, 4, 8
BLANK = 16


def line_code(line: Column) -> Column:
    """How a line acts on the state of its file; lines without quotes are known at once."""
    outside = F.when(line.rlike(_WHOLE), WHOLE).when(line.rlike(_OPENS), OPENS).otherwise(BROKEN)
    inside = F.when(line.rlike(_STAYS), STAYS).when(line.rlike(_CLOSES), CLOSES).otherwise(BREAKS)
    return F.when(line.isin("", "\r"), BLANK).when(line.contains('"'), outside + inside).otherwise(WHOLE + STAYS)


def read_lines(source, path, load_time: Column) -> DataFrame:
    """The lines of files with what tells their order: the file and where their range of it begins.

    ``source`` is ``spark.read`` or ``spark.readStream``. Folders below the path are read too.
    """
    lines = source.format("text").options(lineSep="\n", recursiveFileLookup="true").load(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("range"),
        load_time.alias("_loaded_at"),
    )


class RangeFunction:
    """What is known of a range after some of its lines."""

    def __init__(self) -> None:
        self.filled = False  # has a line that isn't blank
        self.stop = 0  # CLOSES or BREAKS of its first line that doesn't stay inside
        self.open_from = [False, True]  # the state at the end for either state at the beginning

    def feed(self, codes: np.ndarray) -> None:
        outside, inside = codes & 3, codes & 12
        self.filled = self.filled or bool(((codes & BLANK) == 0).any())
        stops = np.flatnonzero(inside)
        if not self.stop and len(stops):
            self.stop = int(inside[stops[0]])
        after_outside = outside == OPENS
        after_inside = np.where(inside == STAYS, True, np.where(inside == CLOSES, False, after_outside))
        # Lines lead to one state from both, leave the state as it is, or exchange the two.
        fixed = np.flatnonzero(after_outside == after_inside)
        last = int(fixed[-1]) if len(fixed) else -1
        exchanged = bool((after_outside & ~after_inside)[last + 1 :].sum() % 2)
        before = [bool(after_outside[last])] * 2 if last >= 0 else self.open_from
        self.open_from = [x != exchanged for x in before]


def composed(ranges: list[tuple[int, bool, int, bool, bool]]) -> list[tuple[int, int, bool, bool]]:
    """For the ranges of a file in order (beginning, filled, stop, state at the end from outside and from inside): those that begin
    or end inside a record, or have the header without being first. A row is the range's beginning, where the record began
    that it begins in (-1: outside), whether it ends in one, and whether its first record is the header."""
    closes, after = [False] * len(ranges), False
    for i in range(len(ranges) - 1, -1, -1):
        closes[i] = after  # is a field closed that is open at this range's end?
        after = ranges[i][2] == CLOSES if ranges[i][2] else after
    out, origin, headed = [], -1, False
    for (begin, filled, stop, from_outside, from_inside), closed in zip(ranges, closes, strict=True):
        ends_open = (from_outside if origin < 0 else from_inside) and closed
        through = origin >= 0 and not stop
        header, headed = filled and not headed, headed or filled
        own_end = ends_open and not through
        if origin >= 0 or own_end or (header and begin > 0):
            out.append((begin, origin, own_end, header))
        origin = (origin if through else begin) if ends_open else -1
    return out


def _runs(batch: pa.RecordBatch, file: int, begin: int) -> Iterator[pa.RecordBatch]:
    """The batch cut where the range changes."""
    n = batch.num_rows
    if n:
        names, begins = batch.column(file).dictionary_encode().indices.to_numpy(), batch.column(begin).to_numpy()
        edges = np.flatnonzero((np.diff(names) != 0) | (np.diff(begins) != 0)) + 1
        bounds = [0, *edges.tolist(), n]
        for a, e in zip(bounds[:-1], bounds[1:], strict=True):
            yield batch.slice(a, e - a)


def borders(lines: DataFrame) -> DataFrame:
    """The first pass: (_source_file, range, origin, ends_open, header) of the ranges that a record enters or leaves."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, RangeFunction()

        def row() -> pa.RecordBatch:
            values = [key[0], key[1], state.filled, state.stop, *state.open_from]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, values, strict=True))], schema)

        for batch in batches:
            for run in _runs(batch, 0, 1):
                here = run.column(0)[0].as_py(), run.column(1)[0].as_py()
                if here != key:
                    if key is not None:
                        yield row()
                    key, state = here, RangeFunction()
                state.feed(run.column(2).to_numpy())
        if key is not None:
            yield row()

    schema = pa.schema(
        [("_source_file", pa.string()), ("range", pa.int64()), ("filled", pa.bool_()), ("stop", pa.int32()), ("outside", pa.bool_()), ("inside", pa.bool_())]
    )
    spark_schema = "_source_file string, range long, filled boolean, stop int, outside boolean, inside boolean"
    ranges = lines.select("_source_file", "range", line_code(F.col("value")).alias("code")).mapInArrow(summed, spark_schema)

    def of_file(table: pa.Table) -> pa.Table:
        found = composed(sorted(zip(*(table.column(c).to_pylist() for c in table.column_names[1:]), strict=True)))
        columns = list(zip(*found, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        name = pa.array([table.column(0)[0].as_py()] * len(found), pa.string())
        arrays = [name, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        return pa.Table.from_arrays(arrays, names=["_source_file", "range", "origin", "ends_open", "header"])

    # One row per range of a file: a file of a terabyte has some thousands.
    return ranges.groupBy("_source_file").applyInArrow(
        of_file, "_source_file string, range long, origin long, ends_open boolean, header boolean"
    )


def _joined(parts: list[pa.Array]) -> str:
    return "\n".join(x for part in parts for x in part.to_pylist())


class RangeCutter:
    """Cuts the lines of one range into records: ``feed`` and ``finish`` give (texts, good, origins), where an origin of -1 is a
    whole record and any other names the range in which the record begins that the text is a part of."""

    def __init__(self, begin: int, origin: int, ends_open: bool, header: bool):
        self.begin, self.origin, self.ends_open, self.header = begin, origin, ends_open, header
        self.inside = origin >= 0
        self.held: list[pa.Array] = []
        self.codes: list[np.ndarray] = []

    def _lines(self, lines: pa.Array, good: np.ndarray, starts: np.ndarray | None = None) -> Iterator[tuple]:
        if starts is not None and len(starts) < len(lines):
            offsets = pa.array(np.append(starts, len(lines)), pa.int32())
            lines = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
        if self.header and len(lines):
            filled = np.flatnonzero(pc.invert(pc.is_in(lines, pa.array(["", "\r"]))).to_numpy(zero_copy_only=False))
            at = int(filled[0]) if len(filled) else len(lines) - 1
            self.header = not len(filled)
            lines, good = lines.slice(at + 1), good[at + 1 :]
        if len(lines):
            yield lines, good, -1

    def _hold(self, lines: pa.Array, codes: np.ndarray) -> None:
        self.held.append(lines)
        self.codes.append(codes)

    def _release(self) -> tuple[list[pa.Array], np.ndarray]:
        held, codes = self.held, np.concatenate(self.codes)
        self.held, self.codes = [], []
        return held, codes

    def feed(self, lines: pa.Array, codes: np.ndarray) -> Iterator[tuple]:
        stops, at = np.flatnonzero(codes & 12), 0
        if self.inside or self.held:
            if not len(stops):
                self._hold(lines, codes)
                return
            first = int(stops[0])
            if self.inside:
                self._hold(lines.slice(0, first + 1), codes[: first + 1])
                yield pa.array([_joined(self._release()[0])]), np.ones(1, bool), self.origin
                self.inside, at = False, first + 1
            elif codes[first] & 12 == CLOSES:
                self._hold(lines.slice(0, first + 1), codes[: first + 1])
                yield from self._lines(pa.array([_joined(self._release()[0])]), np.ones(1, bool))
                at = first + 1
            else:
                yield from self._single()
                yield from self._lines(lines.slice(0, first), (codes[:first] & 3) == WHOLE)
                at = first
        opens = np.flatnonzero((codes & 3) == OPENS)
        begins, good, end, pos = np.ones(len(codes), bool), (codes & 3) == WHOLE, len(codes), at
        while True:
            o = int(np.searchsorted(opens, pos))
            if o == len(opens):
                break
            i = int(opens[o])
            s = int(np.searchsorted(stops, i + 1))
            if s == len(stops):
                end = i
                self._hold(lines.slice(i), codes[i:])
                break
            j = int(stops[s])
            if codes[j] & 12 == CLOSES:
                begins[i + 1 : j + 1], good[i] = False, True
                pos = j + 1
            else:
                pos = j
        starts = np.flatnonzero(begins[at:end])
        yield from self._lines(lines.slice(at, end - at), good[at:end][starts], starts)

    def _single(self) -> Iterator[tuple]:
        """Held lines that are no record together: each stands for itself."""
        held, codes = self._release()
        yield from self._lines(pa.concat_arrays(held), (codes & 3) == WHOLE)

    def finish(self) -> Iterator[tuple]:
        if not self.held:
            return
        if self.inside:
            yield pa.array([_joined(self._release()[0])]), np.ones(1, bool), self.origin
        elif not self.ends_open:
            yield from self._single()
        else:
            text = _joined(self._release()[0])
            if not self.header:
                yield pa.array([text]), np.ones(1, bool), self.begin


def _cut(lines: DataFrame) -> DataFrame:
    """(_source_file, _loaded_at, range, record, good, origin) from lines with their range's row of ``borders``."""
    columns = ["_source_file", "_loaded_at", "range", "record", "good", "origin"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cutter, fixed = None, None, None

        def rows(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for texts, good, origin in found:
                n = len(texts)
                own = [pa.repeat(x, n) for x in fixed]
                values = [*own, texts.cast(pa.string()), pa.array(good), pa.repeat(pa.scalar(origin, pa.int64()), n)]
                yield pa.RecordBatch.from_arrays(values, names=columns)

        for batch in batches:
            for run in _runs(batch, 0, 2):
                here = run.column(0)[0], run.column(2)[0]
                if key != here:
                    if cutter:
                        yield from rows(cutter.finish())
                    begin, (origin, ends_open, header) = here[1].as_py(), (run.column(i)[0].as_py() for i in (5, 6, 7))
                    cutter = RangeCutter(begin, -1 if origin is None else origin, bool(ends_open), begin == 0 or bool(header))
                    key, fixed = here, [run.column(i)[0] for i in range(3)]
                yield from rows(cutter.feed(run.column(3), run.column(4).to_numpy()))
        if cutter:
            yield from rows(cutter.finish())

    ordered = lines.select("_source_file", "_loaded_at", "range", "value", line_code(F.col("value")).alias("code"), "origin", "ends_open", "header")
    return ordered.mapInArrow(each, "_source_file string, _loaded_at timestamp, range long, record string, good boolean, origin long")


def cut(lines: DataFrame) -> DataFrame:
    """The records of ``read_lines``, headers left out: ``record``, ``good`` and load metadata.

    Where no record can be read the rest of the line is one that is not good, and reading goes on with the next line, so a stray quote
    costs its own line only.
    """
    # At most two rows per border between ranges, so about one for each 64 MB of input; broadcast, since rows have to stay in order.
    known = F.broadcast(borders(lines))
    key = ["_source_file", "range"]
    whole = _cut(lines.join(known, key, "left")).where("origin = -1")
    parts = _cut(lines.join(known.where("origin >= 0 OR ends_open"), key)).where("origin >= 0")
    pieces = F.array_sort(F.collect_list(F.struct("range", "record")))
    # A header's first part is left out, and its other parts with it.
    crossing = parts.groupBy("_source_file", "_loaded_at", "origin").agg(pieces.alias("pieces")).where(F.col("pieces")[0]["range"] == F.col("origin"))
    crossing = crossing.select(
        "_source_file", "_loaded_at", F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"), F.lit(True).alias("good")
    )
    records = whole.select("_source_file", "_loaded_at", "record", "good").unionByName(crossing)
    trimmed = records.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return trimmed.where("record <> ''").select("record", "_source_file", "_loaded_at", "good")
