"""Records of quoted files: the same for every way to deal a file out, and those of one expression over the whole text."""

import gzip
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlake.sources import csv_files, records
from orderlake.sources.schemas import TABLES

FIELD = r'(?:"(?:[^"]++|"")*+"|[^",\n]*+)'
RECORD = rf"{FIELD}(?:,{FIELD})*+"
PIECE = re.compile(rf"{RECORD}(?=\r?(?:\n|\Z))|[^\n]++")
GOOD = re.compile(RECORD)


def plain(text):
    """(record, good) of a whole text, its header left out."""
    pieces = [re.sub(r"\r\Z", "", m[0]) for m in PIECE.finditer(text)]
    filled = [p for p in pieces if p]
    return [(p, bool(GOOD.fullmatch(p))) for p in filled[1:]]


PATTERNS = [re.compile(p.replace(r"\z", r"\Z")) for p in (records._WHOLE, records._OPENS, records._STAYS, records._CLOSES)]


def code_of(line):
    if line in ("", "\r"):
        return records.BLANK
    whole, opens, stays, closes = (bool(p.search(line)) for p in PATTERNS)
    outside = records.WHOLE if whole else records.OPENS if opens else records.BROKEN
    return outside + (records.STAYS if stays else records.CLOSES if closes else records.BREAKS)


def dealt(text, rng, batch):
    """The two passes over a text in random ranges, in batches of some lines."""
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
    codes = np.array([code_of(x) for x in lines], np.int32)
    edges = sorted({0, len(lines), *(rng.randrange(len(lines) + 1) for _ in range(rng.randrange(6)))})
    ranges = [(a * 10, a, e) for a, e in zip(edges[:-1], edges[1:], strict=True)]
    summed = []
    for begin, a, e in ranges:
        state = records.RangeFunction()
        for at in range(a, e, batch):
            state.feed(codes[at : min(at + batch, e)])
        summed.append((begin, state.filled, state.stop, *state.open_from))
    known = {r[0]: r[1:] for r in records.composed(summed)}
    out, parts = [], {}
    for begin, a, e in ranges:
        origin, ends_open, header = known.get(begin, (-1, False, False))
        cutter, found = records.RangeCutter(begin, origin, ends_open, begin == 0 or header), []
        for at in range(a, e, batch):
            stop = min(at + batch, e)
            found += cutter.feed(pa.array(lines[at:stop], pa.string()), codes[at:stop])
        found += cutter.finish()
        for texts, good, of in found:
            for t, g in zip(texts.to_pylist(), good.tolist(), strict=True):
                if of < 0:
                    out.append((t, g))
                else:
                    parts.setdefault(of, []).append((begin, t))
    out += [("\n".join(t for _, t in sorted(p)), True) for of, p in parts.items() if min(p)[0] == of]
    return sorted((re.sub(r"\r\Z", "", t), g) for t, g in out if re.sub(r"\r\Z", "", t))


@pytest.mark.parametrize("seed", range(4))
def test_any_ranges_of_any_text(seed):
    rng = random.Random(seed)
    pieces = ['"', '""', ",", "\n", "\n", "\r\n", "a", "b c", 'x"', '"y', '",', ',"', '"q, r"', '"two\nlines"']
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40)))
        if not text.strip("\n"):
            continue
        assert dealt(text, rng, rng.choice([1, 2, 7])) == sorted(plain(text)), repr(text)


TEXT = (
    'i,f,item,v\r\n1,fd1,"Two\nlines, ""one"" dish",Veg\r\n\n2,fd2,xy,Veg\n3,"fd3,Open,Veg\n4,fd4,"",Veg\n5,fd"5,z,Veg\n'
    '6,"fd6"z,a,Veg\n7,fd7,"a\n\nlong\n""one""\n",Veg\n8,fd8,last,Veg'
)


@pytest.mark.parametrize("header", ["", '\n\r\n"he\nad",'])
def test_every_size_of_range_gives_the_same_records(spark, tmp_path, header):
    text = header + TEXT
    (tmp_path / "food.csv").write_bytes(text.encode())
    (tmp_path / "more.csv").write_bytes(b"h\n1,x,y,Veg\n" + '2,"ü\n…",y,Veg\n'.encode() * 3)
    want = sorted([*plain(text), ("1,x,y,Veg", True), *[('2,"ü\n…",y,Veg', True)] * 3])
    size = len(text.encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for most in [*range(1, 6), 11, 23, 40, size // 2, size - 1, size, 2 * size]:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(most))
            found = csv_files.read_records(spark.read, str(tmp_path))
            assert sorted((r.record, r.good) for r in found.collect()) == want, most
            if most == 23:
                assert records.read_lines(spark.read, str(tmp_path), F.lit(None)).rdd.getNumPartitions() > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_odd_files(spark, tmp_path):
    for name, text in {"empty": "", "header": "a,b", "blank": "\n\n\r\n", "open": 'a,b\n1,"never closed\n2,x\n'}.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    with gzip.open(tmp_path / "packed.csv.gz", "wb") as out:
        out.write(b'a,b\n1,"one\nrecord"\n')
    found = csv_files.read_records(spark.read, str(tmp_path)).collect()
    assert sorted((r.record, r.good) for r in found) == [('1,"never closed', False), ('1,"one\nrecord"', True), ("2,x", True)]
    assert {r._source_file.rsplit("/", 1)[1] for r in found} == {"open.csv", "packed.csv.gz"}


def test_reviews_are_split_and_strict(spark, tmp_path):
    header = "review_id,order_id,user_id,restaurant_id,rating,comment,review_date\n"
    body = "".join(f'{i},2,3,4,5,"line one of {i}\nline ""two"" of {i}",2026-09-02\n' for i in range(500))
    (tmp_path / "reviews.csv").write_text(header + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        got = csv_files.read_table(spark.read, TABLES["reviews"], str(tmp_path))
        assert sorted((r.review_id, r.comment) for r in got.collect()) == [(i, f'line one of {i}\nline "two" of {i}') for i in range(500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "bad.csv").write_text(header + '1,2,3,4,5,"x"y,2026-09-02\n')
    with pytest.raises(Exception, match="no record"):
        csv_files.read_table(spark.read, TABLES["reviews"], str(tmp_path)).collect()
