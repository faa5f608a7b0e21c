"""Archives written and read back, and the ZIP reader by itself."""

import base64
import hashlib
import io
import struct
import zipfile
import zlib

import pyarrow.fs as pafs
import pytest

from orderlake.llm import warc_zip
from orderlake.llm.queries import ORACLE_SQL, QUERIES


def opened(tmp_path, data):
    path = tmp_path / "x.zip"
    path.write_bytes(data)
    return pafs.LocalFileSystem().open_input_file(str(path))


def test_directory_of_an_ordinary_file(tmp_path):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as out:
        out.writestr(zipfile.ZipInfo("a/ä.txt"), b"hello")
        out.writestr("b", b"world" * 100, compress_type=zipfile.ZIP_DEFLATED)
        out.comment = b"PK\x05\x06 a comment that looks like a record"
    file = opened(tmp_path, body.getvalue())
    first, second = warc_zip.members(file)
    assert (first.name, first.method, first.size, second.name, second.method) == ("a/ä.txt", 0, 5, "b", 8)
    assert warc_zip._read(file, warc_zip.data_start(file, first), 5) == b"hello"
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.data_start(file, second)


def zip64(name, content):
    """A ZIP64 file made by hand: sizes, offset and counts only in the 64-bit records."""
    big, n = 0xFFFFFFFF, len(content)
    extra = struct.pack("<HHQQ", 1, 16, n, n)
    local = struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0, 0, 0, 0, zlib.crc32(content), big, big, len(name), len(extra)) + name + extra
    other = struct.pack("<HHI", 0x7075, 4, 7)
    extra = other + struct.pack("<HHQQQ", 1, 24, n, n, 3)
    central = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0, 0, 0, 0, zlib.crc32(content), big, big, len(name), len(extra), 0, 0, 0, 0, big) + name + extra
    start = 3 + len(local) + n
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(central), start)
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, start + len(central), 1)
    return b"xxx" + local + content + central + end64 + locator + struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, big, big, 0)


def test_zip64_records(tmp_path):
    file = opened(tmp_path, zip64(b"archive/data.warc.gz", b"some bytes"))
    (member,) = warc_zip.members(file)
    assert (member.size, member.header) == (10, 3)
    assert warc_zip._read(file, warc_zip.data_start(file, member), 10) == b"some bytes"


def test_broken_files_are_refused(tmp_path):
    for data in (b"", b"PK", b"no archive at all" * 50, zip64(b"a", b"b")[:-30]):
        with pytest.raises(ValueError):
            warc_zip.members(opened(tmp_path, data))


def expected(rows, least=0):
    first = {}
    for k, _, html in rows:
        body = (html or "").encode()
        if k is not None and len(body) >= least:
            first[body] = min(first.get(body, k), k)
    out = []
    for k, _, html in rows:
        body = (html or "").encode()
        revisit = len(body) >= least and first.get(body, k) != k
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((str(k), len(body), digest, "revisit" if revisit else "response", first[body] if revisit else None))
    return sorted(out, key=str)


def found(records):
    key = warc_zip.key_of
    rows = records.select(key(records.record_id).alias("k"), "payload_bytes", "payload_digest", "record_type", key(records.refers_to).alias("r")).collect()
    return sorted(((str(r.k), r.payload_bytes, r.payload_digest, r.record_type, r.r) for r in rows), key=str)


ROWS = [(7, "http://a/ b\r\nX: y", "same"), (3, None, "same"), (5, "http://ä/", None), (6, "u", ""), (8, "u", "é\r\n\r\n" * 300), (9, "u", "x" * 300000)]
ROWS += [(3, None, "same"), (None, "n", "same"), (None, "n", "only null keys"), (None, "n", "only null keys"), (10, "u", "WARC/1.1")]


@pytest.mark.parametrize("least", [0, 5])
@pytest.mark.parametrize("size", [100, 1 << 20])
def test_round_trip(spark, least, size):
    pages = spark.createDataFrame([(*r, "e", 1) for r in ROWS], "page_id long, url string, html string, record_type string, offset int")
    archives = warc_zip.write_archives(pages, min_revisit=least, archive_bytes=size)
    records = warc_zip.read_archives(archives)
    assert found(records) == expected(ROWS, least)
    payloads = {(r.record_id, r.payload_digest): bytes(r.payload) for r in records.where("record_type = 'response'").collect()}
    for k, _, html in ROWS:
        body = (html or "").encode()
        digest = warc_zip.payload_digest(body)
        assert payloads.get((f"{warc_zip.URN}{'' if k is None else k}", digest), body) == body
    assert sum(r.records for r in archives.collect()) == len(ROWS)


def test_archives_without_index_are_walked(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_zip, "RANGE", 64)
    data = b"".join(warc_zip._gzip_member(warc_zip._record(str(i), None, "u", b"payload %d" % i * 40)[0]) for i in range(30))
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as out:
        out.writestr(warc_zip.DATA, data)
    file = pafs.LocalFileSystem().open_input_file(str(tmp_path / "a.wacz"))
    places = list(warc_zip._walked(file, warc_zip.members(file)))
    assert len(places) == 30
    archives = spark.createDataFrame([(str(tmp_path / "a.wacz"),)], "archive string")
    assert warc_zip.read_archives(archives).where("payload_bytes > 0").count() == 30


def test_members_that_no_index_names_and_an_index_without_last_line_break(spark, tmp_path):
    def packed(numbers):
        return [warc_zip._gzip_member(warc_zip._record(str(i), None, "u", b"payload %d" % i)[0]) for i in numbers]

    named, other, lines, at = packed(range(5)), packed(range(5, 12)), [], 0
    for record in named:
        lines.append(f'- {warc_zip.DATE} {{"offset": {at}, "length": {len(record)}, "filename": "{warc_zip.DATA}"}}')
        at += len(record)
    path = str(tmp_path / "two.wacz")
    with zipfile.ZipFile(path, "w") as out:
        out.writestr("archive/", b"")
        out.writestr(warc_zip.DATA, b"".join(named))
        out.writestr("archive/more.warc.gz", b"".join(other))
        out.writestr(warc_zip.INDEX, "\n".join(lines))
    records = warc_zip.read_archives(spark.createDataFrame([(path,)], "archive string"))
    assert sorted(r.record_id for r in records.collect()) == sorted(f"{warc_zip.URN}{i}" for i in range(12))


@pytest.mark.parametrize("indexed", [False, True])
def test_compressed_and_cut_members_are_refused(tmp_path, indexed):
    record = warc_zip._gzip_member(warc_zip._record("1", None, "u", b"payload")[0])
    for data, kind, why in ((record, zipfile.ZIP_DEFLATED, "compressed"), (record * 2 + record[:-9], zipfile.ZIP_STORED, "inside a record")):
        with zipfile.ZipFile(tmp_path / "bad.wacz", "w") as out:
            out.writestr("archive/more.warc.gz", data, compress_type=kind)
            if indexed:
                out.writestr(warc_zip.INDEX, b"")
        file = pafs.LocalFileSystem().open_input_file(str(tmp_path / "bad.wacz"))
        with pytest.raises(ValueError, match=why):
            list(warc_zip._located(file, warc_zip.members(file)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc_zip.write_archives(empty)
    assert archives.count() == 0 and warc_zip.read_archives(archives).count() == 0


def test_query_equals_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op8_warc_zip"]).fetchall(), key=str)
    assert sorted((tuple(r) for r in QUERIES["op8_warc_zip"](spark, sf).collect()), key=str) == want
