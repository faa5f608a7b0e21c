"""Web archives packed in ZIP files: WARC records, an index, and a reader that never extracts.

An archive is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz`` holds one gzip member
per WARC record, ``indexes/index.cdxj`` one line per record with its offset and length. The reader finds the end of the central
directory, follows the ZIP64 locator where there is one, reads the directory, locates the stored members through their local
headers and reads records by byte ranges; a long member is dealt out to many tasks by its index. Where no
index names a member, its gzip members are walked one after the other in bounded blocks. A compressed member is an error.

Files are opened with ``pyarrow.fs`` by URI, so archives can lie in any store it knows. A task writes files under names
of its own and reports them on success; what a lost executor left is never listed.

Defined cases: a null payload is empty; a null URL gives a record without target; a null key is written as the empty
name and read as null. Of rows with equal payloads (from ``min_revisit`` bytes on) those with the smallest key are
responses and the others revisit it; rows that repeat that smallest key with the same payload are all responses; null
keys come last, and rows with nothing but null keys are all responses. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import written
from orderlake.session import shared_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
URN = "urn:x-record:"
DATE = "2026-01-01T00:00:00Z"
RECORD = (
    "record_id string, record_type string, refers_to string, target_uri string, payload_digest string, "
    "payload_bytes long, payload binary, archive string, offset long"
)
#: Most bytes that one range read asks for, unless a single record is longer.
RANGE = 4 << 20


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_safe(text: str) -> str:
    return "".join(c if "!" <= c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _record(key: str, refers_to: str | None, url: str | None, payload: bytes) -> tuple[bytes, str]:
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{URN}{key}>"]
    head += [f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_safe(url)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def _gzip_member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class _Archive:
    """One archive in memory, of bounded size, written out in one go."""

    def __init__(self):
        self.data, self.lines = io.BytesIO(), []

    def add(self, key: str, refers_to: str | None, url: str | None, payload: bytes) -> None:
        record, digest = _record(key, refers_to, url, payload)
        offset, length = self.data.tell(), self.data.write(_gzip_member(record))
        entry = {"url": url, "digest": f"sha1:{digest}", "offset": offset, "length": length, "filename": DATA}
        self.lines.append(f"{_header_safe(url or '-')} {DATE} {json.dumps(entry)}\n")

    def save(self, folder: str) -> str:
        path = f"{folder}/{uuid.uuid4().hex}.wacz"
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_STORED) as out:
            for name, content in ((DATA, self.data.getvalue()), (INDEX, "".join(self.lines).encode())):
                with out.open(zipfile.ZipInfo(name), "w", force_zip64=True) as member:
                    member.write(content)
        files, name = pafs.FileSystem.from_uri(path)
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(name) as stream:
            stream.write(body.getbuffer())
        return path


def write_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 0, archive_bytes: int = 24 << 20
) -> DataFrame:
    """Write one record per row below the cluster's shared folder; returns the archives (``archive``, ``records``)."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.coalesce(F.col(payload), F.lit("")).alias("p"))
    rows = rows.withColumn("same", F.sha2("p", 256))
    # Only payloads that are there more than once take part in the join; their first keys are a slim table.
    groups = rows.where(F.octet_length("p") >= min_revisit).groupBy("same").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = written(groups.where((F.col("n") > 1) & F.col("first").isNotNull()).select("same", "first"), "warc_firsts")
    # A merge join at every size, so that the plan doesn't depend on the number of copies.
    rows = rows.join(firsts.hint("merge"), "same", "left")
    refers_to = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("k")), F.col("first").cast("string"))
    rows = rows.select(F.col("k").cast("string").alias("k"), refers_to.alias("r"), "u", "p")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = _Archive(), []
        for batch in batches:
            for k, r, u, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                archive.add(k or "", r, u, p.encode("utf-8", "surrogatepass"))
                if archive.data.tell() >= archive_bytes:
                    done.append((archive.save(folder), len(archive.lines)))
                    archive = _Archive()
        if archive.lines:
            done.append((archive.save(folder), len(archive.lines)))
        if done:
            paths, counts = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], names=["archive", "records"])

    return written(rows.mapInArrow(write, "archive string, records long"), "warc_list")


@dataclass(frozen=True)
class Member:
    """An entry of a central directory."""

    name: str
    method: int
    packed: int
    size: int
    header: int


def _read(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"the archive ends early: {length} bytes asked for at {offset}, {len(data)} there")
    return data


def members(file) -> list[Member]:
    """The central directory, found from the file's end; ZIP64 records are followed."""
    size = file.size()
    tail = _read(file, max(0, size - 65557), min(size, 65557))
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a central directory: not a ZIP file")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    locator = size - len(tail) + at - 20
    if locator >= 0 and (found := _read(file, locator, 20))[:4] == b"PK\x06\x07":
        record = _read(file, struct.unpack_from("<Q", found, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 locator points nowhere")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, out, at = _read(file, start, length), [], 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain = *struct.unpack_from("<H", directory, at + 10), *struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        values = [plain, packed, header]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                body, taken = extra[4 : 4 + n], 0
                for i, v in enumerate(values):
                    if v == 0xFFFFFFFF:
                        values[i] = struct.unpack_from("<Q", body, taken)[0]
                        taken += 8
            extra = extra[4 + n :]
        out.append(Member(name, method, values[1], values[0], values[2]))
        at += 46 + n_name + n_extra + n_comment
    return out


def data_start(file, member: Member) -> int:
    """Where a stored member's bytes begin, from its local header."""
    if member.method:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    head = _read(file, member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n_name + n_extra


def _indexed(file, listed: list[Member], named: set[str]) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records that the archive's indexes list; the members they are in are added to ``named``."""
    starts = {m.name: data_start(file, m) for m in listed if _holds_records(m)}

    def place(line: bytes) -> tuple[int, int]:
        entry = json.loads(line[line.index(b"{") :])
        named.add(entry["filename"])
        return starts[entry["filename"]] + int(entry["offset"]), int(entry["length"])

    for index in (m for m in listed if m.name.startswith("indexes/") and not m.method):
        begin, rest = data_start(file, index), b""
        for at in range(0, index.size, RANGE):
            *lines, rest = (rest + _read(file, begin + at, min(RANGE, index.size - at))).split(b"\n")
            yield from map(place, lines)
        # The last line may have no line break.
        if rest.strip():
            yield place(rest)


def _holds_records(member: Member) -> bool:
    return member.name.startswith("archive/") and not member.name.endswith("/")


def _walked(file, listed: list[Member]) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of archive members that no index names."""
    for m in filter(_holds_records, listed):
        begin, unpack, first, at = data_start(file, m), zlib.decompressobj(31), 0, 0
        while at < m.size:
            block = _read(file, begin + at, min(RANGE, m.size - at))
            while block:
                unpack.decompress(block)
                at += len(block) - len(unpack.unused_data)
                block = unpack.unused_data
                if unpack.eof:
                    yield begin + first, at - first
                    first, unpack = at, zlib.decompressobj(31)
        if first < at:
            raise ValueError(f"{m.name} ends inside a record")


def _located(file, listed: list[Member]) -> Iterator[tuple[int, int]]:
    """(offset, length) of all records: by index, and of the members that no index names by walking them."""
    named: set[str] = set()
    yield from _indexed(file, listed, named)
    yield from _walked(file, [m for m in listed if m.name not in named])


def _ranges(archives: DataFrame) -> DataFrame:
    """Rows (archive, start, lengths): neighbouring records that are read together."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = pafs.FileSystem.from_uri(path)
                rows: list[tuple[int, list[int]]] = []
                with files.open_input_file(name) as file:
                    for offset, length in _located(file, members(file)):
                        if rows and rows[-1][0] + sum(rows[-1][1]) == offset and sum(rows[-1][1]) + length <= RANGE:
                            rows[-1][1].append(length)
                        else:
                            rows.append((offset, [length]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(rows), pa.string()),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                    ],
                    names=["archive", "start", "lengths"],
                )

    return archives.select("archive").mapInArrow(locate, "archive string, start long, lengths array<long>")


def parse_record(data: bytes) -> tuple:
    """Identifier, type, referred identifier, target, payload digest, payload size, payload (null of a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    said = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = int(said.get("content-length", len(payload)))
    if kind == "response" and (size != len(payload) or digest != payload_digest(payload)):
        raise ValueError(f"record {fields['warc-record-id']} doesn't hold the payload it states")
    ids = [fields[f].strip("<>") if f in fields else None for f in ("warc-record-id", "warc-refers-to")]
    return ids[0], kind, ids[1], fields.get("warc-target-uri"), digest, size, payload if kind == "response" else None


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of the archives listed in column ``archive``."""
    ranges = _ranges(archives)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, name = pafs.FileSystem.from_uri(path)
                with files.open_input_file(name) as file:
                    data = _read(file, start, sum(lengths))
                rows, at = [], 0
                for n in lengths:
                    rows.append((*parse_record(zlib.decompress(data[at : at + n], 31)), path, start + at))
                    at += n
                kinds = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.string(), pa.int64()]
                names = [c.split()[0] for c in RECORD.split(", ")]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    # Without a key, so that the ranges of one large archive are read by many tasks.
    spread = ranges.repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(read, RECORD)


def key_of(record_id):
    """The key in a record identifier, as a long; null if there was none."""
    return F.substr(record_id, F.lit(len(URN) + 1)).try_cast("long")
