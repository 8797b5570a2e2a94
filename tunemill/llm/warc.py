"""WARC archives of pages, with a two-level capture index, and reading them back through it.

Tasks write archive files (a gzip member per record). Their captures are sorted by key, the URL with
its host reversed, and written as index files of compressed blocks; a sparse directory has the first
and last key of each block. A lookup finds the block by binary search in the part of the directory
that covers the keys of its task, reads that range of the index file, and then the record's range.

Files go to the folder that all executors share, under names no other attempt of a task uses. They
count only if their task's rows were committed, so a lost executor leaves files behind that nothing
names, never a wrong or doubled record. Nothing of size passes the driver.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import steps, utf8
from tunemill.session import scratch_path, written

#: Equal payloads of at least so many bytes are stored once.
LEAST_REVISIT = 0
BLOCK_LINES = 3000
#: A task begins another archive file after so many bytes.
FILE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: First half of the record ids: with a page id, and without.
_OWN, _NONE = 0x70616765_0000_4000, 0x6E6F6E65_0000_4000
CAPTURE = "key string, page_id long, file string, begin long, length long"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Key of a URL: host labels from the last to the first, then the rest; scheme and case left out."""
    rest = (url or "").partition("://")[2] or (url or "")
    host = re.match(r"[^/?#]*", rest)[0]
    labels = host.lower().partition(":")[0].split(".")
    return quote(f"{','.join(reversed(labels))}){rest[len(host):]}", safe="/,)?&=:;+~.-_%#@!$'(*")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Key of one capture, unique by page: bytes sort by URL key and then by page."""
    return f"{url_key(url)} {'-' if page_id is None else format(page_id + (1 << 63), '020d')}"


def record_id(page_id: int | None) -> str:
    high = _NONE if page_id is None else _OWN
    return f"<urn:uuid:{uuid.UUID(int=high << 64 | (page_id or 0) & (1 << 64) - 1)}>"


def page_of(record: str) -> int | None:
    """Page id of a record id."""
    number = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    low = number & (1 << 64) - 1
    return None if number >> 64 == _NONE else low - (low >> 63 << 64)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record. A revisit leaves the payload out and names its size and the response."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE),
            ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url or "")),
            ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")]
    body = HTTP + payload
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)),
                 ("X-Payload-Length", str(len(payload)))]
        body = HTTP
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields of one record, names in lower case, and its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) < size:
        raise ValueError("record cut short")
    return fields, rest[:size]


def file_system(uri: str):
    """File system of a folder and its path there; a path without a scheme is a local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _squeezed(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Appender:
    """Files of one task attempt, one after the other."""

    def __init__(self, folder: str, ending: str, limit: int):
        self.folder, self.ending, self.limit, self.out = folder, ending, limit, None

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is not None and self.at >= self.limit:
            self.close()
        if self.out is None:
            system, path = file_system(self.folder)
            system.create_dir(path, recursive=True)
            self.name, self.at = f"{uuid.uuid4().hex}{self.ending}", 0
            self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.out.write(data)
        begin, self.at = self.at, self.at + len(data)
        return self.name, begin, len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(pages: DataFrame, folder: str, least_revisit: int = LEAST_REVISIT,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages``; gives the captures, a table in the shared folder.

    Of rows with equal payloads of at least ``least_revisit`` bytes the one with the smallest page_id
    is a response and the others revisit it (rows that repeat its id are responses too). A NULL html
    is an empty payload, a NULL url an empty one. Rows with a NULL page_id revisit a row that has
    one, and are responses where there is none. Other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html")
    digests = rows.select("page_id", F.coalesce("html", F.lit("")).alias("_html")).select(
        "page_id", F.sha1(F.col("_html").cast("binary")).alias("digest"),
        F.octet_length("_html").alias("size"))
    first = written(
        digests.where(F.col("size") >= least_revisit).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("rows"))
        .where("rows > 1 AND first IS NOT NULL").select("digest", "first"), "first-captures")
    named = (rows.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
             .join(first, "digest", "left")
             .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
             .select("page_id", "url", "html", "refers_to"))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Appender(folder, ".warc.gz", file_bytes)
        for batch in steps(batches, "html"):
            found = []
            for page, url, html, refers in zip(
                    batch.column("page_id").to_pylist(), batch.column("url").to_pylist(),
                    utf8(batch.column("html")), batch.column("refers_to").to_pylist()):
                place = out.add(_squeezed(record(page, url, html, refers)))
                found.append((capture_key(url, page), page, *place))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found), (
                    pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                ["key", "page_id", "file", "begin", "length"])
        out.close()

    return written(named.mapInArrow(per_task, CAPTURE), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> str:
    """Write the captures as sorted, compressed blocks; gives the path of the block directory."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Appender(folder, ".index.gz", FILE_BYTES)
        held: list[str] = []

        def block() -> pa.RecordBatch:
            place = out.add(_squeezed("".join(held).encode()))
            ends = [held[0].split("\t", 1)[0], held[-1].split("\t", 1)[0]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (*ends, *place)], ["first", "last", "file", "begin", "length"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "begin", "length"))):
                held.append("{}\t{}\t{}\t{}\n".format(*row))
                if len(held) == block_lines:
                    yield block()
        if held:
            yield block()
        out.close()

    directory = (captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
                 .mapInArrow(per_task, "first string, last string, file string, begin long, length long"))
    path = scratch_path(captures.sparkSession, "block-directory")
    directory.write.parquet(path)
    return path


def _directory_part(path: str, low: str, high: str) -> list[tuple]:
    """The blocks of the directory that may hold keys from ``low`` to ``high``, sorted."""
    import pyarrow.dataset as ds

    system, at = file_system(path)
    table = ds.dataset(at, filesystem=system, format="parquet").to_table(
        filter=(ds.field("first") <= high) & (ds.field("last") >= low))
    return sorted(zip(*(table.column(c).to_pylist() for c in ("first", "last", "file", "begin", "length"))))


def look_up(keys: DataFrame, directory: str, folder: str) -> DataFrame:
    """Places of the records of the captures in ``keys`` (column ``key``), through the index.

    A key that the index doesn't have gives no row; a key asked for or captured more than once gives
    its captures once for each time it is asked for.
    """
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        loaded, lines = None, {}
        for batch in batches:
            wanted = batch.column("key").to_pylist()
            if not wanted:
                continue
            blocks = _directory_part(directory, wanted[0], wanted[-1])
            firsts = [b[0] for b in blocks]
            found = []
            for key in wanted:
                at = bisect_right(firsts, key) - 1
                # captures with one key may go on from the blocks before
                while at >= 0 and blocks[at][1] >= key:
                    if loaded != blocks[at][2:4]:
                        loaded, lines = blocks[at][2:4], {}
                        with system.open_input_file(f"{root}/{blocks[at][2]}") as f:
                            data = zlib.decompress(f.read_at(blocks[at][4], blocks[at][3]), 31).decode()
                        for line in data.split("\n")[:-1]:
                            name, file, begin, length = line.split("\t")
                            lines.setdefault(name, []).append((file, int(begin), int(length)))
                    found += lines.get(key, [])
                    at -= 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*found) if found else ((), (), ()), (pa.string(), pa.int64(), pa.int64()))],
                ["file", "begin", "length"])

    return (keys.select("key").repartitionByRange("key").sortWithinPartitions("key")
            .mapInArrow(per_task, "file string, begin long, length long"))


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)`` of records.

    Reads the range of each record. Payload, size and digest are those of the bytes read; for a
    revisit the payload is NULL and the other two are what the record says of the full payload.
    """
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, source = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                found = []
                part = batch.slice(start, 500)
                for file, begin, length in zip(*(part.column(c).to_pylist() for c in ("file", "begin", "length"))):
                    if file != name:
                        name, source = file, system.open_input_file(f"{root}/{file}")
                    fields, block = parsed(zlib.decompress(source.read_at(length, begin), 31))
                    kind = fields["warc-type"]
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    said = fields["warc-payload-digest"].removeprefix("sha1:")
                    if payload is not None and payload_digest(payload) != said:
                        raise ValueError(f"payload of {fields['warc-record-id']} doesn't have its digest")
                    found.append((
                        page_of(fields["warc-record-id"]), fields["warc-target-uri"], payload,
                        int(fields["x-payload-length"]) if payload is None else len(payload), said, kind,
                        page_of(fields["warc-refers-to"]) if payload is None else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (
                        pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return (places.repartitionByRange("file", "begin").sortWithinPartitions("file", "begin").mapInArrow(
        per_task, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                  "record_type string, refers_to long"))


def archived(pages: DataFrame, least_revisit: int = LEAST_REVISIT,
             block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write ``pages`` as archives with their index, look all captures up in it, and read them back.

    Rows as in :func:`read_records`, one for every row of ``pages``; an empty table gives none.
    """
    folder = scratch_path(pages.sparkSession, "archives")
    captures = write_archives(pages, folder, least_revisit)
    directory = write_index(captures, folder, block_lines)
    keys = captures.select("key").distinct()
    return read_records(written(look_up(keys, directory, folder), "places"), folder)


def digest_sql(html: str) -> str:
    """DuckDB expression for the base32 SHA-1 of an expression's UTF-8."""
    bits = ("array_to_string(list_transform(range(40), lambda i: lpad(bin(instr('0123456789abcdef', "
            f"substr(sha1({html}), i::INT + 1, 1)) - 1), 4, '0')), '')")
    value = "list_sum(list_transform(range(5), lambda j: (substr(b, (k * 5 + j + 1)::INT, 1) = '1')::INT * (16 >> j::INT)))"
    return (f"(SELECT array_to_string(list_transform(range(32), lambda k: "
            f"substr('{_BASE32}', ({value})::INT + 1, 1)), '') FROM (SELECT {bits} AS b))")
