"""WARC archives with a two-level capture index.

Each page becomes a record, compressed on its own, of an archive file: the smallest page id of equal
payloads is a ``response``, the others are ``revisit`` records that refer to it and hold no payload.
The index has a line per record under its reversed-host key (``org,example,www)/path``). Lines are
sorted by ranges over all tasks and written as compressed blocks; the end of each index file is the sparse
directory of its blocks (first key, offset, length), and a small table holds the first and last key of each
file. A lookup bisects the files, then, file by file, the directory, range-reads each block once, bisects its lines, and
range-reads the records; a key whose lines fill several files is looked up in each of them by another task. Tasks write files under names of their own, and only those that a finished task reports are
used, so a lost or repeated task does no harm.

Payload: html in UTF-8, NULL is empty. Empty payloads are equal like others. Of equal page ids
the first row is the response; NULL ids come last. NULL urls have an empty key and no target. Control
characters of urls are percent-encoded. The shared folder must be of a kind that tasks can open by themselves (`SCHEMES`), else
nothing is begun. An empty table gives an empty result and no files; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import LOCATOR, located, plain_scan, rows_in, staged, table, work_dir

#: Bytes of an archive file before the next one begins; lines of an index block.
FILE_BYTES, BLOCK_LINES = 256 << 20, 512
#: Lines that a lookup gathers before it passes them on.
LINES = 10_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: Kinds of folders by Spark's name, and the name that tasks open them by.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
#: Capture date of pages that come without one.
DATE = "1970-01-01T00:00:00Z"

CAPTURE = "key string, record string, file string, offset bigint, length bigint"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"


def reversed_key(url: str | None) -> str:
    """``http://www.Example.org/a?b`` as ``org,example,www)/a?b``; a key sorts hosts with their subdomains."""
    if not url or "://" not in url:
        return url or ""
    rest = url.split("://", 1)[1].split("#", 1)[0]
    cut = re.search(r"[/?]", rest)
    host, tail = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "/")
    return ",".join(reversed(host.lower().split("."))) + ")" + tail


def openable(path: str) -> str:
    """``path`` under the name that tasks open it by; an error for other kinds of folders."""
    scheme, colon, rest = path.partition("://")
    if not colon and ":" not in path.split("/")[0]:
        return path
    scheme = scheme if colon else path.split(":")[0]
    if scheme not in SCHEMES:
        raise ValueError(f"archives cannot be written to {scheme}: folders, only to {', '.join(SCHEMES)}")
    return f"{SCHEMES[scheme]}://{rest}" if colon else path


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(openable(path))


def _record(row: dict, date: str) -> bytes:
    """One compressed record."""
    payload = row["payload"] if row["record_type"] == "response" else b""
    body = HTTP % row["payload_bytes"] + payload
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record']}>", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{row['digest']}", "Content-Type: application/http; msgtype=response",
    ]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"]))
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{row['refers']}>"]
    head.append(f"Content-Length: {len(body)}")
    plain = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(plain) + squeeze.flush()


def parse_record(member: bytes) -> dict:
    """Headers, and payload, of one compressed record."""
    head, rest = zlib.decompress(member, 31).split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return {"headers": headers, "payload": payload, "payload_bytes": length}


def _name(page_id: int | None, file: str, row: int) -> str:
    """A record's id; it carries the page id, and the row's place, since page ids may repeat."""
    place = hashlib.blake2b(f"{file}:{row}".encode(), digest_size=8).hexdigest()
    return f"urn:page:{'' if page_id is None else page_id}:{place}"


def _page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return int(page) if page else None


def _write(folder: str, date: str, file_bytes: int):
    names = ["key", "record", "file", "offset", "length"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    row["payload"] = (row["html"] or "").encode("utf-8", "surrogatepass")
                    row["digest"] = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    row["record"] = _name(row["page_id"], row["_file"], row["_row"])
                    row["refers"] = _name(row["first_id"], row["first_file"], row["first_row"])
                    same = row["refers"] == row["record"]
                    row["record_type"] = "response" if same else "revisit"
                    member = _record(row, date)
                    out.write(member)
                    rows.append((reversed_key(row["url"]), row["record"], name, offset, len(member)))
                    offset += len(member)
                yield _batch(rows, names)
        finally:
            if out is not None:
                out.close()

    return task


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _write_index(folder: str, block_lines: int):
    """An index file per task: compressed blocks, their directory, and the directory's place."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        name, directory, offset, out = f"{uuid.uuid4().hex}.cdx", [], 0, None
        held: list[list] = []

        def block() -> None:
            nonlocal offset
            packed = zlib.compress("\n".join(json.dumps(line) for line in held).encode())
            out.write(packed)
            directory.append([held[0][0], offset, len(packed)])
            offset += len(packed)

        last = None
        for batch in batches:
            for line in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if out is None:
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                held.append(list(line))
                last = line[0]
                if len(held) >= block_lines:
                    block()
                    held = []
        if out is None:
            yield _index_batch([])
            return
        if held:
            block()
        packed = zlib.compress(json.dumps(directory).encode())
        out.write(packed + len(packed).to_bytes(8, "big"))
        out.close()
        yield _index_batch([(name, directory[0][0], last, len(directory))])

    return task


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "first_key", "last_key", "blocks"])


class IndexFile:
    """An open index file: its directory, and range reads of blocks."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str):
        self.file = files.open_input_file(path)
        size = self.file.size()
        length = int.from_bytes(self.file.read_at(8, size - 8), "big")
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 8 - length)))
        self.keys = [d[0] for d in self.directory]
        self.held: tuple[int, list[list]] = (-1, [])

    def block(self, number: int) -> list[list]:
        """Lines of a block; the last one read is kept, so rising keys read each block once."""
        if self.held[0] != number:
            _, offset, length = self.directory[number]
            lines = zlib.decompress(self.file.read_at(length, offset)).decode().split("\n")
            self.held = number, [json.loads(line) for line in lines]
        return self.held[1]

    def lines(self, key: str) -> Iterator[list]:
        """Lines of a key: from the last block that begins before it, on while blocks begin with it."""
        number = max(0, bisect.bisect_left(self.keys, key) - 1)
        while number < len(self.keys) and self.keys[number] <= key:
            lines = self.block(number)
            at = bisect.bisect_left(lines, key, key=lambda line: line[0])
            while at < len(lines) and lines[at][0] == key:
                yield lines[at]
                at += 1
            number += 1


def _read_records(folder: str):
    """Range reads of captures, sorted by file and offset; digests of responses are checked."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            for _, record, at, offset, length in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if at != name:
                    if file is not None:
                        file.close()
                    name, file = at, files.open_input_file(f"{base}/{at}")
                found = parse_record(file.read_at(length, offset))
                headers = found["headers"]
                if headers["WARC-Record-ID"] != f"<{record}>":
                    raise ValueError(f"the index names {record}, the archive {headers['WARC-Record-ID']}")
                digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                if kind == "response":
                    own = base64.b32encode(hashlib.sha1(found["payload"]).digest()).decode()
                    if own != digest or len(found["payload"]) != found["payload_bytes"]:
                        raise ValueError(f"{record} does not match its digest or length")
                refers = headers.get("WARC-Refers-To")
                rows.append((_page_of(record), found["payload_bytes"], digest, kind, _page_of(refers) if refers else None, headers.get("WARC-Target-URI")))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if file is not None:
            file.close()

    return task


@dataclass
class Archive:
    """A folder of archive files, and one of index files with the keys each of them spans."""

    spark: SparkSession
    folder: str
    index: DataFrame  # file, first_key, last_key, blocks

    def captures(self) -> DataFrame:
        """All lines of the index."""
        folder = f"{self.folder}/index"

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, base = _filesystem(folder)
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    file = IndexFile(files, f"{base}/{name}")
                    for number in range(len(file.directory)):
                        yield _batch(file.block(number), ["key", "record", "file", "offset", "length"])

        spread = self.index.select("file").repartition("file")
        return spread.mapInArrow(task, CAPTURE)

    def lookup(self, urls: DataFrame, url: str = "url") -> DataFrame:
        """Index lines of the urls' keys, each line once, whatever number of urls ask for it.

        The first and last keys of the index files go to all tasks: a row for each task that wrote the index.
        """
        folder = f"{self.folder}/index"
        spans = sorted((r["first_key"], r["last_key"], r["file"]) for r in self.index.collect())
        shared = self.spark.sparkContext.broadcast(spans)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            firsts = [s[0] for s in shared.value]
            for batch in batches:
                rows = set()
                for key in set(map(reversed_key, batch.column(0).to_pylist())):
                    at = bisect.bisect_right(firsts, key) - 1
                    while at >= 0 and shared.value[at][1] >= key:
                        rows.add((shared.value[at][2], key))
                        at -= 1
                columns = list(zip(*rows)) if rows else [[], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["in_file", "key"])

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, base = _filesystem(folder)
            name, file = None, None
            for batch in batches:
                rows = []
                for in_file, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if in_file != name:
                        name, file = in_file, IndexFile(files, f"{base}/{in_file}")
                    for line in file.lines(key):
                        rows.append(tuple(line))
                        if len(rows) >= LINES:
                            yield _batch(rows, names)
                            rows = []
                yield _batch(rows, names)

        names = ["key", "record", "file", "offset", "length"]
        asked = urls.select(F.col(f"`{url}`")).distinct().mapInArrow(place, "in_file string, key string").distinct()
        return asked.repartition("in_file").sortWithinPartitions("in_file", "key").mapInArrow(find, CAPTURE)

    def read(self, captures: DataFrame) -> DataFrame:
        """Records of index lines, file by file."""
        near = staged(captures, "captures").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
        return near.mapInArrow(_read_records(f"{self.folder}/records"), RECORD)


def write_archive(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    date: str = DATE, file_bytes: int = FILE_BYTES, block_lines: int = BLOCK_LINES,
) -> Archive:
    """Archive files and index of ``pages`` in a new folder of the shared one."""
    spark = pages.sparkSession
    rows = located(plain_scan(pages)).select(
        F.col(f"row.`{key}`").cast("bigint").alias("page_id"), F.col(f"row.`{url}`").alias("url"), F.col(f"row.`{html}`").alias("html"), *LOCATOR)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    sized = staged(rows.select(
        "page_id", *LOCATOR, F.sha1(payload).alias("sha1"), F.sha2(payload, 256).alias("sha256"),
        F.length(payload).cast("bigint").alias("payload_bytes")), "payloads")
    same = ["sha1", "sha256", "payload_bytes"]
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", *LOCATOR)).alias("first")
    groups = staged(sized.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), first).where("n > 1").drop("n"), "payload-groups")
    again = staged(sized.join(groups, same).select(*LOCATOR, "first"), "payload-again")

    measured = rows.withColumns({"sha1": F.sha1(payload), "payload_bytes": F.length(payload).cast("bigint")})
    alone, marked = rows_in(measured, again)
    own = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", *LOCATOR)
    joined = marked.join(again, list(LOCATOR), "left").withColumn("first", F.coalesce("first", own))
    ready = alone.withColumn("first", own).unionByName(joined.select(*alone.columns, "first")).select(
        "page_id", "url", "html", *LOCATOR, "sha1", "payload_bytes", F.col("first.page_id").alias("first_id"),
        F.col("first._file").alias("first_file"), F.col("first._row").alias("first_row"))
    folder = work_dir(spark, "warc")
    openable(folder)
    lines = staged(ready.mapInArrow(_write(f"{folder}/records", date, file_bytes), CAPTURE), "warc-lines")
    index = staged(
        lines.repartitionByRange("key", "record").sortWithinPartitions("key", "record")
        .mapInArrow(_write_index(f"{folder}/index", block_lines), "file string, first_key string, last_key string, blocks bigint"), "warc-index")
    return Archive(spark, folder, index)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = write_archive(pages)
    return archive.read(archive.lookup(pages)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _oracle() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    # five hex digits are four letters
    digit = lambda i: f"(instr('0123456789abcdef', substr(h, {i}, 1)) - 1)"
    parts = []
    for g in range(8):
        bits = " + ".join(f"{digit(5 * g + i + 1)} * {16 ** (4 - i)}" for i in range(5))
        parts += [f"substr('{letters}', CAST((({bits}) // {32 ** (3 - i)}) % 32 AS INTEGER) + 1, 1)" for i in range(4)]
    return f"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT t, min(page_id) AS first_id FROM hashed GROUP BY t)
SELECT page_id, octet_length(encode(t)) AS payload_bytes, {' || '.join(parts)} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed JOIN first USING (t)
"""


ORACLE = _oracle()
