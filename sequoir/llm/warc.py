"""WARC archives with a two-level capture index.

Archives hold one gzip member per record; equal payloads are stored once and
revisited. The index sorts captures by reversed-host URL key into compressed
blocks. Every index file ends with its sparse block directory, and a small top
table names the files with their first and last keys. A lookup searches the top
table, then a directory, by bisection, and reads only the blocks and records it
needs, by range. What it finds is blocks first, which are dealt out anew: a URL
with very many captures is read by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequoir.llm.common import forget, map_arrow, materialise, shared_dir

#: Records of payloads under so many bytes are all responses.
MIN_REVISIT_BYTES = 0
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Captures in an index block, and bytes of it before compression.
BLOCK_CAPTURES = 512
BLOCK_BYTES = 64 << 10
GZIP_LEVEL = 1
#: Repeated payloads whose digests are broadcast (under 100 bytes each); more are joined by a shuffle.
SENT_REPEATS = 200_000
#: Bytes of an archive that are read back by one task in a row.
READ_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"

CAPTURES = "surt string, url string, page_id long, digest string, record_type string, archive string, start long, length long"
TOP = "index_file string, first_key string, last_key string, n_captures long, directory_start long, directory_length long"
PAYLOADS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def surt(url: str | None) -> str:
    """Reversed-host key of a URL: `com,example,m)/path?query`; empty if null."""
    if not url:
        return ""
    m = re.search(r"://([^/?#]*)([^#]*)", url)
    host, rest = (m[1], m[2]) if m else ("", url)
    host, _, port = host.rpartition("@")[2].partition(":")
    return ",".join(reversed(host.lower().split("."))) + (f":{port}" if port else "") + ")" + (rest or "/")


def _header_value(text: str) -> str:
    """A header's value: control characters and what isn't ASCII are percent-encoded."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP headers of its capture and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record; raises ValueError if it is damaged."""

    def headers(text: bytes) -> dict[str, str]:
        pairs = (x.split(":", 1) for x in text.decode().split("\r\n")[1:])
        return {k.strip().lower(): v.strip() for k, v in pairs}

    head, found, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    size = int(warc["content-length"])
    if not found or not head.startswith(b"WARC/1.") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return warc, headers(http), payload


def _number(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class _Archives:
    """Opened archives and index files, read by range."""

    def __init__(self) -> None:
        self.name, self.file = "", None

    def read(self, uri: str, start: int, length: int) -> bytes:
        if uri != self.name:
            self.close()
            system, path = _open(uri)
            self.name, self.file = uri, system.open_input_file(path)
        return self.file.read_at(length, start)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.name, self.file = "", None


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) into archives under folder; returns the captures.

    Null html is an empty payload. Of equal payloads of min_bytes or more, rows
    with the smallest page_id are responses and the others revisit it; rows
    without a page_id never are what is revisited, and are responses if no
    copy has a page_id. Archive names are new with each attempt of a task, and
    only those of the attempts that Spark commits are in the captures.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    repeats = pages.select("page_id", F.sha1(body).alias("sha")).groupBy("sha").agg(F.min("page_id").alias("keeper"), F.count("*").alias("n"))
    repeats = materialise(repeats.where("n > 1").select("sha", "keeper"), "repeats")  # payloads don't travel for those that occur once
    if repeats.count() <= SENT_REPEATS:
        repeats = F.broadcast(repeats)
    hashed = pages.select("page_id", "url", body.alias("payload"), F.sha1(body).alias("sha")).join(repeats, "sha", "left")
    again = (F.length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    ready = hashed.select("page_id", "url", "payload", F.when(again, F.col("keeper")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, payload, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, at = system.open_output_stream(f"{path}/{name}", compression=None), 0
                digest = base32_sha1(payload)
                packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url, payload, digest, refers_to, refers_to is not None)) + packer.flush()
                out.write(data)
                rows.append((surt(url), url, page_id, digest, "response" if refers_to is None else "revisit", f"{folder}/{name}", at, len(data)))
                at += len(data)
            yield _rows(rows, CAPTURES)
        if out is not None:
            out.close()

    return map_arrow(ready, run, CAPTURES)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64()}
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write captures, sorted by key, as index files under folder; returns the top table, a row per file."""
    ranged = captures.repartitionByRange(F.col("surt"), F.col("page_id"), F.col("archive"), F.col("start")).sortWithinPartitions("surt", "page_id", "archive", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        packer = zstandard.ZstdCompressor(level=3)
        out, at, directory, lines, size, total = None, 0, [], [], 0, 0
        name = f"{uuid.uuid4().hex}.cdx.zst"

        def flush() -> None:
            nonlocal at, lines, size
            if lines:
                data = packer.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode())
                out.write(data)
                directory.append((lines[0][0], lines[-1][0], len(lines), at, len(data)))
                at, lines, size = at + len(data), [], 0

        for batch in batches:
            for line in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if out is None:
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(line)
                size += len(line[0]) + len(line[1] or "") + 120
                total += 1
                if len(lines) >= BLOCK_CAPTURES or size >= BLOCK_BYTES:
                    flush()
        if out is not None:
            flush()
            end = packer.compress(json.dumps(directory, ensure_ascii=False).encode())
            out.write(end)
            out.close()
            yield _rows([(f"{folder}/{name}", directory[0][0], directory[-1][1], total, at, len(end))], TOP)

    return map_arrow(ranged.select("surt", "url", "page_id", "digest", "record_type", "archive", "start", "length"), run, TOP)


def _unpacked(files: _Archives, uri: str, start: int, length: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(files.read(uri, start, length))


def all_captures(top: DataFrame) -> DataFrame:
    """Every capture of the index, read block by block; an index file is one task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Archives()
        for batch in batches:
            for row in batch.to_pylist():
                uri = row["index_file"]
                for *_, start, length in json.loads(_unpacked(files, uri, row["directory_start"], row["directory_length"])):
                    yield _rows([tuple(json.loads(x)) for x in _unpacked(files, uri, start, length).decode().split("\n")], CAPTURES)
        files.close()

    return map_arrow(top.repartition(_cores(top), "index_file"), run, CAPTURES)


def lookup(urls: DataFrame, top: DataFrame) -> DataFrame:
    """Captures of urls (url) by their key, each once: bisection in the top table and in a directory, then range reads.

    The top table has a row for each index file (as many as the index had
    partitions), so it goes to every task.
    """
    table = sorted((r.first_key, r.last_key, r.index_file, r.directory_start, r.directory_length) for r in top.collect())

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(x) for x in batch.column(0).to_pylist()], pa.string())], ["surt"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, lasts, at, directory = _Archives(), [x[1] for x in table], "", []
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                for first, _, index_file, start, length in table[bisect_left(lasts, key) :]:
                    if first > key:
                        break
                    if index_file != at:
                        at, directory = index_file, json.loads(_unpacked(files, index_file, start, length))
                    k = bisect_left(directory, key, key=lambda x: x[1])
                    while k < len(directory) and directory[k][0] <= key:
                        rows.append((key, index_file, *directory[k][3:5]))
                        k += 1
            yield _rows(rows, BLOCKS)
        files.close()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, held, block = _Archives(), None, {}
        for batch in batches:
            rows = []
            for key, index_file, start, length in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (index_file, start) != held:
                    held, block = (index_file, start), {}
                    for line in _unpacked(files, index_file, start, length).decode().split("\n"):
                        line = json.loads(line)
                        block.setdefault(line[0], []).append(tuple(line))
                rows += block.get(key, [])
                if len(rows) >= ROWS_AT_ONCE:  # a batch may ask for any number of blocks of a key that many pages share
                    yield _rows(rows, CAPTURES)
                    rows = []
            yield _rows(rows, CAPTURES)
        files.close()

    asked = map_arrow(urls.select("url"), keys, "surt string").distinct()
    sorted_ = asked.repartitionByRange("surt").sortWithinPartitions("surt")
    blocks = map_arrow(sorted_, find, BLOCKS)
    return map_arrow(blocks.repartition(_cores(urls), "index_file", "start").sortWithinPartitions("index_file", "start"), read, CAPTURES)


#: Captures that are passed on at once.
ROWS_AT_ONCE = 2_048
BLOCKS = "surt string, index_file string, start long, length long"


def _cores(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_records(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to as the captures' records have them, read by range.

    Length and digest of a response are those of the payload that was read; of
    a revisit, which has none, those that its headers state.
    """
    dealt = captures.select("archive", "start", "length", F.floor(F.col("start") / READ_BYTES).alias("part"))
    dealt = dealt.repartition(_cores(captures), "archive", "part").sortWithinPartitions("archive", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Archives()
        for batch in batches:
            rows = []
            for archive, start, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                warc, http, payload = parse_record(zlib.decompress(files.read(archive, start, length), 31))
                kind, stated = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
                digest, size = (stated, int(http["content-length"])) if kind == "revisit" else (base32_sha1(payload), len(payload))
                if digest != stated:
                    raise ValueError(f"damaged payload in {archive} at {start}")
                rows.append((_number(warc["warc-record-id"]), size, digest, kind, _number(warc.get("warc-refers-to"))))
            yield _rows(rows, PAYLOADS)
        files.close()

    return map_arrow(dealt, run, PAYLOADS)


def resolved(records: DataFrame) -> DataFrame:
    """records, with each revisit's length and digest taken from the response that it refers to.

    Fails if a revisit has no response or another digest than it.
    """
    read = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("read_digest")).agg(F.min("payload_bytes").alias("read_bytes"))
    again = records.where("record_type = 'revisit'").join(read, (records.refers_to == read.refers_to) & (records.payload_digest == read.read_digest), "left")
    damaged = F.raise_error(F.concat(F.lit("no response for the revisit of page "), records.refers_to.cast("string"))).cast("long")
    again = again.select("page_id", F.coalesce("read_bytes", damaged).alias("payload_bytes"), F.col("read_digest").alias("payload_digest"), "record_type", records.refers_to)
    return records.where("record_type = 'response'").unionByName(again)


def new_folder(spark: SparkSession) -> str:
    """A folder for archives and index files in the shared folder."""
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    if "://" not in folder:
        folder = f"file://{folder}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return folder


def archive(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write archives and their index into a folder, a new one in the shared folder if none is named: captures and the top table."""
    folder = folder or new_folder(spark)
    captures = materialise(write_archives(pages, folder, min_bytes), "captures")
    return captures, materialise(build_index(captures, folder), "index-top")


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) as archives, then look every page's URL up in the index and read its records back.

    One row per row of pages, also for null and repeated page_ids, null URLs
    and empty tables; other columns aren't read. Archives and index are deleted
    once they are read.
    """
    spark = pages.sparkSession
    folder = new_folder(spark)
    captures, top = archive(spark, pages, min_bytes, folder)
    records = materialise(read_records(lookup(pages, top)), "records")
    forget(captures)
    forget(top)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return resolved(records)


def round_trip_sql() -> str:
    """The query in DuckDB's SQL: five hex digits of the digest make four of base 32."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    hexits = "0123456789abcdef"
    digits = []
    for at in range(1, 41, 5):
        value = " + ".join(f"(strpos('{hexits}', substr(sha, {at + i}, 1)) - 1) * {16 ** (4 - i)}" for i in range(5))
        digits += [f"substr('{letters}', CAST((({value}) // {32 ** (3 - i)}) % 32 + 1 AS INTEGER), 1)" for i in range(4)]
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
k AS (SELECT sha, min(page_id) AS keeper FROM p GROUP BY sha)
SELECT p.page_id AS page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, {' || '.join(digits).replace('sha,', 'p.sha,')} AS payload_digest,
  CASE WHEN p.page_id = k.keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id = k.keeper THEN NULL ELSE k.keeper END AS refers_to
FROM p JOIN k ON p.sha = k.sha
"""
