"""WARC archives: one gzip member per record, written and read back by Spark.

Writing: each page's payload (the HTML in UTF-8) becomes a compressed response
record where it is read; of equal payloads the page with the largest id stays
a response and the others are written as revisits, which name that page and
hold no payload.  Pages meet the groups of equal payloads in a join by digest,
which Spark may split where one payload is very common.

Reading: a sequential reader feeds a file to zlib in small pieces, restarts it
at every gzip member, frames each record by its Content-Length and checks block
and payload digests.  One record at a time is in memory.

Defined cases: null HTML is an empty payload; a null URL writes no target URI;
a null page id is smaller than any other, and equal payloads with null ids only
are all responses, as are repeated rows of the largest id.  Payloads under
``least`` bytes are always responses.  An empty table makes no archives.  A
wrong length or digest, or a cut file, raises.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Out, file_system, make_folder, prepare, put_file, rows_of, shared_folder

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 5
_PIECE = 1 << 16
_BAD = re.compile("[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    headers = [*headers, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", str(len(block)))]
    return b"".join((b"WARC/1.1\r\n", "".join(f"{k}: {v}\r\n" for k, v in headers).encode(), b"\r\n", block, b"\r\n\r\n"))


def _http(n: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n


def page_record(page_id: int | None, url: str | None, digest: str, n: int, payload: bytes | None, refers_to: int | None = None) -> bytes:
    """A response (with its payload) or, without payload, a revisit; one gzip member."""
    headers = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", _BAD.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if payload is None:
        headers += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    headers += [("WARC-Payload-Digest", "sha1:" + digest), ("Content-Type", "application/http;msgtype=response")]
    return _gzip(_record(headers, _http(n) + (payload or b"")))


def info_record() -> bytes:
    return _gzip(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:info>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))


def _members(f) -> Iterator[bytes]:
    """The decompressed data of each gzip member, read in small pieces."""
    data = f.read(_PIECE)
    while data:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not data:
                data = f.read(_PIECE)
                if not data:
                    raise ValueError("the archive ends within a record")
            out.append(z.decompress(data))
            data = z.unused_data if z.eof else b""
        yield b"".join(out)
        data = data or f.read(_PIECE)


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    def http(self) -> tuple[dict[str, str], bytes]:
        head, _, payload = self.block.partition(b"\r\n\r\n")
        return _fields(head.split(b"\r\n")[1:]), payload


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}


def read_archive(f) -> Iterator[Record]:
    """Records of an open archive, checked."""
    for data in _members(f):
        head, mark, rest = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        if not mark or not lines[0].startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        headers = _fields(lines[1:])
        name, n = headers.get("warc-record-id", "a record without id"), int(headers.get("content-length", -1))
        if n < 0 or rest[n:] != b"\r\n\r\n":
            raise ValueError(f"{name}: the block has not the stated length")
        r = Record(headers, rest[:n])
        if (d := headers.get("warc-block-digest")) and d != "sha1:" + base32_sha1(r.block):
            raise ValueError(f"{name}: wrong block digest")
        if r.kind == "response" and (d := headers.get("warc-payload-digest")) and d != "sha1:" + base32_sha1(r.http()[1]):
            raise ValueError(f"{name}: wrong payload digest")
        yield r


_MADE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("sha1", pa.binary()), ("n", pa.int64()), ("member", pa.binary())])
_FILE = "uri string, records bigint, bytes bigint"


def write_archives(pages: DataFrame, least: int = 0, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one archive per task; returns the manifest (uri, records, bytes)."""
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or shared_folder(spark, "warc")
    make_folder(folder)
    rows = pages.selectExpr(f"cast(`{id_col}` as bigint) page_id", f"cast(`{url_col}` as string) url", f"cast(coalesce(cast(`{html_col}` as string), '') as binary) html")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(_MADE)
        for part in rows_of(batches, "page_id", "url", "html"):
            for page_id, url, html in part:
                sha = hashlib.sha1(html).digest()
                member = page_record(page_id, url, base64.b32encode(sha).decode(), len(html), html)
                out.add(page_id, url, sha, len(html), member, size=len(member))
                if out.full():
                    yield out.take()
        yield out.take()

    made = rows.mapInArrow(compress, "page_id bigint, url string, sha1 binary, n bigint, member binary")
    # The groups need digests only, which Spark makes without Python; partial
    # aggregation leaves one row per task of a common payload.
    groups = (
        rows.selectExpr("page_id", "unhex(sha1(html)) sha1", "cast(octet_length(html) as bigint) n")
        .groupBy("sha1", "n")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & (F.col("n") >= least) & F.col("last").isNotNull())
        .select("sha1", "n", "last")
    )
    joined = made.join(groups, ["sha1", "n"], "left").select("page_id", "url", "sha1", "n", "last", F.when((F.col("page_id") == F.col("last")) | F.col("last").isNull(), F.col("member")).alias("member"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = 0

        def members() -> Iterator[bytes]:
            nonlocal records
            for part in rows_of(batches, "page_id", "url", "sha1", "n", "last", "member"):
                for page_id, url, sha, n, last, member in part:
                    if not records:
                        yield info_record()
                    records += 1
                    yield member or page_record(page_id, url, base64.b32encode(sha).decode(), n, None, last)

        stream = members()
        first = next(stream, None)
        if first is None:
            return
        uri = f"{folder}/part-{TaskContext.get().partitionId():05d}.warc.gz"
        size = put_file(uri, (x for part in ((first,), stream) for x in part))
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["uri", "records", "bytes"])

    manifest = f"{folder}/manifest.parquet"
    joined.mapInArrow(write, _FILE).write.parquet(manifest)
    return spark.read.schema(_FILE).parquet(manifest)


_READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_READ_PA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per response or revisit of all archives, in one task per archive
    at a time; with ``with_payload`` the payload too (null for revisits)."""
    prepare(spark)
    schema = _READ_PA.append(pa.field("payload", pa.binary())) if with_payload else _READ_PA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "uri", "records"):
            for uri, records in rows:
                out, seen = Out(schema), 0
                fsys, path = file_system(uri)
                with fsys.open_input_stream(path, compression=None) as f:
                    for r in read_archive(f):
                        if r.kind not in ("response", "revisit"):
                            continue
                        seen += 1
                        http, payload = r.http()
                        refers = r.headers.get("warc-refers-to")
                        row = (_page(r.headers["warc-record-id"]), r.headers.get("warc-target-uri"), int(http["content-length"]), r.headers["warc-payload-digest"].removeprefix("sha1:"), r.kind, _page(refers) if refers else None)
                        out.add(*row, *((payload if r.kind == "response" else None,) if with_payload else ()), size=len(payload) if with_payload else 0)
                        if out.full():
                            yield out.take()
                if seen != records:
                    raise ValueError(f"{uri}: {seen} records of {records}")
                yield out.take()

    files = manifest.select("uri", "records").repartition(max(1, spark.sparkContext.defaultParallelism * 4), "uri")
    return files.mapInArrow(run, _READ + ", payload binary" * with_payload)
