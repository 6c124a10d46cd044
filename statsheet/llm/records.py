"""Token ids as length-delimited binary records with a separate offset index.

A shard ``shard-00007.rec`` is a sequence of records, one per document::

    u64 length | u32 masked CRC-32 of those 8 bytes | payload | u32 masked CRC-32 of the payload

all little-endian; the payload is an i64 document id, a flag byte (1: the id
is null, 2: ids are u16) and the ids, as u16 where all of them fit, else u32.  The mask is ``rotate_right(crc, 15) + 0xA282EAD8``
(mod 2**32), so that a checksum of data that holds checksums stays useful.
``shard-00007.idx`` holds the u64 offset of every record, and the file's end
last, for reads in any order.  Shards hold ascending document ids, and shard
numbers ascend with them.

Defined cases: a null text counts as empty, so its record holds the end id
only.  Null document ids come first.  Repeated ids stay separate records, in
the order of their texts.  An empty table makes no shards and no rows.  A bad
length or checksum raises.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Out, file_system, make_folder, prepare, put_file, rows_of, shared_folder
from .tokens import broadcast_vocabulary, encoder

_MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_ID = struct.Struct("<qB")


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    values = np.frombuffer(ids, "<u4")
    narrow = not len(values) or int(values.max()) < 1 << 16
    payload = _ID.pack(doc_id or 0, (doc_id is None) | narrow << 1) + (values.astype("<u2").tobytes() if narrow else ids)
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def _exactly(f, n: int) -> bytes:
    data = f.read(n)
    if len(data) != n:
        raise ValueError("the record file ends within a record")
    return data


def read_record(f) -> tuple[int | None, bytes] | None:
    """Next (document id, ids) of an open file; None at its end."""
    head = f.read(_HEAD.size)
    if not head:
        return None
    if len(head) != _HEAD.size:
        raise ValueError("the record file ends within a record")
    length, crc = _HEAD.unpack(head)
    if masked_crc(head[:8]) != crc:
        raise ValueError("a record's length does not fit its checksum")
    payload = _exactly(f, length)
    if masked_crc(payload) != struct.unpack("<I", _exactly(f, 4))[0]:
        raise ValueError("a record does not fit its checksum")
    doc_id, flags = _ID.unpack_from(payload)
    ids = payload[_ID.size :]
    return (None if flags & 1 else doc_id), np.frombuffer(ids, "<u2").astype("<u4").tobytes() if flags & 2 else ids


def read_index(uri: str) -> array:
    """Offsets of a shard's records, and its end."""
    fsys, path = file_system(uri)
    with fsys.open_input_stream(path, compression=None) as f:
        return array("Q", f.read())


def read_at(uri: str, offset: int) -> tuple[int | None, bytes]:
    """The record at an offset of the index."""
    fsys, path = file_system(uri)
    with fsys.open_input_file(path) as f:
        f.seek(offset)
        found = read_record(f)
    if found is None:
        raise ValueError("no record there")
    return found


_SHARD = "shard int, uri string, records bigint, tokens bigint, bytes bigint"
_SHARD_PA = pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("records", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])


def write_records(docs: DataFrame, vocabulary_path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents; returns the manifest, one row per shard.

    The raw texts are range-partitioned by id (so the encoder runs once, after
    the shuffle, on sorted rows) and each task streams its rows into one shard.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or shared_folder(spark, "records")
    make_folder(folder)
    vocabulary = broadcast_vocabulary(spark, vocabulary_path)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(vocabulary), TaskContext.get().partitionId()
        offsets, at, tokens = array("Q"), 0, 0

        def frames():
            nonlocal at, tokens
            for rows in rows_of(batches, "doc_id", "text"):
                for doc_id, text in rows:
                    ids = enc.ids(text or "") + end
                    data = frame(doc_id, ids)
                    offsets.append(at)
                    at += len(data)
                    tokens += len(ids) // 4
                    yield data

        stream = frames()
        first = next(stream, None)
        if first is None:
            return
        uri = f"{folder}/shard-{shard:05d}.rec"
        put_file(uri, (x for part in ((first,), stream) for x in part))
        offsets.append(at)
        put_file(f"{folder}/shard-{shard:05d}.idx", [offsets.tobytes()])
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, uri, len(offsets) - 1, tokens, at), _SHARD_PA)], schema=_SHARD_PA)

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")
    # The hash lets a hot id spread over shards; equal rows need no order.
    ranged = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    manifest = f"{folder}/manifest.parquet"
    ranged.mapInArrow(run, _SHARD).write.parquet(manifest)
    return spark.read.schema(_SHARD).parquet(manifest)


_ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.int32()), ("offset", pa.int64())])


def read_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read the shards back: one row per record with ``start`` (ids of all
    records before it), token count, CRC-32 of the ids, shard and offset.

    The driver holds one (shard, tokens) pair for each file, never a record.
    """
    shards = sorted((r for r in manifest.collect()), key=lambda r: r["shard"])
    todo, base = [], 0
    for r in shards:
        todo.append((r["shard"], r["uri"], base, r["records"]))
        base += r["tokens"]
    width = min(max(1, len(todo)), spark.sparkContext.defaultParallelism * 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "shard", "uri", "base", "records"):
            for shard, uri, start, records in rows:
                out, offsets = Out(_ROW), read_index(uri[:-4] + ".idx")
                if len(offsets) != records + 1:
                    raise ValueError(f"{uri}: {records} records, {len(offsets) - 1} offsets")
                fsys, path = file_system(uri)
                with fsys.open_input_stream(path, compression=None, buffer_size=1 << 20) as f:
                    for k in range(records):
                        found = read_record(f)
                        if found is None:
                            raise ValueError(f"{uri} ends after {k} of {records} records")
                        doc_id, ids = found
                        out.add(doc_id, start, len(ids) // 4, zlib.crc32(ids), shard, offsets[k])
                        start += len(ids) // 4
                        if out.full():
                            yield out.take()
                    if f.read(1):
                        raise ValueError(f"{uri} goes on after its last record")
                yield out.take()

    files = spark.createDataFrame(todo, "shard int, uri string, base bigint, records bigint").repartition(width)
    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int, offset bigint")
