"""Token sequences as length-delimited binary records.

A shard is a file: 8 bytes of head (magic, version, bytes of an id), then for each record

    length (u64) | masked crc32 of the length (u32) | payload | masked crc32 of the payload (u32)

all little-endian. The payload is doc_id (i64), a byte that is 1 if the id is null, and the ids. Beside each shard stands an
index file (.idx): 8 bytes of magic, then for each record doc_id (i64), null (u8), offset (u64), ids (u64), by which a reader can fetch
records in any order. Shards are written under names of their own by each attempt of a task; only those in the manifest, a Parquet table
that Spark commits, count, so lost executors and repeated tasks leave nothing wrong behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_ROWS, cut, fresh_path
from .token_ids import piece_ids

MAGIC, INDEX_MAGIC, VERSION = b"TLRC", b"TLRCIDX1", 1
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("ids", "<u8")])
#: A shard is closed once it is this large.
SHARD_BYTES = 64 << 20
#: Bytes of text of a range of ids about, so that a task's share stays the same when the input grows.
RANGE_BYTES = 64 << 20
MANIFEST = "part int, roll int, path string, n_docs long, n_tokens long, n_bytes long"


def masked(crc: int) -> int:
    """Rotated and moved by a constant, so that a checksum of data which holds checksums stays sound."""
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(zlib.crc32(length))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at an offset, and where the next one begins. Raises ValueError on a wrong checksum."""
    length = data[at : at + 8]
    if struct.unpack("<I", data[at + 8 : at + 12])[0] != masked(zlib.crc32(length)):
        raise ValueError(f"wrong checksum of a length at {at}")
    end = at + 12 + struct.unpack("<Q", length)[0]
    payload = data[at + 12 : end]
    if struct.unpack("<I", data[end : end + 4])[0] != masked(zlib.crc32(payload)):
        raise ValueError(f"wrong checksum of a payload at {at}")
    return payload, end + 4


class Shard:
    """One shard being written, with its index."""

    def __init__(self, folder: str, part: int, roll: int, dtype: np.dtype):
        self.uri = f"{folder}/shard-{part:06d}-{roll:04d}-{uuid.uuid4().hex[:12]}.rec"
        self.fs, self.path = fs.FileSystem.from_uri(self.uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path)
        self.part, self.roll, self.width, self.entries, self.tokens = part, roll, dtype.itemsize, [], 0
        self.at = self.out.write(MAGIC + struct.pack("<HH", VERSION, self.width))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.width
        self.entries.append((doc_id or 0, doc_id is None, self.at, n))
        record = frame(struct.pack("<qB", doc_id or 0, doc_id is None) + ids)
        self.out.write(record)
        self.at += len(record)
        self.tokens += n

    def close(self) -> dict:
        self.out.close()
        with self.fs.open_output_stream(f"{self.path}.idx") as index:
            index.write(INDEX_MAGIC + np.array(self.entries, INDEX).tobytes())
        return {"part": self.part, "roll": self.roll, "path": self.uri, "n_docs": len(self.entries), "n_tokens": self.tokens, "n_bytes": self.at}


class ShardReader:
    """Records of a shard by position, in any order, each checked."""

    def __init__(self, uri: str):
        files, path = fs.FileSystem.from_uri(uri)
        with files.open_input_stream(f"{path}.idx") as f:
            raw = f.read()
        if raw[:8] != INDEX_MAGIC:
            raise ValueError(f"no index: {uri}.idx")
        self.index = np.frombuffer(raw, INDEX, offset=8)
        with files.open_input_stream(path) as f:
            self.data = memoryview(f.read())
        magic, version, width = struct.unpack("<4sHH", self.data[:8])
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"no shard: {uri}")
        self.dtype = np.dtype(f"<u{width}")

    def __len__(self) -> int:
        return len(self.index)

    def __getitem__(self, i: int) -> tuple[int | None, np.ndarray]:
        payload, _ = unframe(self.data, int(self.index["offset"][i]))
        doc_id, null = struct.unpack("<qB", payload[:9])
        return None if null else doc_id, np.frombuffer(payload, self.dtype, offset=9)


def write_records(docs: DataFrame, path: str, *, folder: str | None = None, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encodes whole texts with the vocabulary at `path`, writes them in ascending id order (null ids first) and returns the manifest.

    A null or empty text has the end id alone. Rows that share an id stand in an order that their texts fix; repeated rows are
    written each. Other columns are not read. An empty table gives an empty manifest. Rows are dealt by ranges of id and text hash,
    so many rows of one id do not meet in one task.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "records")
    if not partitions:
        n_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // RANGE_BYTES))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, roll, part = None, 0, TaskContext.get().partitionId()
        schema = pa.schema([("part", pa.int32()), ("roll", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])
        for batch in batches:
            pieces = piece_ids(path)
            end = b"" if end_id is None else np.array([end_id], pieces.dtype).tobytes()
            for doc_id, ids in zip(batch.column(0).to_pylist(), pieces.encode_all(batch.column(1).to_pylist())):
                shard = shard or Shard(folder, part, roll, pieces.dtype)
                shard.add(doc_id, ids + end)
                if shard.at >= SHARD_BYTES:
                    yield pa.RecordBatch.from_pylist([shard.close()], schema)
                    shard, roll = None, roll + 1
        if shard:
            yield pa.RecordBatch.from_pylist([shard.close()], schema)

    return cut(rows.select("doc_id", "text").mapInArrow(write, MANIFEST), "manifest")


def read_records(manifest: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids before the document in the whole output), n_tokens, ids_crc32 of each record, read back from the shards of a manifest; with_ids adds ids.

    `start` needs one running sum over the manifest, which has a row for each shard of 64 MB, not for each document.
    """
    ordered = Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(ordered), F.lit(0)))
    # a task reads some shards one after another
    most = 4 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards.select("path", "before").repartition(max(1, min(most, manifest.count())))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = ShardReader(uri)
                for first in range(0, len(reader), 4096):
                    out: list[list] = [[], [], [], [], []]
                    for i in range(first, min(first + 4096, len(reader))):
                        doc_id, ids = reader[i]
                        for column, value in zip(out, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids)):
                            column.append(value)
                        start += len(ids)
                    columns = [pa.array(c, pa.int64()) for c in out[:4]]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns, names = [*columns, pa.array([x.astype("i8") for x in out[4]], pa.list_(pa.int64()))], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return shards.mapInArrow(read, schema)
