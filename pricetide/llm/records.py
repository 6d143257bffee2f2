"""Token ids as length-delimited binary records with a separate offset index.

A record is

    length      unsigned 64 bit, of the payload
    checksum    unsigned 32 bit, masked crc32 of the eight length bytes
    payload     document id (signed 64 bit), then its ids, ``dtype`` each
    checksum    unsigned 32 bit, masked crc32 of the payload

all little-endian.  A checksum is masked (turned by 15 bits, plus a constant) so
that data which itself holds checksums stays well mixed.  Beside ``x.rec`` lies
``x.idx``: for each record its offset and its payload's length, two unsigned 64-bit
numbers, so that records can be read in any order.

A data set is a folder of such pairs and a Parquet table ``manifest``.  Only files
named there count, so a file left by a lost or repeated task does no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.llm.common import tidy
from pricetide.llm.tokens import encoder, portions

_MASK_DELTA = 0xA282EAD8
_HEAD, _TAIL, _ID, _ENTRY = "<QI", "<I", "<q", "<QQ"
#: Stands for a null document id.
_NO_ID = -(2**63)

MANIFEST = (
    "part int, name string, n_docs long, n_tokens long, bytes long, "
    "first_doc long, last_doc long, dtype string"
)


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack(_TAIL, masked_crc(length)), payload, struct.pack(_TAIL, masked_crc(payload)))
    )


def _open(folder: str):
    """The file system of a folder that all machines share, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(),
        folder,
    )


def unframe(stream) -> Iterator[bytes]:
    """Payloads of a stream of records; damaged or cut records raise."""
    while head := stream.read(struct.calcsize(_HEAD)):
        if len(head) < struct.calcsize(_HEAD):
            raise ValueError("record cut off in its length")
        length, crc = struct.unpack(_HEAD, head)
        if masked_crc(head[:8]) != crc:
            raise ValueError("damaged length of a record")
        payload = stream.read(length)
        tail = stream.read(struct.calcsize(_TAIL))
        if len(payload) < length or len(tail) < struct.calcsize(_TAIL):
            raise ValueError("record cut off")
        if masked_crc(payload) != struct.unpack(_TAIL, tail)[0]:
            raise ValueError("damaged record")
        yield payload


@dataclass(frozen=True)
class RecordRules:
    """``end_id`` is put after each document; ``dtype`` must hold every id."""

    tokenizer: str
    end_id: int | None = 2
    dtype: str = "<u2"


def write_records(docs: DataFrame, folder: str, rules: RecordRules) -> DataFrame:
    """Encode ``doc_id, text`` and write them in ascending ``doc_id`` order; the manifest.

    Null texts are empty, null ids come first.  Rows that repeat an id are all
    written, in the order of their texts.  An empty table gives an empty manifest.
    Rows are dealt out by ranges of the id (and of the text's hash, should one id hold
    very many rows), so files follow each other in the order of their numbers and
    each task holds one slice of texts in memory.
    """
    end = b"" if rules.end_id is None else np.array([rules.end_id], rules.dtype).tobytes()

    @tidy
    def write(batches):
        from pyspark import TaskContext

        files, path = _open(folder)
        task = TaskContext.get()
        part = task.partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        encode = encoder(rules.tokenizer, rules.dtype).encode
        size, docs_seen, tokens, first, last = 0, 0, 0, None, None
        records = index = None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, some in portions(texts):
                if records is None:
                    files.create_dir(path, recursive=True)
                    records = files.open_output_stream(f"{path}/{name}.rec")
                    index = files.open_output_stream(f"{path}/{name}.idx")
                for doc, encoded in zip(ids[at : at + len(some)], encode(some)):
                    payload = struct.pack(_ID, _NO_ID if doc is None else doc) + encoded + end
                    framed = frame(payload)
                    records.write(framed)
                    index.write(struct.pack(_ENTRY, size, len(payload)))
                    size += len(framed)
                    docs_seen += 1
                    tokens += (len(payload) - 8) // np.dtype(rules.dtype).itemsize
                    first = doc if first is None else first
                    last = doc
        if records is not None:
            records.close()
            index.close()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "name": name,
                        "n_docs": docs_seen,
                        "n_tokens": tokens,
                        "bytes": size,
                        "first_doc": first,
                        "last_doc": last,
                        "dtype": rules.dtype,
                    }
                ],
                pa.schema(
                    [
                        ("part", pa.int32()),
                        ("name", pa.string()),
                        *((x, pa.int64()) for x in ("n_docs", "n_tokens", "bytes", "first_doc", "last_doc")),
                        ("dtype", pa.string()),
                    ]
                ),
            )

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_records(spark: SparkSession, folder: str, order: str | None = None) -> DataFrame:
    """Read a data set back: ``doc_id, start, n_tokens, ids`` (32 bit, little-endian).

    ``start`` counts the ids of all records before.  Every checksum is verified.
    ``order`` is the seed of a shuffled read: each file's records then come in
    that order of its index, by seeking.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(
        "part", "name", "dtype", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base")
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def payloads(files, path, name, width):
        """Payloads with the number of ids before each, within the file."""
        if order is None:
            before = 0
            with files.open_input_stream(f"{path}/{name}.rec", buffer_size=1 << 20) as stream:
                for payload in unframe(stream):
                    yield before, payload
                    before += (len(payload) - 8) // width
            return
        with files.open_input_stream(f"{path}/{name}.idx") as stream:
            entries = np.frombuffer(stream.read(), "<u8").reshape(-1, 2).astype(np.int64)
        counts = (entries[:, 1] - 8) // width
        starts = np.cumsum(counts) - counts
        seed = zlib.crc32(f"{order}/{name}".encode())
        with files.open_input_file(f"{path}/{name}.rec") as stream:
            for at in np.random.default_rng(seed).permutation(len(entries)):
                stream.seek(int(entries[at, 0]))
                yield int(starts[at]), next(unframe(stream))

    @tidy
    def read(batches):
        files, path = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                kind = np.dtype(row["dtype"])
                rows, held = [], 0
                for before, payload in payloads(files, path, row["name"], kind.itemsize):
                    ids = np.frombuffer(payload, kind, offset=8).astype("<u4")
                    doc = struct.unpack_from(_ID, payload)[0]
                    rows.append(
                        (None if doc == _NO_ID else doc, row["base"] + before, len(ids), ids.tobytes())
                    )
                    held += len(payload)
                    if held > 4 << 20:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, "part").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(x), t) for x, t in zip(zip(*rows), schema.types)], schema=schema
    )
