"""Token ids as length-delimited binary records with an offset index.

File format (all integers little-endian), one record per document, in
ascending id order through the files ``part-00000...``:

    8  length of the payload
    4  masked CRC-32 of these 8 bytes
    n  payload
    4  masked CRC-32 of the payload
    1  line feed (0x0A)

    payload: 1 byte   width of an id: 2 or 4 bytes
             1 byte   1 if the document has an id, else 0
             8 bytes  document id (signed; 0 if it has none)
             rest     the token ids

The mask is a rotation by 15 bits and the constant below, so that a checksum
of data that hold checksums stays useful.  Spark's text writer puts the
records down (a record is one row, the line feed its line end), so the files
appear by Spark's commit protocol on whatever file system the path names.

The index is a Parquet table: file, doc_id, offset, length, n_tokens,
start, the number of ids in all records before it, and ids_crc32, the CRC-32 of the ids
as 32-bit integers.  It comes from one pass over the written files, in which every
record's checksums are verified.  ``read_records`` takes any
rows of the index, in any order, and gives back ids checked by both checksums.

Defined results: null and empty texts hold the end id only; documents with a
null id come first; equal ids follow each other by their texts' hashes; repeated rows
are repeated records; an empty table gives an empty index; other columns are
ignored.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicelens.llm.text import keyed
from servicelens.llm.tokenizing import word_encoder
from servicelens.plans.physical import materialize
from servicelens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_BYTES = 8_000_000  # text bytes that go to one file
END_ID = 1
SLICE = 500  # rows that a worker turns around at once

_HEAD, _HEAD_BYTES = "<QI", 12
_CRC, _CRC_BYTES = "<I", 4
_PAYLOAD, _PAYLOAD_BYTES = "<BBq", 10


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    """The record without its final line feed."""
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(_CRC, masked_crc(length)) + payload + struct.pack(_CRC, masked_crc(payload))


def frames(content: bytes) -> Iterator[tuple[int, int]]:
    """(offset, payload length) of every record of a file."""
    at = 0
    while at < len(content):
        length, crc = struct.unpack_from(_HEAD, content, at)
        if crc != masked_crc(content[at : at + 8]):
            raise ValueError(f"damaged length at byte {at}")
        yield at, length
        at += _HEAD_BYTES + length + _CRC_BYTES + 1


def payload_at(content: bytes, offset: int, length: int) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids) of the record; ValueError if it is damaged."""
    begin = offset + _HEAD_BYTES
    payload = content[begin : begin + length]
    if len(payload) < length or struct.unpack_from(_CRC, content, begin + length)[0] != masked_crc(payload):
        raise ValueError(f"damaged record at byte {offset}")
    width, has_id, doc_id = struct.unpack_from(_PAYLOAD, payload)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", offset=_PAYLOAD_BYTES)


def record_maker(path: str, end_id: int):
    """Batches of (__id, __text) -> framed records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = word_encoder(path)
        width = 2 if library.library.get_vocab_size() <= 1 << 16 else 4
        end = np.array([end_id], "<u4")
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):  # a bounded batch at a time
                part = batch.slice(first, SLICE)
                records = []
                encoded = library.encode_all(part.column("__text").to_pylist())
                for doc_id, ids in zip(part.column("__id").to_pylist(), encoded):
                    ids = np.concatenate([ids, end]).astype(f"<u{width}")
                    records.append(framed(struct.pack(_PAYLOAD, width, doc_id is not None, doc_id or 0) + ids.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    return run


def index_maker():
    """Batches of (path, content) -> one row per record: its place and the
    number and checksum of its ids, all read from the file itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                content = memoryview(content.as_buffer())
                rows = []
                for offset, length in frames(content):
                    doc_id, ids = payload_at(content, offset, length)
                    rows.append((doc_id, offset, length, len(ids), zlib.crc32(ids.astype("<u4"))))
                doc_ids, offsets, lengths, counts, sums = zip(*rows) if rows else ((),) * 5
                before = np.cumsum([0, *counts])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.rsplit("/", 1)[-1]] * len(rows), pa.string()),
                        *[pa.array(x, pa.int64()) for x in (doc_ids, offsets, lengths, counts, before, sums)],
                    ],
                    ["file", "doc_id", "offset", "length", "n_tokens", "start_in_file", "ids_crc32"],
                )

    return run


def _id_batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (numbers..., ids) as a batch."""
    *numbers, ids = zip(*rows)
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
    return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in numbers], lists], names)


def record_reader():
    """Batches of (content, records) -> doc_id, start, n_tokens, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, records in zip(batch.column("content"), batch.column("records").to_pylist()):
                content = memoryview(content.as_buffer())
                for first in range(0, len(records), SLICE):  # a bounded batch at a time
                    rows = []
                    for r in records[first : first + SLICE]:
                        doc_id, ids = payload_at(content, r["offset"], r["length"])
                        rows.append((doc_id, r["start"], len(ids), ids))
                    yield _id_batch(["doc_id", "start", "n_tokens", "ids"], rows)

    return run


def record_scanner():
    """Batches of (path, content) -> file, offset, doc_id, ids of every record in file order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                content = memoryview(content.as_buffer())
                places = list(frames(content))
                for first in range(0, len(places), SLICE):
                    rows = [(offset, *payload_at(content, offset, length)) for offset, length in places[first : first + SLICE]]
                    out = _id_batch(["offset", "doc_id", "ids"], rows)
                    file = pa.array([path.rsplit("/", 1)[-1]] * len(rows), pa.string())
                    yield pa.RecordBatch.from_arrays([file, *out.columns], ["file", "offset", "doc_id", "ids"])

    return run


def write_records(
    docs: DataFrame, out: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES
) -> None:
    """Write ``out``/data (the record files) and ``out``/index.

    Rows are dealt by ranges of (id, text hash), so a hot id is split; the
    texts are shuffled rather than their ids, which are larger."""
    rows = keyed(docs, id_col, text_col).withColumn("__id", F.col("__id").cast("bigint"))
    total = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    order = ["__id", "__text_hash"]
    rows = rows.repartitionByRange(int(total // file_bytes) + 1, *order).sortWithinPartitions(*order)
    records = rows.select("__id", "__text").mapInArrow(record_maker(path, end_id), "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{out}/data")
    spark = docs.sparkSession
    found = _files(spark, out).select("path", "content").mapInArrow(
        index_maker(), "file string, doc_id long, offset long, length long, n_tokens long, start_in_file long, ids_crc32 long"
    )
    found = materialize(found, "record-index")
    index = found.join(file_bases(found), "file").withColumn("start", F.col("base") + F.col("start_in_file"))
    index.select("file", "doc_id", "offset", "length", "n_tokens", "start", "ids_crc32").write.parquet(f"{out}/index")


def file_bases(found: DataFrame) -> DataFrame:
    """file, base: the tokens in the files before it.  Part numbers ascend with
    the ids; they are padded to five digits, so the names do so only up to 100,000 files."""
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("int")
    # one row per file
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("total")).withColumn("number", number)
    before = F.coalesce(F.sum("total").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return totals.select("file", before.alias("base"))


def _files(spark, out: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{out}/data")


def read_index(spark, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/index")


def read_records(index: DataFrame, out: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of the given index rows (a shuffled read)."""
    wanted = index.groupBy("file").agg(F.collect_list(F.struct("offset", "length", "start")).alias("records"))
    files = _files(index.sparkSession, out).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")
    both = files.join(wanted, "file").select("content", "records")
    return both.mapInArrow(record_reader(), "doc_id long, start long, n_tokens long, ids array<int>")


def scan_records(spark, out: str) -> DataFrame:
    """file, offset, doc_id, ids of all records, each file read in its order."""
    files = _files(spark, out).select("path", "content")
    return files.mapInArrow(record_scanner(), "file string, offset long, doc_id long, ids array<int>")


def op5_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = scratch_path(spark, "records")
    write_records(spark.read.parquet(f"{sf_dir}/documents.parquet"), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_index(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")
