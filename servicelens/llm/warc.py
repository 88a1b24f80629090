"""WARC archives with revisit resolution.

Headers (page id, payload digest, size) are shuffled by digest; of the records
with equal payloads the one with the largest page id is the original, the
others become revisits that refer to it.  Archives are written with fresh
headers: a revisit record has no payload of its own.

Records are built by column expressions and put down by Spark's text writer,
whose line end is the two line breaks that close every record, so the archives
appear by Spark's commit protocol on whatever file system the path names.
``read_archives`` parses them by their content lengths; ``resolved`` joins
revisits to the responses they refer to.

Defined results: a null payload is empty; empty payloads are payloads like
others; rows equal in page id and payload are the same record written twice
(if it is the original, both are responses); a null page id never is the
original unless all of its group are null; a null url has no target header,
line breaks in one are percent-encoded; an empty table gives empty archives;
other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.plans.physical import materialize
from servicelens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"

MIN_BYTES = 0  # smaller payloads are always written whole
FILE_RECORDS = 2_000
BROADCAST_REVISITS = 500_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: every 5 hexadecimal digits are 4 of base32."""
    digest = F.sha1(payload)
    out = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            out.append(F.substr(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*out)


def _uuid(text: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def record_id(page_id: Column, digest: Column) -> Column:
    """The same for the same page and payload, whenever and wherever it is made."""
    return _uuid(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("none")), digest))


def with_decisions(pages: DataFrame, min_bytes: int = MIN_BYTES, broadcast_revisits: int = BROADCAST_REVISITS) -> DataFrame:
    """page_id, url, payload, digest, payload_bytes, original (null, or the
    page id that a revisit refers to).  The payloads stay where they are while
    there are at most ``broadcast_revisits`` revisits (counted first); beyond
    that they are shuffled to their decisions."""
    headers = pages.select("page_id", "digest", "payload_bytes").where(F.col("payload_bytes") >= min_bytes)
    groups = headers.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("k"))
    groups = groups.where("k > 1 and original is not null").select("digest", "original")
    revisits = headers.select("page_id", "digest").distinct().join(groups, "digest")
    revisits = revisits.where(~F.col("page_id").eqNullSafe(F.col("original")))
    revisits = revisits.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "original")
    revisits = materialize(revisits, "revisits")
    if revisits.count() <= broadcast_revisits:
        revisits = F.broadcast(revisits)
    match = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest"))
    return pages.join(revisits, match, "left").drop("r_page", "r_digest")


def record(date: str) -> Column:
    """A record (binary) without its closing line breaks."""
    revisit = F.col("original").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(RECORD_END),
    )
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(date)),
        optional("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(""),
        F.when(revisit, line("WARC-Refers-To", record_id(F.col("original"), F.col("digest")))).otherwise(""),
        optional("X-Page-ID", F.col("page_id").cast("string")),
        optional("X-Refers-To-Page-ID", F.col("original").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(head.cast("binary"), http.cast("binary"), body)


def write_archives(
    pages: DataFrame,
    out: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_BYTES,
    date: str | None = None,
    file_records: int = FILE_RECORDS,
) -> None:
    """Write deduplicated archives under ``out``; ``date`` defaults to now."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    records = with_decisions(rows, min_bytes).select(record(date).cast("string").alias("value"))
    records.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", file_records).text(out)


RECORD_SCHEMA = (
    "record_id string, record_type string, page_id long, refers_to long, refers_to_record string, target string,"
    " header_digest string, payload binary"
)


def archive_parser():
    """Batches of (content) -> one row per record."""

    def headers(lines: list[str]) -> dict[str, str]:
        return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = RECORD_END.encode()
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for content in batch.column("content"):
                content, at = content.as_py(), 0
                while at < len(content):
                    begin = content.index(end, at) + len(end)
                    first, *lines = content[at:begin].decode("utf-8").rstrip("\r\n").split("\r\n")
                    if not first.startswith("WARC/"):
                        raise ValueError(f"no record at byte {at}")
                    h = headers(lines)
                    stop = begin + int(h["content-length"])
                    if content[stop : stop + len(end)] != end:
                        raise ValueError(f"damaged record at byte {at}")
                    payload = content.index(end, begin, stop) + len(end)
                    row = (
                        h["warc-record-id"],
                        h["warc-type"],
                        number(h.get("x-page-id")),
                        number(h.get("x-refers-to-page-id")),
                        h.get("warc-refers-to"),
                        h.get("warc-target-uri"),
                        h["warc-payload-digest"].removeprefix("sha1:"),
                        content[payload:stop] if h["warc-type"] == "response" else None,
                    )
                    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3, pa.binary()]
                    names = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)
                    at = stop + len(end)

    return run


def read_archives(spark, path: str) -> DataFrame:
    """One row per record; revisits have no payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(archive_parser(), RECORD_SCHEMA)


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: the
    payload's size and digest come from the response that holds it."""
    records = records.withColumn("bytes", F.octet_length("payload").cast("bigint"))
    records = records.withColumn("digest", base32_sha1(F.col("payload"))).drop("payload")
    records = materialize(records, "records")  # the archives are parsed once
    responses = records.where("record_type = 'response'")
    held = responses.groupBy(F.col("record_id").alias("held")).agg(F.first("bytes").alias("held_bytes"), F.first("digest").alias("held_digest"))
    revisits = records.where("record_type = 'revisit'").join(held, F.col("refers_to_record") == F.col("held"), "left")
    same = ["page_id", "record_type", "refers_to"]
    return responses.select(*same, F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest")).unionByName(
        revisits.select(*same, F.col("held_bytes").alias("payload_bytes"), F.col("held_digest").alias("payload_digest"))
    )


def op2_query(spark, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), out)
    read = resolved(read_archives(spark, out))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
