"""BPE encoding and decoding by tree concatenation.

Texts up to ``segment_chars`` are encoded where they are.  Longer ones are cut
in halves, the halves again, down to segments of at most that length; the
segments are spread over the tasks and encoded on their own.  Then
neighbouring parts are concatenated pairwise up the tree.  At every join a
window is encoded again that reaches from a token border in the left part to
one in the right part.  If the window's first tokens are the left part's and
its last ones the right part's, the tokens between replace the old ones;
otherwise the window grows, in the end to both parts.  A sequence whose
neighbouring pairs all stand in correct encodings is itself correct, so equal
pairs at both borders make the result exact.

Defined results: null and empty texts have no tokens and decode to ""; equal
rows (same id and text) each get the same row; null ids are kept; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.llm.text import KEY, keyed
from servicelens.llm.tokenizing import byte_encoder, byte_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_CHARS = 32_768
FIRST_WINDOW = 64  # bytes on each side of a join
AGREEING_TOKENS = 3
AGREEING_BYTES = 16
SLICE = 500  # rows that a worker turns around at once


def joined(left: tuple[bytes, np.ndarray], right: tuple[bytes, np.ndarray], encode, lengths: np.ndarray):
    """(bytes, ids) of the concatenation of two encoded parts."""
    text = left[0] + right[0]
    at = len(left[0])
    ends = np.cumsum(lengths[left[1]])  # ends of the left tokens
    starts = at + np.cumsum(lengths[right[1]]) - lengths[right[1]]  # starts of the right tokens
    whole_char = lambda p: p == len(text) or text[p] & 0xC0 != 0x80
    size = FIRST_WINDOW
    while True:
        i = int(np.searchsorted(ends, at - size, "right")) if size < at else 0
        while i and not whole_char(ends[i - 1]):
            i -= 1
        j = int(np.searchsorted(starts, at + size, "left"))
        while j < len(starts) and not whole_char(starts[j]):
            j += 1
        begin, end = (int(ends[i - 1]) if i else 0), (int(starts[j]) if j < len(starts) else len(text))
        new = encode(text[begin:end].decode("utf-8"))
        if (i == 0 or _agree(new, left[1][i:], lengths)) and (j == len(starts) or _agree(new[::-1], right[1][:j][::-1], lengths)):
            return text, np.concatenate([left[1][:i], new, right[1][j:]])
        size *= 2


def _agree(new: np.ndarray, old: np.ndarray, lengths: np.ndarray) -> bool:
    """Both begin with the same tokens, enough of them."""
    n = min(len(new), len(old))
    differ = np.flatnonzero(new[:n] != old[:n])
    n = int(differ[0]) if len(differ) else n
    return n >= AGREEING_TOKENS and int(lengths[new[:n]].sum()) >= AGREEING_BYTES


def concatenated(parts: list[tuple[bytes, np.ndarray]], encode, lengths: np.ndarray) -> np.ndarray:
    """The ids of all parts in order, joined pairwise up the tree."""
    while len(parts) > 1:
        level = [joined(a, b, encode, lengths) for a, b in zip(parts[::2], parts[1::2])]
        parts = level + parts[len(level) * 2 :]
    return parts[0][1]


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)))


def encoder(path: str, text_col: str):
    """Batches -> the same columns, the text replaced by its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = byte_encoder(path)
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):  # a bounded batch at a time
                part = batch.slice(first, SLICE)
                ids = _id_lists(library.encode_all(part.column(text_col).to_pylist()))
                at = part.schema.get_field_index(text_col)
                yield pa.RecordBatch.from_arrays(
                    [ids if k == at else c for k, c in enumerate(part.columns)],
                    ["ids" if k == at else c for k, c in enumerate(part.schema.names)],
                )

    return run


def concatenator(path: str):
    """Batches of (__id, __text_hash, copies, parts) -> the rows with their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, table = byte_encoder(path), byte_table(path)
        lengths = np.array([len(b) for b in table], np.int64)
        encode = lambda text: library.encode(text).view(np.int32)
        for batch in batches:
            for k, parts in enumerate(batch.column("parts")):
                parts = [p["ids"].values.to_numpy() for p in parts]
                parts = [(b"".join(map(table.__getitem__, p.tolist())), p) for p in parts]
                ids = concatenated(parts, encode, lengths)
                row = [batch.column(c).slice(k, 1) for c in (*KEY, "copies")]
                yield pa.RecordBatch.from_arrays([*row, _id_lists([ids])], [*KEY, "copies", "ids"])

    return run


def decoder(path: str):
    """Batches with ids -> the same columns, the ids replaced by their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path)
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
            lists = (flat[a:b].tolist() for a, b in zip(ends, ends[1:]))
            texts = [b"".join(map(table.__getitem__, x)).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return run


def halves(docs: DataFrame, segment_chars: int) -> DataFrame:
    """One row per segment of the long texts: key, copies, part, __text.  The
    segments are the leaves of halving a text until none is too long."""
    n = F.length("__text")
    long = docs.where(n > segment_chars).groupBy(*KEY).agg(F.first("__text").alias("__text"), F.count("*").alias("copies"))
    leaves = F.pow(F.lit(2), F.ceil(F.log2(n / segment_chars))).cast("int")
    long = long.withColumn("leaves", leaves).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("leaves") - 1)))
    border = lambda k: F.floor(F.length("__text") * k / F.col("leaves")).cast("int")
    start, end = border(F.col("part")), border(F.col("part") + 1)
    return long.select(*KEY, "copies", "part", F.substr("__text", start + 1, end - start).alias("__text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """One row per input row: id and ids (array of int)."""
    rows = keyed(docs, id_col, text_col)
    kind = rows.schema["__id"].dataType.simpleString()
    short = rows.where(F.length("__text") <= segment_chars).select("__id", "__text")
    short = short.mapInArrow(encoder(path, "__text"), f"__id {kind}, ids array<int>")
    parts = halves(rows, segment_chars).repartition(*KEY, "part")
    parts = parts.mapInArrow(encoder(path, "__text"), f"__id {kind}, __text_hash long, copies long, part int, ids array<int>")
    parts = parts.groupBy(*KEY, "copies").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    long = parts.mapInArrow(concatenator(path), f"__id {kind}, __text_hash long, copies long, ids array<int>")
    long = long.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("__id", "ids")
    return short.unionByName(long).withColumnRenamed("__id", id_col)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with a column ``decoded``, the text of ``ids``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decoder(path), f"{fields}, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    both = decode(encode(docs, path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
