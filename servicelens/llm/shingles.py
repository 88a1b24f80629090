"""Word-shingle sets and MinHash signatures, computed inside Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle

# Workers get this module's functions by value: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMO_WORDS = 300_000  # hashes of distinct words a worker remembers; emptied when full
CHUNK = 1 << 14  # shingles hashed at once, so that long texts need bounded memory

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str, width: int, memo: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles.  A-Z are
    lower-cased and words split at ASCII blanks, as the bytes methods do; a
    shorter text is one shingle, a text without words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mixed(out * _MULTIPLIER + h[i : len(h) - width + 1 + i])
    return np.unique(out)


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` hash functions, always the same."""
    k = np.arange(1, n + 1, dtype=np.uint64)
    return _mixed(k * _MULTIPLIER) | np.uint64(1), _mixed(~k * _MULTIPLIER)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 32-bit minimum per coordinate."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK, None] * a
        part += b
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bits(sig: np.ndarray, k: int) -> int:
    """Bit ``k`` of every coordinate, as one signed 64-bit integer."""
    return int(np.packbits((sig >> k) & 1, bitorder="little").view(np.int64)[0])


def set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


SKETCH_SCHEMA = "__id long, __text_hash long, n_shingles long, node binary, sig array<int>, bits0 long, bits1 long"
SET_SCHEMA = "node binary, shingles array<bigint>"


def sketcher(width: int, coordinates: int):
    """Batches of (__id, __text_hash, __text) -> (__id, __text_hash, n_shingles, node, sig, bits0, bits1); documents
    with equal sets share a node, an empty set has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        a, b = permutations(coordinates)
        for batch in batches:
            counts, nodes, sigs = [], [], []
            for text in batch.column("__text"):
                hashes = shingle_set(text.as_py() or "", width, memo)
                counts.append(len(hashes))
                nodes.append(set_digest(hashes) if len(hashes) else None)
                sigs.append(signature(hashes, a, b) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id"),
                    batch.column("__text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(sigs, pa.list_(pa.int32())),
                    *[pa.array([None if s is None else bits(s, k) for s in sigs], pa.int64()) for k in (0, 1)],
                ],
                ["__id", "__text_hash", "n_shingles", "node", "sig", "bits0", "bits1"],
            )

    return run


def set_maker(width: int):
    """Batches of (__text) -> (node, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for batch in batches:
            for text in batch.column("__text"):
                hashes = shingle_set(text.as_py() or "", width, memo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_digest(hashes)], pa.binary()), pa.array([hashes.view(np.int64)], pa.list_(pa.int64()))],
                    ["node", "shingles"],
                )

    return run
