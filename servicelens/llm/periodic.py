"""Periodic runs of words, found from string synchronising sets.

A run is a stretch of consecutive words with smallest period q and length
>= max(6, 4q) that no neighbouring word extends keeping period q.

1. Periods below ``SMALL`` words are found as highly periodic regions: words
   equal to the word q places before, for each of these q.
2. At each scale t = 8, 16, 32, ... a synchronising set is selected: position
   i is in it when the least hash of the t-word windows that start in
   [i, i + t] is the one at i or at i + t.  Windows inside a run of period
   <= t / 4 do not take part, so highly periodic regions stay sparse.  Whether
   i is selected depends on the words of [i, i + 2t) alone, and a run of
   period q in [t, 2t) and length 4q has a selected position in its first t
   words (no such window lies in a region of period <= t / 4, or the two periods
   would have a common divisor that is a period).
3. That position and the one q words on have equal contexts of 2t words, and
   no equal context stands between them.  So each pair of neighbouring
   selected positions with equal context hashes, at a distance in [t, 2t), proposes its
   distance as a period.  A scale proposes at most two pairs for each t words or so.
4. Proposals are extended word by word, exactly, to both sides; of runs with the same ends
   the smallest period stays, and the lengths are checked.  Hashes only
   propose: equal contexts have equal hashes, so no run is missed.

Texts are independent of each other, so there is no shuffle.  Inside a task many
texts are laid end to end with a unique separator word between them (``CHUNK_WORDS``
at a time, a longer text by itself) and each scale is a few array operations over
those of them that are long enough for it.  Memory is proportional to
one chunk or the longest text, time to words times scales.

Defined results: null, empty and blank texts have no words, no run, empty
collapsed texts; texts of fewer than 6 words have no run; texts are taken whole, however long;
repeated rows, ties and repeated or null ids do not matter, since each row is on its own;
an empty table gives an empty result; other columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.llm.text import blank_words, fenced

# Workers get this module's functions by value: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMALL = 8  # first scale; shorter periods are searched directly
LEAST_LENGTH, LEAST_EXPONENT = 6, 4
CHUNK_WORDS = 1 << 18

RUN_SCHEMA = "__id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of windows from those of their halves."""
    return _mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _long_enough(length, period):
    return (length >= LEAST_LENGTH) & (length >= LEAST_EXPONENT * period)


def small_period_runs(words: np.ndarray) -> list[np.ndarray]:
    """Rows (start, length, period) of the periods below ``SMALL``."""
    found = []
    for q in range(1, min(SMALL, len(words))):
        same = np.zeros(len(words) - q + 2, np.int8)
        same[1:-1] = words[q:] == words[:-q]
        edges = np.diff(same)
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        length = end - start + q
        keep = _long_enough(length, q)
        found.append(np.stack([start[keep], length[keep], np.full(keep.sum(), q)], axis=1))
    return found


def synchronising_positions(windows: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """Positions i whose least window hash over [i, i + scale] stands at an end;
    windows marked ``periodic`` do not take part."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    rank = np.where(periodic, top, windows)
    least = _window_minimum(rank, scale + 1)
    n = len(least)
    ends = (rank[:n] == least) | (rank[scale : scale + n] == least)
    return np.flatnonzero(ends & (least != top))


def _extent(words: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """Start and end of the stretch around ``at`` where words q apart are equal."""

    def equal_from(first: int, step: int) -> int:
        # number of equal pairs (i, i + q) from ``first`` on, in blocks that double
        done, block = 0, 64
        while True:
            a = first + done * step
            b = a + block * step
            if step > 0:
                b = min(b, len(words) - q)
                here = words[a:b] == words[a + q : b + q]
            else:
                b = max(b, -1)
                lo, hi = b + 1, a + 1
                here = (words[lo:hi] == words[lo + q : hi + q])[::-1]
            if not len(here):
                return done
            if not here.all():
                return done + int(np.argmin(here))
            done, block = done + len(here), block * 2

    return at - equal_from(at - 1, -1), at + equal_from(at, 1) + q


def scale_runs(words: np.ndarray, windows: np.ndarray, contexts: np.ndarray, known: np.ndarray, scale: int) -> list[tuple]:
    """Runs of the periods in [scale, 2 scale); ``windows`` and ``contexts`` are
    the hashes of ``scale`` and 2 ``scale`` words, ``known`` the runs of smaller periods."""
    marks = np.zeros(len(windows) + 1, np.int32)
    flat = known[(known[:, 2] <= scale // LEAST_EXPONENT) & (known[:, 1] >= scale)]
    np.add.at(marks, flat[:, 0], 1)
    np.add.at(marks, flat[:, 0] + flat[:, 1] - scale + 1, -1)
    at = synchronising_positions(windows, np.cumsum(marks[:-1]) > 0, scale)
    at = at[at < len(contexts)]
    order = np.argsort(contexts[at], kind="stable")
    here, there = at[order[:-1]], at[order[1:]]
    gap = there - here
    pairs = (contexts[here] == contexts[there]) & (gap >= scale) & (gap < 2 * scale)
    here, gap = here[pairs], gap[pairs]
    found, last = [], (0, 0, 0)
    for k in np.lexsort((here, gap)):
        q, i = int(gap[k]), int(here[k])
        if q == last[0] and last[1] <= i < last[2]:
            continue
        start, end = _extent(words, i, q)
        last = (q, start, end - q)
        if _long_enough(end - start, q):
            found.append((start, end - start, q))
    return found


def all_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs (start, length, period) of texts laid end to end, the longest first,
    each followed by a word of its own; ``lengths`` without these words."""
    found = np.concatenate([np.empty((0, 3), np.int64), *small_period_runs(words)])
    ends = np.cumsum(lengths + 1)
    hashes, scale = _mix(words.astype(np.uint64)), 1
    while True:
        # only texts that can hold a run of this scale's periods
        texts = int(np.searchsorted(-lengths, -LEAST_EXPONENT * max(scale, SMALL), side="right"))
        if not texts:
            break
        n = int(ends[texts - 1])
        hashes = hashes[: n - scale + 1]
        doubled = _joined(hashes[:-scale], hashes[scale:])
        if scale >= SMALL:
            new = scale_runs(words[:n], hashes, doubled, found[found[:, 0] + found[:, 1] <= n], scale)
            if new:
                found = np.concatenate([found, np.array(new, np.int64)])
        hashes, scale = doubled, scale * 2
    # of the periods of one stretch the smallest
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1])
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of every text (a list of words), with starts inside the text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    words = np.empty(int(lengths.sum()) + len(texts), np.int64)
    starts, at = np.empty(len(texts), np.int64), 0
    for place, k in enumerate(order):
        text = texts[k]
        words[at : at + len(text)] = [number(w, len(numbers)) for w in text]
        words[at + len(text)] = -1 - place
        starts[place] = at
        at += len(text) + 1
    found = all_runs(words, lengths[order])
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[owner]
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    out: list[np.ndarray] = [None] * len(texts)
    for place, k in enumerate(order):
        out[k] = found[cut[place] : cut[place + 1]]
    return out


def collapsed_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run repeats: those after a run's first period go."""
    if not len(runs):
        return words
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(marks[:-1]) == 0)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    ids, texts, total = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("__id"), batch.column("__text")):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            if texts and total + len(words) > CHUNK_WORDS:
                yield ids, texts
                ids, texts, total = [], [], 0
            ids.append(i)
            texts.append(words)
            total += len(words)
    if texts:
        yield ids, texts


def _finder(id_type: pa.DataType, run_digests: bool):
    """Batches of (__id, __text) -> runs and collapsed texts, or their digests."""
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def whole(ids, texts):
        runs = runs_of_texts(texts)
        kept = [b" ".join(collapsed_words(words, r)).decode("utf-8", "replace") for words, r in zip(texts, runs)]
        lists = [[{"start": s, "length": n, "period": q} for s, n, q in r.tolist()] for r in runs]
        columns = [pa.array([i.as_py() for i in ids], id_type), pa.array(list(map(len, texts)), pa.int64()), pa.array(lists, pa.list_(struct)), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["__id", "n_words", "runs", "collapsed"])

    def digests(ids, texts):
        rows = []
        for words, runs in zip(texts, runs_of_texts(texts)):
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
            best = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]), default=[None] * 3)
            kept = b" ".join(collapsed_words(words, runs))
            rows.append([len(words), len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()])
        columns = [pa.array([i.as_py() for i in ids], id_type)]
        for k, kind in enumerate([pa.int64()] * 5 + [pa.string()] * 2):
            columns.append(pa.array([r[k] for r in rows], kind))
        yield pa.RecordBatch.from_arrays(columns, ["__id", *DIGEST_COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            yield from (digests if run_digests else whole)(ids, texts)

    return run


DIGEST_COLUMNS = ["n_words", "n_runs", "start", "length", "period", "runs_sha256", "collapsed_sha256"]
DIGEST_SCHEMA = "__id {id}, n_words long, n_runs long, start long, length long, period long, runs_sha256 string, collapsed_sha256 string"


def _found(docs: DataFrame, id_col: str, text: Column, schema: str, run_digests: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), text.cast("string").alias("__text"))
    kind = rows.schema["__id"].dataType
    return rows.mapInArrow(_finder(to_arrow_type(kind), run_digests), schema.format(id=kind.simpleString()))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_words, runs (start, length, period; by start, then
    period) and the collapsed text, where of every run only the first period stays."""
    found = _found(docs, id_col, F.col(f"`{text_col}`"), RUN_SCHEMA, False)
    return found.withColumnRenamed("__id", id_col)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same without texts and lists: n_words, n_runs, the longest run and
    digests of all runs and of the collapsed text."""
    found = _found(docs, id_col, F.col(f"`{text_col}`"), DIGEST_SCHEMA, True)
    return found.withColumnRenamed("__id", id_col)


def with_planted_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text): where crc32 of the decimal id ends in 0, the words from a on
    repeat the first p of them; a, p and the exponent follow from the id and the
    number of words.  Other texts, and those of null ids, stay."""
    h = F.crc32(F.col(f"`{id_col}`").cast("string"))
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias(text_col), h.alias("__h"))
    chosen = F.coalesce(F.col("__h") % 10 == 0, F.lit(False))
    rows = fenced(rows.withColumn("__words", F.when(chosen, blank_words(F.col(text_col)))))
    n, g = F.size("__words"), F.expr("__h div 10")
    a = (g % n).cast("int")
    span = n - a
    p = F.lit(1) + F.floor(span / (F.lit(3) + g % 8)).cast("int")
    rows = rows.withColumn("__at", F.when(n > 0, F.struct(a.alias("a"), p.alias("p"), span.alias("span"))))
    base = F.slice("__words", F.col("__at.a") + 1, F.col("__at.p"))
    times = F.ceil(F.col("__at.span") / F.col("__at.p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(base, times)), F.lit(1), F.col("__at.span"))
    planted = F.array_join(F.concat(F.slice("__words", F.lit(1), F.col("__at.a")), tail), " ")
    return rows.select(id_col, F.when(F.col("__at").isNotNull(), planted).otherwise(F.col(text_col)).alias(text_col))


def op11_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = run_digests(with_planted_runs(docs, "doc_id", "text"))
    exponent = F.expr("1000 * length div period")
    return found.select("doc_id", "n_runs", "start", "length", "period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
