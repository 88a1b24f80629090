"""Token counts by a linear longest-match automaton.

Words are cut greedily into the longest pieces of a vocabulary.  The automaton
is the vocabulary's trie with failure links: where a node has no edge for the
next byte, its link names the node that stands for what is left after the
longest pieces were taken off the front, and a precomputed number says how
many pieces that were.  A word is read once, byte by byte, and only numbers
are added up; no piece is ever built.

The vocabulary holds the surface forms (without word-end marks) of a
byte-level vocabulary file, so that every byte is a piece.  Words are runs of
letters and digits, or single other characters, of the lower-cased text.
Counts of distinct words are remembered in a bounded memo.

Defined results: null, empty and blank texts have no words and no tokens;
repeated rows give repeated rows; null ids are kept; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from servicelens.llm.text import keyed
from servicelens.llm.tokenizing import byte_table
from servicelens.llm.worker import remembered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMO_WORDS = 400_000
LONG_WORD = 200  # longer words are counted, but not remembered
WORDS = re.compile(r"[^\W_]+|[^\w\s]|_")


class Automaton:
    """Nodes are numbers; node 0 is the root.  ``edges[v]`` maps a byte to the
    next node, ``link[v]`` and ``popped[v]`` are the failure link and the pieces
    taken when it is followed (link None: no piece begins this way)."""

    def __init__(self, vocabulary):
        self.edges: list[dict[int, int]] = [{}]
        ends = {0: False}
        for piece in vocabulary:
            v = 0
            for byte in piece:
                if byte not in self.edges[v]:
                    self.edges[v][byte] = len(self.edges)
                    ends[len(self.edges)] = False
                    self.edges.append({})
                v = self.edges[v][byte]
            ends[v] = True
        self.link: list[int | None] = [None] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0])
        while queue:  # breadth first: links lead to shorter strings
            v = queue.popleft()
            for byte, child in self.edges[v].items():
                queue.append(child)
                if ends[child]:  # the whole string is the longest piece
                    self.link[child], self.popped[child] = 0, 1
                    continue
                at, pieces = self.link[v], self.popped[v]
                while at is not None and byte not in self.edges[at]:
                    at, pieces = self.link[at], pieces + self.popped[at]
                if at is not None:
                    self.link[child], self.popped[child] = self.edges[at][byte], pieces

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; ValueError if there is none."""
        edges, link, popped = self.edges, self.link, self.popped
        v = pieces = 0
        for byte in word:
            while byte not in edges[v]:
                pieces += popped[v]
                v = link[v]
                if v is None or (v == 0 and byte not in edges[0]):
                    raise ValueError("no piece fits")
            v = edges[v][byte]
        while v:  # what is left at the end
            pieces += popped[v]
            v = link[v]
            if v is None:
                raise ValueError("no piece fits")
        return pieces


class WordCounts(dict):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        library = Tokenizer.from_file(path)
        added = {t.content for t in library.get_added_tokens_decoder().values()}
        table = byte_table(path)
        pieces = {
            table[i].removesuffix(b"</w>") for token, i in library.get_vocab(with_added_tokens=True).items() if token not in added
        }
        self.automaton = Automaton(sorted(pieces - {b""}))

    def __missing__(self, word: str) -> int:
        pieces = self.automaton.count(word.encode("utf-8"))
        if len(word) <= LONG_WORD:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = pieces
        return pieces


def counter(path: str):
    """Batches of (__id, __text) -> __id, n_words, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = remembered(("word counts", path), lambda: WordCounts(path))
        for batch in batches:
            words, tokens = [], []
            for text in batch.column("__text"):
                found = WORDS.findall(text.as_py().lower())
                words.append(len(found))
                tokens.append(sum(map(counts.__getitem__, found)))
            numbers = [pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), *numbers], ["__id", "n_words", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_tokens."""
    rows = keyed(docs, id_col, text_col).select("__id", "__text")
    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(counter(path), f"__id {kind}, n_words long, n_tokens long").withColumnRenamed("__id", id_col)


def op8_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
