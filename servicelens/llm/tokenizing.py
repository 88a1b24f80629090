"""Exact and quick encoding with the vocabularies of tokenizers files, in a worker.

Merges run in tiktoken, on ranks made from the tokenizers file.  It merges
any neighbours whose concatenation is a token, the tokenizers library only
listed pairs; with one merge for each token, in the order of the ranks, both
come to the same ids: before a token's rank is due, its bytes stand as its own
pair, because all earlier merges are done.  ``merge_order`` checks that
condition.  Texts outside the characters below, with added tokens or with very
long runs go to the tokenizers library whole.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from itertools import chain, filterfalse

import numpy as np
from pyspark import cloudpickle

from servicelens.llm.worker import remembered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMO_CHUNKS = 300_000  # chunks a worker remembers; emptied when full
LONG_RUN = 400  # characters without white space, or of white space, that the library encodes
SEEN_MASK = (1 << 24) - 1  # places of the table of chunks that came before
TURN_CHARS = 1_000_000  # texts of so many characters are split into chunks at a time

# Characters whose classes are the same in all libraries, and which no Unicode
# composition touches and whose lower case is among them.
USUAL = "\x00\x03-\x1b\x20-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u02ff\u2010-\u2027\u2030-\u205e\u20ac"
UNUSUAL = re.compile(f"[^{USUAL}]")
UNUSUAL_ASCII = [chr(c) for c in range(128) if UNUSUAL.match(chr(c))]


def usual(text: str) -> bool:
    """Whether all characters are ``USUAL``; searching a few characters in ASCII
    texts is quicker than looking at each."""
    if text.isascii():
        return not any(c in text for c in UNUSUAL_ASCII)
    return not UNUSUAL.search(text)


def byte_table(path: str) -> list[bytes]:
    """id -> bytes of a byte-level vocabulary, added tokens included."""

    def make() -> list[bytes]:
        from tokenizers import Tokenizer

        # the printable bytes stand for themselves, the others follow from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            table[i] = bytes(of[c] for c in token)
        return table

    return remembered(("byte table", path), make)


def merge_order(path: str) -> list[int]:
    """The ids that the merges of a file make, in their order; ValueError if a
    token is made twice."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = [model["vocab"]["".join(pair)] for pair in pairs]
    if len(set(made)) < len(made):
        raise ValueError(f"{path}: a token has two merges")
    return made


class Encoder:
    """encode_all: the little-endian 32-bit ids of every text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def chunks(self, text: str) -> list[str] | None:
        """The text split at white space, or None if its characters or added tokens
        make the library encode it whole."""
        if not usual(text) or any(t in text for t in self.added):
            return None
        return text.split()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode(t) for t in texts]


class ByteEncoder(Encoder):
    """Byte-level pairs, ids in the order of their merges."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        super().__init__(path)
        table, made = byte_table(path), merge_order(path)
        if made != sorted(made):
            raise ValueError(f"{path}: ids are not in the order of the merges")
        added = set(self.library.get_added_tokens_decoder())
        ranks = {b: i for i, b in enumerate(table) if i not in added}
        self.merges = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        chunks = self.chunks(text)
        if chunks is None or max(map(len, chunks), default=0) >= LONG_RUN:
            return self.whole(text)
        # white space beyond one character for each chunk could be one long run
        if len(text) - sum(map(len, chunks)) - len(chunks) >= LONG_RUN:
            return self.whole(text)
        return np.array(self.merges.encode_ordinary(text), "<u4")


class WordEncoder(Encoder, dict):
    """Lower-cased words with ends; white space is dropped.  A text's ids are
    those of its white-space-separated chunks, which are remembered: chunk ->
    bytes of the ids.

    The end of a word is a byte of its own for tiktoken, whose merges with the
    last byte come before all others; a second byte keeps chunks apart."""

    WORD_END, CHUNK_END = "\x01", "\x02"

    def __init__(self, path: str):
        import tiktoken

        super().__init__(path)
        usual = [chr(c) for c in range(0x20AD) if not UNUSUAL.match(chr(c))]
        of_kind = lambda kind: "".join(c for c in usual if unicodedata.category(c)[0] == kind)
        letters, digits = of_kind("L"), of_kind("N")
        rest = "".join(c for c in usual if not c.isspace() and c not in set(letters + digits))
        kinds = [f"[{letters}]+", f"[{digits}]", f"[{re.escape(rest)}]+"]
        self.word = re.compile("|".join(["'s|'t|'re|'ve|'m|'ll|'d", *kinds]))
        mark = self.WORD_END.encode()
        table = [b.removesuffix(b"</w>") + mark * b.endswith(b"</w>") for b in byte_table(path)]
        ranks, ids = {bytes([b]): b for b in range(256)}, [0] * 256
        added, made = set(self.library.get_added_tokens_decoder()), merge_order(path)
        merged = set(made) | added
        first = [i for i in range(len(table)) if i not in merged]
        for i in [*first, *made]:  # single bytes, those that end a word, then the merges
            if len(table[i]) == 1:
                ids[ranks[table[i]]] = i
            else:
                ranks[table[i]] = len(ids)
                ids.append(i)
        self.ids = np.array(ids, "<u4")
        self.seen = bytearray(SEEN_MASK + 1)
        pattern = f"[^{self.WORD_END}{self.CHUNK_END}]*{self.WORD_END}|{self.CHUNK_END}"
        self.merges = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.border = ranks[self.CHUNK_END.encode()]

    def learn(self, chunks: list[str]) -> None:
        glued = self.word.sub(r"\g<0>" + self.WORD_END, self.CHUNK_END.join(chunks).lower())
        ranks = np.array(self.merges.encode_ordinary(glued), np.int64)
        ends = np.flatnonzero(ranks == self.border)
        flat = self.ids[ranks].tobytes()
        starts = [0, *((ends + 1) * 4).tolist()]
        stops = [*(ends * 4).tolist(), len(flat)]
        self.update(zip(chunks, [flat[a:b] for a, b in zip(starts, stops)]))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        out, waiting, chars = [], [], 0
        for k, text in enumerate(texts):
            waiting.append((text, self.chunks(text)))
            chars += len(text)
            if chars < TURN_CHARS and k + 1 < len(texts):
                continue
            new = set(filterfalse(self.__contains__, chain.from_iterable(chunks for _, chunks in waiting if chunks)))
            # remembered chunks are never long, so only new ones are looked at
            long = {chunk for chunk in new if len(chunk) >= LONG_RUN}
            new -= long
            if new:
                self.learn(list(new))
            for text, chunks in waiting:
                whole = chunks is None or (long and not long.isdisjoint(chunks))
                ids = self.whole(text) if whole else np.frombuffer(b"".join(map(self.__getitem__, chunks)), "<u4")
                out.append(ids)
            self.forget(new)
            waiting, chars = [], 0
        return out

    def forget(self, new: set[str]) -> None:
        """Keep a new chunk only when it comes for the second time: most of the
        distinct chunks of a corpus come once."""
        seen = self.seen
        for chunk in new:
            at = hash(chunk) & SEEN_MASK
            if seen[at]:
                continue
            seen[at] = 1
            del self[chunk]
        if len(self) > MEMO_CHUNKS:
            self.clear()

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def byte_encoder(path: str) -> ByteEncoder:
    return remembered(("byte encoder", path), lambda: ByteEncoder(path))


def word_encoder(path: str) -> WordEncoder:
    return remembered(("word encoder", path), lambda: WordEncoder(path))
