"""BPE, token records and token counts against the library and brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from servicelens.llm import bpe, records, token_count
from servicelens.llm.tokenizing import byte_encoder, byte_table, word_encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
DOCS = "doc_id long, text string, ids string, parts int"
PIECES = ["a", "the", "ing", "'s", "'", "re", "ll", " ", "  ", "\n", "\t", "é", "日本", "😀", "12", "!!", "...", "-", "<|endoftext|>", "<|endof", "text|>", "\x85", "\x1c", "_", "Σ", "İ", "Ⱦ", "\x01", "\x02", " ", "E", "É"]
texts = st.lists(st.sampled_from(PIECES), max_size=60).map("".join) | st.text(max_size=60)


def library(path):
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


BYTES, WORDS = library(BYTE), library(WORD)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_encoders_equal_the_library(text):
    assert byte_encoder(BYTE).encode(text).tolist() == BYTES.encode(text, add_special_tokens=False).ids
    assert word_encoder(WORD).encode(text).tolist() == WORDS.encode(text, add_special_tokens=False).ids


def test_every_character_equals_the_library():
    for c in (c for c in range(0x3100) if not 0xD800 <= c < 0xE000):
        text = f"ab{chr(c)}Cd {chr(c)}{chr(c)}e 1{chr(c)}"
        assert word_encoder(WORD).encode(text).tolist() == WORDS.encode(text, add_special_tokens=False).ids, hex(c)
        assert byte_encoder(BYTE).encode(text).tolist() == BYTES.encode(text, add_special_tokens=False).ids, hex(c)


def test_memo_that_overflows(monkeypatch):
    from servicelens.llm import tokenizing

    monkeypatch.setattr(tokenizing, "MEMO_CHUNKS", 3)
    monkeypatch.setattr(tokenizing, "TURN_CHARS", 20)
    rows = ["one two three four five", "two three two", "", "six one one seven two"] * 3
    assert [x.tolist() for x in tokenizing.WordEncoder(WORD).encode_all(rows)] == [WORDS.encode(t, add_special_tokens=False).ids for t in rows]


@settings(max_examples=300, deadline=None)
@given(texts, st.lists(st.floats(0, 1), min_size=1, max_size=6))
def test_concatenation_equals_the_whole(text, cuts):
    places = sorted({0, len(text), *(int(c * len(text)) for c in cuts)})
    parts = [text[a:b] for a, b in zip(places, places[1:])] or [""]
    lengths = np.array([len(b) for b in byte_table(BYTE)], np.int64)
    encode = byte_encoder(BYTE).encode
    got = bpe.concatenated([(p.encode(), encode(p)) for p in parts], encode, lengths)
    assert got.tolist() == BYTES.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("alphabet", ["ab", "a", "the", " \n", "1", "!'s"])
def test_long_unsplit_runs(alphabet):
    rng = random.Random(3)
    text = "".join(rng.choices(alphabet, k=3000))
    lengths = np.array([len(b) for b in byte_table(BYTE)], np.int64)
    encode = byte_encoder(BYTE).encode
    parts = [text[i : i + 500] for i in range(0, 3000, 500)]
    got = bpe.concatenated([(p.encode(), encode(p)) for p in parts], encode, lengths)
    assert got.tolist() == BYTES.encode(text, add_special_tokens=False).ids


EDGE = [(1, None), (2, ""), (3, " \n"), (None, "null id"), (4, "same"), (4, "same"), (4, "other"), (5, "<|endoftext|> x"), (6, "lang é 日本 " * 400), (6, "lang é 日本 " * 400)]


def test_encode_and_decode_rows(spark):
    out = bpe.decode(bpe.encode(frame(spark, EDGE), BYTE, segment_chars=300), BYTE).collect()
    key = lambda r: str(r)
    want = [(i, BYTES.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in EDGE]
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in out), key=key) == sorted(want, key=key)
    assert bpe.encode(frame(spark, []), BYTE).count() == 0


def test_digests(spark):
    rows = [(7, "A text. " * 30), (8, None)]
    out = {r.doc_id: r for r in bpe.digests(frame(spark, rows), BYTE).collect()}
    ids = BYTES.encode(rows[0][1], add_special_tokens=False).ids
    assert out[7].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert out[8].n_tokens == 0 and out[8].ids_sha256 == out[8].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_records_round_trip(spark, tmp_path):
    rows = [*EDGE, *((100 + i, f"document {i} " * (i % 7)) for i in range(60))]
    out = str(tmp_path / "r")
    records.write_records(frame(spark, rows), out, WORD, file_bytes=2_000)
    assert len(list((tmp_path / "r" / "data").glob("part-*"))) > 1
    index = records.read_index(spark, out)
    got = sorted(records.read_records(index, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 1
        at += r.n_tokens
    want = sorted(tuple(WORDS.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in rows)
    assert sorted(tuple(r.ids) for r in got) == want == sorted(tuple(r.ids) for r in records.scan_records(spark, out).collect())
    some = index.where("doc_id in (103, 150)").orderBy("doc_id", ascending=False)
    assert sorted(r.doc_id for r in records.read_records(some, out).collect()) == [103, 150]
    empty = str(tmp_path / "e")
    records.write_records(frame(spark, []), empty, WORD)
    assert records.read_index(spark, empty).count() == records.scan_records(spark, empty).count() == 0


def test_damaged_records_are_noticed():
    import struct

    payload = struct.pack("<BBq", 2, 1, 9) + np.array([5, 6], "<u2").tobytes()
    content = records.framed(payload) + b"\n" + records.framed(payload) + b"\n"
    (first, n), (second, _) = records.frames(content)
    assert first == 0 and records.payload_at(content, second, n)[0] == 9
    for place in (2, 9, 20, len(content) // 2 - 3):
        broken = bytearray(content)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            for offset, length in records.frames(bytes(broken)):
                records.payload_at(bytes(broken), offset, length)
    assert records.masked_crc(b"") != zlib.crc32(b"")


def greedy(word, pieces):
    """Pieces of the longest match, found by trying every length."""
    n = 0
    while word:
        size = next((k for k in range(min(len(word), 30), 0, -1) if word[:k] in pieces), None)
        if size is None:
            return None
        word, n = word[size:], n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.text("abc", max_size=14))
def test_automaton_equals_greedy_matching(extra, word):
    pieces = {x.encode() for x in extra} | {b"a", b"b", b"c"}
    assert token_count.Automaton(sorted(pieces)).count(word.encode()) == greedy(word.encode(), pieces)


@settings(max_examples=100, deadline=None)
@given(st.text("abcd", max_size=9))
def test_automaton_without_all_letters(word):
    pieces = {b"ab", b"abcd", b"c", b"bc", b"a"}
    want = greedy(word.encode(), pieces)
    machine = token_count.Automaton(sorted(pieces))
    if want is None:
        with pytest.raises(ValueError):
            machine.count(word.encode())
    else:
        assert machine.count(word.encode()) == want


def test_token_counts_rows(spark):
    table = byte_table(WORD)
    pieces = {b.removesuffix(b"</w>") for b in table[:49406]}
    out = token_count.count_tokens(frame(spark, EDGE), WORD).collect()
    want = []
    for i, t in EDGE:
        words = token_count.WORDS.findall((t or "").lower())
        want.append((i, len(words), sum(greedy(w.encode(), pieces) for w in words)))
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    assert token_count.count_tokens(frame(spark, []), WORD).count() == 0


def test_starts_follow_part_numbers(spark):
    numbers = [99_999, 100_000, 10_000, 10_001, 9]
    found = spark.createDataFrame([(f"part-{k:05d}-x.txt", n) for k in numbers for n in (k, 1)], "file string, n_tokens long")
    wanted, base = {}, 0
    for k in sorted(numbers):
        wanted[f"part-{k:05d}-x.txt"] = base
        base += k + 1
    assert {r.file: r.base for r in records.file_bases(found).collect()} == wanted
