"""Periodic runs against brute force over all periods."""

import random

import pytest

from servicelens.llm import periodic


def brute_runs(words):
    """(start, length, period) of every run, by trying every period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(rng.choice([5, 60, 300])))]
    for _ in range(rng.randrange(4)):
        base = [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randrange(1, rng.choice([3, 9, 40, 120])))]
        if len(base) > 8 and rng.random() < 0.5:  # runs inside the period of a run
            inner = [rng.randrange(5) for _ in range(rng.randrange(1, 4))] * 8
            base[1 : 1 + len(inner)] = inner
        at = rng.randrange(len(words) + 1)
        words[at:at] = (base * 8)[: rng.randrange(2 * len(base), 7 * len(base) + 1)]
    return [str(w).encode() for w in words]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [repetitive(rng) for _ in range(rng.randrange(1, 9))]
        for text, got in zip(texts, periodic.runs_of_texts(texts)):
            assert [tuple(r) for r in got.tolist()] == brute_runs(text)


def test_long_periods_at_every_scale():
    rng = random.Random(3)
    for q in (7, 8, 15, 16, 17, 63, 64, 100, 1000, 1023, 1024):
        base = [b"%d" % rng.randrange(10**6) for _ in range(q)]
        text = [b"a", b"b"] + (base * 5)[: 4 * q + 1] + [b"c"]
        assert [tuple(r) for r in periodic.runs_of_texts([text])[0].tolist()] == brute_runs(text)


def test_selected_positions_are_sparse():
    import numpy as np

    rng = np.random.default_rng(0)
    windows = rng.integers(0, 2**63, 100_000).astype(np.uint64)
    for scale in (8, 64, 512):
        at = periodic.synchronising_positions(windows, np.zeros(len(windows), bool), scale)
        assert len(at) <= 2.5 * len(windows) / scale
        assert np.diff(at).max() <= scale


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (None, "x " * 7), (5, "a a a a a a"), (6, "b\x0ba\x0ca\ra a a a c")]
    docs = spark.createDataFrame([(i, t, "n", 1, "k") for i, t in rows], "doc_id long, text string, n_runs string, __id int, __text string")
    got = {(r.doc_id, r.n_words): r for r in periodic.periodic_runs(docs).collect()}
    assert [len(got[k].runs) for k in ((1, 0), (2, 0), (3, 0), (4, 5), (5, 6), (None, 7), (6, 8))] == [0, 0, 0, 0, 1, 1, 1]
    assert got[(6, 8)].collapsed == "b a c" and got[(5, 6)].collapsed == "a" and got[(1, 0)].collapsed == ""
    assert got[(6, 8)].runs[0].asDict() == {"start": 1, "length": 6, "period": 1}
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_text_longer_than_a_chunk(spark, monkeypatch):
    words = [f"w{k}" for k in range(900)] * 5
    docs = spark.createDataFrame([("id", " ".join(["start", *words, "end"])), ("other", "a b c")], "doc_id string, text string")
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 1000)
    got = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert [r.asDict() for r in got["id"].runs] == [{"start": 1, "length": 4500, "period": 900}]
    assert got["id"].collapsed.split() == ["start", *words[:900], "end"] and got["other"].collapsed == "a b c"


def test_planting_follows_the_id(spark):
    import zlib

    rows = [(i, " ".join(f"w{k}" for k in range(n))) for i, n in zip(range(400), [0, 1, 2, 7, 50, 333] * 70)]
    out = {r.doc_id: r.text for r in periodic.with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    for i, text in rows:
        words, h = text.split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        assert out[i].split() == words
