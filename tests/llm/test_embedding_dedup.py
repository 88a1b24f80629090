"""Near-duplicate embeddings against brute force."""

import numpy as np
import pytest

from servicelens.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, node string, cell int"


def frame(spark, ids, vectors):
    return spark.createDataFrame([(i, v, "n", 0) for i, v in zip(ids, vectors)], SCHEMA)


def brute(ids, vectors, threshold=0.95):
    """{id: (links, least id reachable)} by comparing all pairs."""
    x = np.array(vectors, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= threshold
    np.fill_diagonal(close, False)
    root = np.array(ids)
    while True:
        least = np.array([min([root[i], *root[close[i]]]) for i in range(len(ids))])
        if (least == root).all():
            return {i: (int(n), int(r)) for i, n, r in zip(ids, close.sum(1), root)}
        root = least


def vectors(rng, groups, dim=64):
    """Rows around ``groups`` random directions: (members, size of their noise)."""
    out = []
    for n, noise in groups:
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(n):
            step = rng.standard_normal(dim)
            out.append(centre + noise * step / np.linalg.norm(step))
    order = rng.permutation(len(out))
    return [out[i].astype(np.float32).tolist() for i in order]


def collected(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


@pytest.mark.parametrize(
    "groups,block",
    [
        ([(1, 0)] * 300 + [(2, 0.15)] * 30 + [(9, 0.12)] * 5, ed.BLOCK),
        ([(1, 0)] * 200 + [(150, 0.1)], 20),  # a ball
        ([(1, 0)] * 100 + [(90, 0.18), (40, 0.3)], 16),  # members around the ball's border
        ([(60, 0.05), (60, 0.22)] + [(1, 0)] * 50, 8),
    ],
)
def test_links_equal_brute_force(spark, monkeypatch, groups, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    monkeypatch.setattr(ed, "VISITORS", 64)
    monkeypatch.setattr(ed, "SAMPLES_A_WORD", 8)
    rng = np.random.default_rng(len(groups))
    rows = vectors(rng, groups)
    ids = [int(i) for i in rng.permutation(len(rows)) + 5]
    got, want = collected(ed.embedding_duplicates(frame(spark, ids, rows))), brute(ids, rows)
    pairs = sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert sum(n for n, _ in got.values()) >= 0.999 * pairs
    if sum(n for n, _ in got.values()) == pairs:
        assert got == want


def test_links_are_symmetric(spark, monkeypatch):
    """With a budget that loses pairs, what one end finds counts for both."""
    monkeypatch.setattr(ed, "SAMPLES_A_WORD", 4)
    rng = np.random.default_rng(9)
    rows = vectors(rng, [(2, 0.2)] * 150)
    got = collected(ed.embedding_duplicates(frame(spark, range(300), rows), recall=0.3))
    assert 0 < sum(n for n, _ in got.values()) < 300
    sizes = {}
    for n, root in got.values():
        sizes.setdefault(root, []).append(n)
    assert all(ns in ([0], [1, 1]) for ns in sizes.values())


def test_edge_rows(spark):
    v = [1.0] + [0.0] * 7
    nan, inf = float("nan"), float("inf")
    rows = [(1, v), (2, v), (2, v), (3, None), (4, [0.0] * 8), (5, [nan] + v[1:]), (6, [inf] + v[1:]), (7, [None] + v[1:]), (8, [1.0, 0.0]),
            (None, [2 * x for x in v]), (9, [-1.0] + v[1:]), (10, [])]
    df = spark.createDataFrame([(i, x, "n", 0) for i, x in rows], SCHEMA)
    out = sorted(((r.vec_id if r.vec_id is not None else -1), r.n_links, r.component_id, r.kept) for r in ed.embedding_duplicates(df).collect())
    assert out == [(-1, 3, 1, False), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]]
    assert ed.embedding_duplicates(df.limit(0)).count() == 0
    assert [r.n_links for r in ed.embedding_duplicates(df.where("vec_id in (3, 4)"), dim=8).collect()] == [0, 0]
