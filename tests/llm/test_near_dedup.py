"""Near-duplicates against brute force, and their components."""

import random

import pytest

from servicelens.llm import near_dedup, shingles

DOCS = "doc_id long, text string, node string, root int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "n", 0) for i, t in rows], DOCS)


def brute(rows, width, similarity=80):
    """{id: (set size, least id reachable)} for unique ids, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, groups, copies, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=words)
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width,groups,copies", [(2, 25, 6), (5, 25, 6), (2, 2, 60)])
def test_components_equal_brute_force(spark, width, groups, copies):
    """The last case has lists beyond SMALL, so hubs do the work."""
    rows = corpus(width * groups, groups, copies)
    out = near_dedup.near_duplicates(frame(spark, rows), width=width).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert got == brute(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_long_lists_of_different_texts(spark, monkeypatch):
    """Hubs leave lists open: the rest meets under differences from the hubs."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    rows = corpus(9, 3, 25, words=25)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), width=2).collect()}
    assert got == brute(rows, 2)


def test_differences_find_all_links_with_few_pairs(spark):
    """One list of near copies, most of them not linked with the hub or each other."""
    rng = random.Random(4)
    base = list(range(1000, 1100))
    sets = {bytes([0, 0]): base}
    for n in range(1, 160):
        one = set(rng.sample(base, 100 - rng.randint(2, 22))) | set(rng.choices(range(n * 40), k=rng.randint(2, 18)))
        sets[bytes([n // 100, n % 100 + 1])] = sorted(one)
    sets[bytes([9, 1])] = sorted(sets[bytes([1, 30])][1:] + [77_777])  # linked with an odd one
    similar = lambda x, y: 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y))
    hub = bytes([0, 0])
    root = {n: hub if similar(s, base) else n for n, s in sets.items()}
    whole = spark.createDataFrame([(n, s) for n, s in sets.items()], "node binary, shingles array<bigint>")
    rows = [((hub, hub), n, len(s), 0, 0, root[n]) for n, s in sets.items() if n != hub]
    schema = "hub struct<node: binary, root: binary>, node binary, n_shingles bigint, bits0 bigint, bits1 bigint, root binary"
    found = near_dedup.differences(spark.createDataFrame(rows, schema), whole, 80)
    assert {bytes(r.node) for r in found.where("near").collect()} == {n for n in sets if n != hub and root[n] == hub}
    pairs = near_dedup.difference_pairs(near_dedup.difference_postings(found, 80), 80)
    got = {(bytes(r.a), bytes(r.b)) for r in pairs.collect()}
    names = sorted(n for n in sets if n != hub)
    across = [(x, y) for k, x in enumerate(names) for y in names[k + 1 :] if root[x] != root[y]]
    links = {(x, y) for x, y in across if similar(sets[x], sets[y])}
    assert links and links <= got
    assert len(got) < len(across) / 10


def test_one_set_of_differences_a_node(spark, monkeypatch):
    """A group of near copies has many hubs; the differences are taken from one of them."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(120):
        text = list(base)
        for at in rng.sample(range(60), rng.randint(0, 6)):
            text[at] = f"v{rng.randrange(90)}"
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    differences, described = near_dedup.differences, []

    def seen(lists, *more):
        found = differences(lists, *more)
        described.append((found.count(), found.select("node").distinct().count()))
        return found

    monkeypatch.setattr(near_dedup, "differences", seen)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), width=2).collect()}
    assert got == brute(rows, 2)
    [(described, nodes)] = described
    assert nodes > 60 and described <= 1.1 * nodes


def test_unlike_texts_of_common_words_are_not_described(spark, monkeypatch):
    """Single coordinates agree by chance in long lists of such texts; pairs of coordinates seldom do."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(14)]
    rows = [(i, " ".join(rng.choices(words, k=45))) for i in range(500)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(5)]
    described, differences = [], near_dedup.differences

    def seen(*args):
        found = differences(*args)
        described.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "differences", seen)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), width=2).collect()}
    assert got == brute(rows, 2) and [got[1000 + i][1] for i in range(5)] == list(range(5))
    assert sum(described) <= 50


def test_matching_signatures_share_tokens(spark):
    """Wherever the equal coordinates stand; and equal values of other pairs are other tokens."""
    rng = random.Random(8)
    rows = []
    for _ in range(200):
        one = [rng.choice([0, -1, rng.getrandbits(31)]) for _ in range(64)]
        other = [rng.getrandbits(31) for _ in range(64)]
        for at in rng.sample(range(64), 36):
            other[at] = one[at]
        rows.append((one, other))
    rows.append(([2 * (k // 2) for k in range(64)], list(range(64))))
    # the worst case: every pair has an equal coordinate, and only four have both
    rows.append((list(range(64)), [k if k % 2 or k < 8 else -k for k in range(64)]))
    tokens = near_dedup.pair_tokens
    found = spark.createDataFrame(rows, "one array<int>, other array<int>").select(tokens("one").alias("a"), tokens("other").alias("b")).collect()
    shared = [len(set(r.a) & set(r.b)) for r in found]
    assert min(shared[:200]) >= near_dedup.SHARED == 4 and shared[200] == 0 and shared[201] == 4
    assert len(found) == 202 and all(len(set(r.a)) == 32 for r in found)


def test_leading_hubs(spark):
    """Hub 3 stands in the list of hub 1 and of hub 2, hub 4 in that of hub 1 without being like it."""
    one, two, three, four = ((w, bytes([w]), n, 0, 0, bytes([w])) for w, n in ((9, 100), (8, 95), (7, 90), (6, 10)))
    rows = [(i, x[1], x[2], 0, 0, hub) for i, hub, xs in ((1, one, (one, three, four)), (2, two, (two, three)), (3, three, (three,)), (4, four, (four,))) for x in xs]
    schema = "token int, node binary, n_shingles bigint, bits0 bigint, bits1 bigint, hub struct<weight: int, node: binary, n_shingles: bigint, bits0: bigint, bits1: bigint, root: binary>"
    found = near_dedup.leading_hubs(spark.createDataFrame(rows, schema), 80).collect()
    assert {r.hub[0]: r.leader[0] for r in found} == {9: 9, 8: 8, 7: 9, 6: 6}


def test_edge_rows(spark):
    long = " ".join(f"x{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, long), (7, long + " y"), (8, "É a b"), (9, "é a b"), (None, "one")]
    out = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows), width=2).collect()}
    assert out == {1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (4, False), 6: (6, True), 7: (6, False), 8: (8, True), 9: (9, True), None: (4, False)}
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_drop_keeps_one_of_each_group(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "z y x w v u"), (2, "a b c d e f"), (3, None), (3, None), (4, "")]
    df = frame(spark, rows)
    out = near_dedup.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(1, "a b c d e f"), (1, "z y x w v u"), (3, ""), (3, ""), (4, "")]


def test_components_of_a_chain(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(1, 60)] + [(b"\x90", b"\x91")]
    out = near_dedup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    assert {bytes(r.node): bytes(r.root) for r in out} == {bytes([i]): b"\x01" for i in range(2, 61)} | {b"\x91": b"\x90"}


def test_signature_estimates_similarity():
    a, b = shingles.permutations(64)
    memo = shingles._WordHashes()
    one = shingles.shingle_set(" ".join(f"w{i}" for i in range(1000)), 2, memo)
    two = shingles.shingle_set(" ".join(f"w{i}" for i in range(100, 1000)), 2, memo)
    assert 44 <= (shingles.signature(one, a, b) == shingles.signature(two, a, b)).sum() <= 64


def test_drop_keeps_one_where_ids_repeat_or_are_null(spark):
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, long), (1, long + " x"), (2, long + " y"), (None, other), (None, other + " x"), (None, other + " x"), (None, "Alone here now"), (1, "not like the others"), (None, long + " z"), (5, "Copy of it"), (5, "copy of it")]
    out = near_dedup.drop_near_duplicates(frame(spark, rows), width=2).collect()
    groups = [sum((r.text or "").lower().startswith(k) for r in out) for k in ("w0", "v0", "alone", "not", "copy")]
    assert groups == [1] * 5 and len(out) == 5
    assert next(r.doc_id for r in out if r.text.startswith("w0")) == 1
