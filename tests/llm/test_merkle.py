"""Merkle manifests against trees built by hand."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from servicelens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, seg string, at int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        run = at // 3 * 3
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
        at //= 3
    return out


def by_hand(rows):
    """Sorted (doc_id, leaf, subroot, root, path) of all rows."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    key = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    groups = {s: sorted(rs, key=key) for s, rs in groups.items()}
    trees = {s: levels([leaf(r) for r in rs]) for s, rs in groups.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for at, row in enumerate(groups[s]):
            path = siblings(trees[s], at) + siblings(top, place)
            out.append((row[0] if row[0] is not None else -1, trees[s][0][at], trees[s][-1][0], top[-1][0], path))
    return sorted(out)


def made(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    out = merkle.manifest(docs).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in out)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1], [28, 1, 9, 10], [5, 81, 2, 1, 1, 1, 1, 1, 1, 27]])
def test_manifest_equals_trees_by_hand(spark, sizes):
    rows = [(100 * s + i, f"src{s}", "en", i, f"text ü {s} {i}") for s, n in enumerate(sizes) for i in range(n)]
    assert made(spark, rows) == by_hand(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (None, "null", "x", 1, ""), (3, "s", None, 0, "a"), (3, "s", None, 0, "a"), (3, "s", None, 0, "b"),
            (4, "", "x", 5, "c\n"), (5, "", "x", 5, "c"), (6, "\U0001F600", "x", 1, "d"), (7, "￮", "x", 1, "d"), (8, None, "y", 2, "e")]
    assert made(spark, rows) == by_hand(rows)


def test_empty_table(spark):
    assert merkle.verify(merkle.manifest(spark.createDataFrame([], SCHEMA))).count() == 0


def test_changed_leaves_do_not_verify(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"line {i}\nend") for i in range(40)]
    docs = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    cut = {"cut": lambda c: {"text": F.when(c["doc_id"] % 2 == 0, F.replace(c["text"], F.lit("\n"), F.lit(""))).otherwise(c["text"])}}
    out = merkle.verify(merkle.manifest(docs, claims=cut), "cut").collect()
    assert len(out) == 40 and all(r.verified == (r.doc_id % 2 == 1) for r in out)
    assert all(merkle_row.folded_root == merkle_row.root for merkle_row in out if merkle_row.verified)
