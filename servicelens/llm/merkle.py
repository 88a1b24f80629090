"""Merkle manifest of a table: a tree of arity 3 over the rows of every
source, and one over the sources' roots.

1. Every row becomes a leaf digest where it is scanned; texts never move.
2. Leaves are numbered inside their source by a range sort with offsets from
   partition counts (``segmented_ordinal``), so a source that holds a third of
   all rows spreads over as many tasks as any other third.
3. A level is one table of nodes (segment, at, digest, count).  Each node is
   joined with its siblings by computed indices: with slot = at mod 3 they
   stand at at - slot + (slot + 1) mod 3 and at - slot + (slot + 2) mod 3.
   Slot-zero rows, who then hold their whole run, emit the parent.  Segments
   with one node left are finished; their node is the subroot.
4. The subroots, numbered by source, are the leaves of one more such tree.
5. Proofs run downwards: a node's path is its own step (siblings before and
   after it) and then its parent's path, joined on the parent's index.  Levels
   shrink by three, so all joins together carry about one and a half times
   the rows; nothing is joined with all its ancestors one by one.
6. A leaf is folded up its path by ``aggregate``; a row is verified when the
   fold of its leaf equals the root.

Digests are lowercase hex SHA-256 of concatenated inputs, digests as hex text.
All is DataFrame functions; every level is written once in the shared folder.

Defined results: nulls count as ``-`` in a leaf, an empty text as ``0:``; rows
of equal id in a source are ordered by their leaf digest, so repeated rows are
interchangeable (null ids come first); null is a source of its own, before all
others; very long texts are hashed in place; an empty table gives an empty
manifest; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.operators.ordinal import segmented_ordinal
from servicelens.plans.physical import materialize

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<before:string,after:string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields, each ``-`` or its UTF-8 byte count, ``:`` and value."""
    coded = []
    for field in fields:
        text = field.cast("string")
        coded.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*coded), 256)


def _siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (seg, at, digest, count) with slot and the digests of the run's
    slots as d0, d1, d2 (null where the run is shorter)."""
    slot = F.col("at") % ARITY
    out = nodes.select("seg", "at", "digest", "count", slot.alias("slot"))
    for step in range(1, ARITY):
        sibling = F.col("at") - F.col("slot") + (F.col("slot") + step) % ARITY
        other = nodes.select(F.col("seg").alias("__seg"), F.col("at").alias("__at"), F.col("digest").alias(f"digest{step}"))
        out = out.withColumn("__want", sibling)
        out = out.join(other, (F.col("seg") == F.col("__seg")) & (F.col("__want") == F.col("__at")), "left").drop("__seg", "__at", "__want")
    # the digest at distance k stands in slot (slot + k) mod 3
    by_distance = F.array("digest", *[f"digest{step}" for step in range(1, ARITY)])
    in_slot = [F.get(by_distance, F.pmod(F.lit(i) - F.col("slot"), F.lit(ARITY)).cast("int")).alias(f"d{i}") for i in range(ARITY)]
    return out.select("seg", "at", "digest", "count", "slot", *in_slot)


def _own_step() -> Column:
    """The siblings before and after a node, left to right."""
    before = F.concat(*[F.when(F.col("slot") > i, F.coalesce(f"d{i}", F.lit(""))).otherwise("") for i in range(ARITY)])
    after = F.concat(*[F.when(F.col("slot") < i, F.coalesce(f"d{i}", F.lit(""))).otherwise("") for i in range(ARITY)])
    return F.array(F.struct(before.alias("before"), after.alias("after"))).cast(_STEP)


def tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All trees of ``leaves`` (seg, at, digest, count), numbered from 0 in each
    segment of ``count`` rows.  Returns (roots (seg, root), paths (seg, at, path)
    of every leaf); a path lists the siblings before and after, level by level."""
    empty = F.array().cast(_STEP)
    # as many levels as the largest segment needs
    most = leaves.agg(F.max("count")).first()[0] or 0
    levels, roots, nodes = [], [], leaves
    while True:
        roots.append(nodes.where("count = 1").select("seg", F.col("digest").alias("root")))
        if most <= 1:
            break
        level = materialize(_siblings(nodes.where("count > 1")), "merkle")
        levels.append(level)
        run = F.concat(*[F.coalesce(f"d{i}", F.lit("")) for i in range(ARITY)])
        shrunk = lambda c: F.ceil(F.col(c) / ARITY).cast("long")
        nodes = level.where("slot = 0").select("seg", F.expr(f"at div {ARITY}").alias("at"), F.sha2(run, 256).alias("digest"), shrunk("count").alias("count"))
        most = -(-most // ARITY)
    # downwards: own step, then the parent's path
    above = None
    for level in reversed(levels):
        here = level.select("seg", "at", F.expr(f"at div {ARITY}").alias("__up"), _own_step().alias("__step"))
        if above is None:
            paths = here.select("seg", "at", F.col("__step").alias("path"))
        else:
            up = above.select(F.col("seg").alias("__seg"), F.col("at").alias("__at"), F.col("path").alias("__path"))
            paths = here.join(up, (F.col("seg") == F.col("__seg")) & (F.col("__up") == F.col("__at")), "left")
            paths = paths.select("seg", "at", F.concat("__step", F.coalesce("__path", empty)).alias("path"))
        above = materialize(paths, "paths")
    lone = leaves.where("count = 1").select("seg", "at", empty.alias("path"))
    every_root = roots[0]
    for more in roots[1:]:
        every_root = every_root.unionByName(more)
    return every_root, lone if above is None else above.unionByName(lone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives along a path."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, left to right and level by level."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    source_col: str = "source",
    claims: dict[str, Callable[[dict[str, Column]], Column]] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, path (siblings, leaf
    to root).  ``claims`` adds leaf digests of altered rows: a name, and a
    function from the fields' columns to the replaced ones."""
    columns = {c: F.col(f"`{c}`") for c in fields}
    claimed = [
        leaf_digest([change(columns).get(c, columns[c]) for c in fields]).alias(f"__claim_{name}") for name, change in (claims or {}).items()
    ]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("__id"),
        F.col(f"`{source_col}`").cast("string").alias("__source"),
        leaf_digest(list(columns.values())).alias("leaf"),
        *claimed,
    )
    names = [f"__claim_{name}" for name in claims or {}]
    rows = segmented_ordinal(rows, ["__source"], ["__id", "leaf"], "at", total="count")
    # segments are keyed by text from here on, the null one apart from all names
    seg = F.coalesce(F.concat(F.lit("s"), F.col("__source")), F.lit("null"))
    rows = materialize(rows.withColumn("seg", seg), "leaves")
    subroots, paths = tree(rows.select("seg", "at", F.col("leaf").alias("digest"), "count"))
    subroots = materialize(subroots, "subroots")
    top = subroots.withColumn("__name", F.when(F.col("seg") != "null", F.expr("substring(seg, 2)"))).withColumn("__one", F.lit("all"))
    top = segmented_ordinal(top, ["__one"], ["__name"], "at", total="count")
    top = materialize(top.select(F.col("seg").alias("name"), F.col("__one").alias("seg"), "at", F.col("root").alias("digest"), "count"), "top")
    roots, top_paths = tree(top.select("seg", "at", "digest", "count"))
    top = top.join(top_paths, ["seg", "at"]).join(roots, "seg")
    top = materialize(top.select(F.col("name").alias("seg"), F.col("digest").alias("subroot"), "root", F.col("path").alias("__top")), "top-paths")
    out = rows.select("__id", "leaf", "seg", "at", *names).join(paths, ["seg", "at"])
    return out.join(top, "seg").select(
        F.col("__id").alias(id_col),
        "leaf",
        "subroot",
        "root",
        F.concat("path", "__top").alias("path"),
        *[F.col(f"__claim_{name}").alias(name) for name in claims or {}],
    )


def verify(rows: DataFrame, claim: str = "leaf") -> DataFrame:
    """``rows`` of a manifest with folded_root and verified for the leaf digest
    in column ``claim``."""
    folded = fold(F.col(claim), F.col("path"))
    return rows.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def without_line_ends(columns: dict[str, Column]) -> dict[str, Column]:
        tampered = F.crc32(columns["doc_id"].cast("string")) % 2 == 0
        return {"text": F.when(tampered, F.replace(columns["text"], F.lit("\n"), F.lit(""))).otherwise(columns["text"])}

    rows = verify(manifest(docs, claims={"claimed": without_line_ends}), "claimed")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified"
    )
