"""Near-duplicate embeddings from an inverted multi-index.

1. Equal vectors share one node with a weight; nulls, zero vectors and vectors with
   null or non-finite parts get none.
2. Each half of the vectors has a codebook of its own, fitted by k-means on at
   most ``SAMPLE`` nodes (those with the least digests; the only bounded
   sample).  A pair of codewords is a cell of the product grid; every node is
   posted in the cell of its nearest codewords, with about ``OCCUPANCY`` nodes a cell.
3. A multi-sequence traversal merges a vector's two lists of codewords by distance and
   visits the cells in the order of their summed distances, up to a
   budget over the nearest one.  The budget is fitted for a target recall: sampled vectors
   are turned away until their cosine is just the threshold, the worst case
   of a link, and ``RECALL`` of them must find the cell that the turned vector lies in.
   A pair is met when either of the two visits the other's cell, so still fewer are lost.
4. Every visitor is held against the members of a cell in double precision; only
   counts and a spanning set of links leave the task.  A pair that both ends visit counts
   once for each; one that a single end visits counts for both there.
5. Long cells: a cell of more than ``BLOCK`` nodes has a pivot, its mean
   direction.  Nodes within half the threshold's angle of a pivot form its
   ball; by the triangle inequality all of them are linked, so they
   are counted and joined without any comparison, wherever their cells
   are.  (A node in several balls belongs to that of the fullest cell.)
   Lists are kept for each cell and ball, and nodes skip the lists of their own ball.  All
   other lists are cut into blocks of ``BLOCK`` members, and the visitors of a
   block into groups of ``VISITORS``; each such pair of groups is one key of
   the shuffle.  So a hot vector with a third of all rows costs its own
   number of rows; what is compared in full is what lies just outside of a ball.
6. Components of the links come from large-star and small-star steps.

Vectors travel as 32-bit floats as given; cosines are computed from them in
double precision.  All intermediate tables are Parquet in the shared folder.

Defined results: vectors without a node and those of another length than most
(``dim``) have no links and are their own component; repeated rows and equal vectors are
linked with each other; of null ids another member's id names the component, if
there is one; ties go to the least id; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.llm.near_dedup import components
from servicelens.plans.physical import materialize

# Workers get this module's functions by value: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.95
RECALL = 0.99  # of the turned vectors, for one of the two directions; 0.9997 were met from either one
SAMPLE = 32_768  # nodes that codebooks and budget are fitted on, at most
CODEWORDS = 1_024  # of a half, at most
SAMPLES_A_WORD = 32
OCCUPANCY = 64  # nodes a cell
BLOCK = 1_024  # members of a list held in memory
VISITORS = 8_192  # that one block is held against in one group
BROADCAST_CELLS = 1_000_000  # directory rows that are broadcast
BROADCAST_PIVOTS = 20_000
ROUNDS = 10  # of k-means
MARGIN = 1e-9  # what a ball leaves to rounding


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """List column without nulls -> unit vectors in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _fit_words(points: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's k-means from points spread over the sample's order."""
    words = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        near = ((words * words).sum(1) - 2 * points @ words.T).argmin(1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=k)
        words[n > 0] = sums[n > 0] / n[n > 0, None]
    return words


class Index:
    """Codebooks of the halves and the traversal's budget."""

    def __init__(self, sample: np.ndarray, n_nodes: int, threshold: float, recall: float):
        self.half = sample.shape[1] // 2
        k = int(np.ceil(np.sqrt(n_nodes / OCCUPANCY)))
        k = max(1, min(k, CODEWORDS, len(sample) // SAMPLES_A_WORD))
        self.words = [_fit_words(part, k) for part in (sample[:, : self.half], sample[:, self.half :])]
        self.k = k
        self.budget = self._budget(sample, threshold, recall)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to the codewords of both halves, over the nearest."""
        out = []
        for part, words in zip((x[:, : self.half], x[:, self.half :]), self.words):
            d = (words * words).sum(1) - 2 * part @ words.T
            out.append(d - d.min(1)[:, None])
        return out[0], out[1]

    def _budget(self, sample: np.ndarray, threshold: float, recall: float) -> float:
        turn = np.random.default_rng(12).standard_normal(sample.shape)
        turn -= (turn * sample).sum(1)[:, None] * sample
        turn /= np.maximum(np.linalg.norm(turn, axis=1), 1e-300)[:, None]
        turned = threshold * sample + np.sqrt(max(0.0, 1 - threshold * threshold)) * turn
        rows = np.arange(len(sample))
        (a, b), (c, d) = self.distances(sample), self.distances(turned)
        over = a[rows, c.argmin(1)] + b[rows, d.argmin(1)]
        return float(np.quantile(over, recall))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Every row's own cell, and the cells it visits, nearest first."""
        a, b = self.distances(x)
        own = a.argmin(1) * self.k + b.argmin(1)
        visits = []
        for i in range(len(x)):
            # the codewords of each half within the budget, by distance
            ia, ib = (np.flatnonzero(d[i] <= self.budget) for d in (a, b))
            ia, ib = ia[np.argsort(a[i, ia], kind="stable")], ib[np.argsort(b[i, ib], kind="stable")]
            summed = a[i, ia][:, None] + b[i, ib][None, :]
            at, bt = np.nonzero(summed <= self.budget)
            order = np.argsort(summed[at, bt], kind="stable")
            cells = ia[at[order]] * self.k + ib[bt[order]]
            visits.append(cells if own[i] in cells else np.append(cells, own[i]))
        return own, visits


def _digests(dim: int):
    """Batches of (__id, __vector) -> (__id, node, vector); node is null for
    vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, vectors = [], []
            for value in batch.column("__vector"):
                parts = value.as_py() if value.is_valid else None
                fits = parts is not None and len(parts) == dim and None not in parts
                x = np.array(parts, np.float32) if fits else None
                fits = fits and bool(np.isfinite(x).all()) and bool(x.any())
                nodes.append(xxhash.xxh3_128_digest((x + np.float32(0)).tobytes()) if fits else None)
                vectors.append(x if fits else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), pa.array(nodes, pa.binary()), pa.array(vectors, pa.list_(pa.float32()))], ["__id", "node", "vector"]
            )

    return run


def _poster(index: Index, dim: int):
    """Batches of (node, vector) -> (node, vector, cell, visits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, visits = index.cells(_matrix(batch.column("vector"), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("weight"), batch.column("vector"), pa.array(own, pa.int64()), pa.array(visits, pa.list_(pa.int64()))],
                ["node", "weight", "vector", "cell", "visits"],
            )

    return run


class _Block:
    """The members of one list block, and what visitors have found of them."""

    def __init__(self, dim: int, threshold: float):
        self.dim, self.threshold, self.parts = dim, threshold, []

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def close(self) -> None:
        members = pa.Table.from_batches(self.parts).combine_chunks()
        self.nodes = members.column("node").to_pylist()
        self.weights = members.column("weight").to_numpy()
        self.x = _matrix(members.column("vector").combine_chunks(), self.dim)
        self.home = members.column("cell").to_numpy()
        visits = members.column("visits").combine_chunks()
        owner = np.repeat(np.arange(len(self.nodes)), np.diff(visits.offsets.to_numpy()))
        cells = visits.flatten().to_numpy()
        # (member, visited cell) as one sorted list of pairs
        self.cells, at = np.unique(cells, return_inverse=True)
        self.visited = np.unique(owner * len(self.cells) + at)
        self.number = {n: i for i, n in enumerate(self.nodes)}
        self.label = np.arange(len(self.nodes))
        self.found = np.zeros(len(self.nodes), np.int64)
        self.touched = np.zeros(len(self.nodes), bool)

    def visits(self, member: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Whether the members visit the cells."""
        at = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        key = member * len(self.cells) + at
        place = np.minimum(np.searchsorted(self.visited, key), len(self.visited) - 1)
        return (self.cells[at] == cell) & (self.visited[place] == key)

    def hold(self, batch: pa.RecordBatch) -> list[tuple]:
        """(node, links found here, a linked member) of visitors with links."""
        names = batch.column("node").to_pylist()
        close = _matrix(batch.column("vector"), self.dim) @ self.x.T >= self.threshold
        for i, name in enumerate(names):
            if name in self.number:
                close[i, self.number[name]] = False
        out = []
        v, m = np.nonzero(close)
        if not len(v):
            return out
        # what the member will not see for itself counts here
        unseen = ~self.visits(m, batch.column("cell").to_numpy()[v])
        np.add.at(self.found, m[unseen], batch.column("weight").to_numpy()[v[unseen]])
        self.touched[m] = True
        cut = np.searchsorted(v, np.arange(len(names) + 1))
        for i in np.unique(v):
            linked = m[cut[i] : cut[i + 1]]
            out.append((names[i], int(self.weights[linked].sum()), self.nodes[linked[0]]))
            labels = np.unique(self.label[linked])
            if len(labels) > 1:
                self.label[np.isin(self.label, labels)] = labels[0]
        return out

    def rest(self) -> list[tuple]:
        """(node, links found for it, the member that stands for its group)."""
        return [(self.nodes[i], int(self.found[i]), self.nodes[self.label[i]]) for i in np.flatnonzero(self.touched)]


def _holder(dim: int, threshold: float):
    """Batches sorted by (key, role): of each key the members (role 0), then the
    visitors -> (node, links, other).  One block of members is in memory, visitors stream by."""

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["node", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, closed = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = list(zip(*(batch.column(c).to_pylist() for c in ("list", "block", "group"))))
            roles = batch.column("role").to_pylist()
            starts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1] or roles[i] != roles[i - 1]), len(ids)]
            for a, b in zip(starts, starts[1:]):
                if ids[a] != key:
                    if closed:
                        yield rows(block.rest())
                    key, block, closed = ids[a], _Block(dim, threshold), False
                part = batch.slice(a, b - a)
                if roles[a] == 0:
                    block.add(part)
                    continue
                if not block.parts:
                    continue
                if not closed:
                    block.close()
                    closed = True
                for at in range(0, len(part), BLOCK):
                    yield rows(block.hold(part.slice(at, BLOCK)))
        if closed:
            yield rows(block.rest())

    return run


def _dimension(rows: DataFrame) -> int:
    """The length of most vectors (the larger of equally frequent ones)."""
    sizes = rows.where("__vector is not null").groupBy(F.size("__vector").alias("dim")).agg(F.count("*").alias("n"))
    most = sizes.agg(F.max(F.struct("n", "dim"))["dim"]).first()[0]
    return int(most or 0)


def _balls(posted: DataFrame, cells: DataFrame, dim: int, threshold: float) -> DataFrame | None:
    """(node, ball) of the nodes within half the threshold's angle of the pivot of
    a long cell; None if no cell is long."""
    hot = materialize(cells.where(F.col("n") > BLOCK), "long-cells")
    n_hot = hot.count()
    if not n_hot:
        return None
    of_cell = posted.join(F.broadcast(hot) if n_hot <= BROADCAST_PIVOTS else hot, "cell")
    mean = [F.avg(F.get("vector", F.lit(i)).cast("double")).alias(f"m{i}") for i in range(dim)]
    pivots = of_cell.groupBy("cell").agg(F.first("n").alias("n"), *mean)
    pivots = pivots.select(F.col("cell").alias("ball"), "n", F.array(*[f"m{i}" for i in range(dim)]).alias("pivot"))
    pivots = materialize(pivots, "pivots")
    near = posted.select("node", "vector", F.explode("visits").alias("ball"))
    near = near.join(F.broadcast(pivots) if n_hot <= BROADCAST_PIVOTS else pivots, "ball")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("vector", "pivot") / F.sqrt(dot("vector", "vector") * dot("pivot", "pivot"))
    half = float(np.sqrt((1 + threshold) / 2))
    inside = near.where(cosine >= F.lit(half + MARGIN))
    return inside.groupBy("node").agg(F.max(F.struct("n", "ball"))["ball"].alias("ball"))


def _found(posted: DataFrame, dim: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(links (node, links), edges (a, b)) of all nodes."""
    cells = materialize(posted.groupBy("cell").agg(F.count("*").alias("n")), "cells")
    balls = _balls(posted, cells, dim, threshold)
    if balls is None:
        at = posted.withColumn("ball", F.lit(None).cast("long"))
    else:
        at = materialize(posted.join(balls, "node", "left"), "balls")
    visiting = at.select("node", "ball", F.explode("visits").alias("cell"))
    guests = visiting.groupBy("cell").agg(F.count("*").alias("guests"))
    # one list for each cell and ball; blocks of members, groups of visitors
    lists = at.groupBy("cell", "ball").agg(F.count("*").alias("n")).join(guests, "cell")
    lists = lists.select(
        F.col("cell").alias("list_cell"),
        F.col("ball").alias("list_ball"),
        F.xxhash64("cell", F.coalesce("ball", F.lit(-1))).alias("list"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("guests") / VISITORS).cast("int").alias("groups"),
    )
    lists = materialize(lists, "lists")
    known = F.broadcast(lists) if lists.count() <= BROADCAST_CELLS else lists
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    salt = F.xxhash64("node")
    columns = ["list", "block", "group", "role", "node", "weight", "vector", "cell", "visits"]
    members = at.join(known, (F.col("cell") == F.col("list_cell")) & F.col("ball").eqNullSafe(F.col("list_ball")))
    members = members.withColumn("block", F.pmod(salt, F.col("blocks").cast("long")).cast("int")).withColumn("group", upto("groups"))
    members = members.withColumn("role", F.lit(0)).select(*columns)
    visitors = at.withColumn("visited", F.explode("visits")).withColumn("visits", F.lit(None).cast("array<bigint>"))
    other_ball = F.col("list_ball").isNull() | F.col("ball").isNull() | (F.col("ball") != F.col("list_ball"))
    visitors = visitors.join(known, (F.col("visited") == F.col("list_cell")) & other_ball)
    group = F.pmod(F.shiftright(salt, 20), F.col("groups").cast("long")).cast("int")
    visitors = visitors.withColumn("group", group).withColumn("block", upto("blocks")).withColumn("role", F.lit(1)).select(*columns)
    keyed = members.unionByName(visitors).repartition("list", "block", "group").sortWithinPartitions("list", "block", "group", "role")
    held = materialize(keyed.mapInArrow(_holder(dim, threshold), "node binary, links long, other binary"), "held")
    links = held.groupBy("node").agg(F.sum("links").alias("links"))
    edges = held.where("node != other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    if balls is not None:
        inside = at.where("ball is not null")
        whole = inside.groupBy("ball").agg(F.sum("weight").alias("in_ball"), F.min("node").alias("first"))
        whole = inside.select("node", "weight", "ball").join(whole, "ball")
        links = links.unionByName(whole.select("node", (F.col("in_ball") - F.col("weight")).alias("links")))
        links = links.groupBy("node").agg(F.sum("links").alias("links"))
        edges = edges.unionByName(whole.where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b")))
    return links, edges


def embedding_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    dim: int | None = None,
) -> DataFrame:
    """One row per row: id, n_links (other vectors of cosine >= ``threshold``),
    component_id (least id that links reach, its own included), kept (id =
    component_id)."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{vector_col}`").cast("array<float>").alias("__vector"))
    id_type = rows.schema["__id"].dataType.simpleString()
    dim = dim or _dimension(rows)
    nodes_of = materialize(rows.mapInArrow(_digests(dim), f"__id {id_type}, node binary, vector array<float>"), "vectors")
    least = F.min(F.struct(F.col("__id").isNull().alias("no_id"), "__id")).alias("least")
    nodes = nodes_of.where("node is not null").groupBy("node")
    nodes = materialize(nodes.agg(F.count("*").alias("weight"), least, F.first("vector").alias("vector")), "nodes")
    n_nodes = nodes.count()
    if not n_nodes:
        alone = F.col("__id")
        return rows.select(alone.alias(id_col), F.lit(0).cast("long").alias("n_links"), alone.alias("component_id"), F.lit(True).alias("kept"))
    sample = nodes.select("node", "vector").orderBy("node").limit(SAMPLE).toArrow()
    index = Index(_matrix(sample.column("vector").combine_chunks(), dim), n_nodes, threshold, recall)
    posted = nodes.select("node", "weight", "vector").mapInArrow(
        _poster(index, dim), "node binary, weight long, vector array<float>, cell long, visits array<bigint>"
    )
    links, edges = _found(materialize(posted, "posted"), dim, threshold)
    roots = components(edges)
    named = nodes.select("node", "weight", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = named.join(roots.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("least").alias("of_group"))
    named = named.join(heads, "root", "left").join(links, "node", "left")
    total = F.col("weight") - 1 + F.coalesce("links", F.lit(0))
    named = named.select("node", total.alias("n_links"), F.coalesce("of_group", "least").alias("least"))
    out = nodes_of.select("__id", "node").join(named, "node", "left")
    component = F.coalesce("least.__id", "__id")
    kept = F.col("node").isNull() | F.col("__id").eqNullSafe(component)
    return out.select(F.col("__id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), kept.alias("kept"))


def op12_query(spark, sf_dir: str) -> DataFrame:
    return embedding_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
