"""Weighted k-means for many k and many groups in one pass per iteration
(M9-M11, F4).

Equal feature rows count as one weighted point.  All runs (a run is a group
and a k) share their passes over the points: a pass assigns every point to the
nearest centre of each active run and sums up, keyed by (group, k, cluster), the
weights and weighted features; partial sums are combined map-side, so a pass
shuffles at most runs x clusters rows a task.  Runs whose centres stand
still leave the next pass.

The first centres are drawn like k-means++ with fixed pseudo-random numbers: the next
centre is the point with the least -ln(u) / (weight x squared distance to the
nearest centre so far), u from the MD5 of the point's name and the step's
number.  That is one pass a step for all groups, and the centres for k are
the first k drawn, so all k share them.  Results depend neither on the layout nor on
the cluster: sums of whole numbers are exact, and ties go to the first centre.

The centres (groups x k x clusters) are the whole state.  The driver holds them
as ``Run`` tuples, as MLlib's k-means does, for at most ``LOCAL_CENTRES`` centres at a time:
more groups are fitted slice by slice.  ``run_table`` and ``runs_of`` turn runs
into a table that can be written and back, to go on with later.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

LOCAL_CENTRES = 100_000
MAX_ITERATIONS = 10_000  # Lloyd ends long before; a stop for rounding that circles

POINT = ("quantity", "frequency")


def weighted_points(features: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, x, y, weight, name): distinct feature rows; ``name`` is the least part
    number among them.  Rows with a missing or non-finite feature are left out."""
    rows = features.select(*by, *[F.col(c).cast("double").alias(n) for c, n in zip(POINT, ("x", "y"))], "part_no")
    rows = rows.where("abs(x) < double('inf') AND abs(y) < double('inf')")  # false for NaN too
    return rows.groupBy(*by, "x", "y").agg(F.count(F.lit(1)).cast("double").alias("weight"), F.min("part_no").alias("name"))


class Run(NamedTuple):
    """One k-means: its group (the values of ``by``), k and centres."""

    group: tuple
    k: int
    centres: tuple[tuple[float, float], ...]


_CENTRE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Rows as a local relation (through Arrow, without a job)."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(arrow.types)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def run_table(points: DataFrame, runs: list[Run], by: tuple[str, ...] = ()) -> DataFrame:
    """Runs as a table (by, k, centres)."""
    fields = [points.schema[c] for c in by] + [T.StructField("k", T.IntegerType()), T.StructField("centres", T.ArrayType(_CENTRE))]
    rows = [(*r.group, r.k, [{"x": x, "y": y} for x, y in r.centres]) for r in runs]
    return local_rows(points.sparkSession, rows, T.StructType(fields))


def runs_of(table: DataFrame, by: tuple[str, ...] = ()) -> list[Run]:
    """The runs of a table (by, k, centres)."""
    return [Run(tuple(r[c] for c in by), r["k"], tuple((c["x"], c["y"]) for c in r["centres"])) for r in table.collect()]


def _per_group(points: DataFrame, runs: list[Run], by: tuple[str, ...]) -> DataFrame:
    """(by, runs): the runs of a group in one array."""
    grouped: dict[tuple, list] = {}
    for run in runs:
        grouped.setdefault(run.group, []).append({"k": run.k, "centres": [{"x": x, "y": y} for x, y in run.centres]})
    run_type = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("centres", T.ArrayType(_CENTRE))])
    schema = T.StructType([*[points.schema[c] for c in by], T.StructField("runs", T.ArrayType(run_type))])
    return local_rows(points.sparkSession, [(*g, rs) for g, rs in grouped.items()], schema)


def _constant(run: Run) -> str:
    """The centres of a run as a constant; generated code refers to such a
    constant and so stays the same from pass to pass."""
    pairs = ", ".join(f"named_struct('x', {float(x)!r}D, 'y', {float(y)!r}D)" for x, y in run.centres)
    return f"array({pairs})"


# (distance, cluster) of the nearest centre in the column ``centres``; the first of equals.
_NEAREST = """array_min(transform(centres, (c, i) -> named_struct(
    'd', (x - c.x) * (x - c.x) + (y - c.y) * (y - c.y), 'cluster', i)))"""


def group_slices(points: DataFrame, most: int, by: tuple[str, ...]) -> Iterator[DataFrame]:
    """The points of so many groups at a time that the runs up to ``most``
    clusters have at most ``LOCAL_CENTRES`` centres.  Null groups have no runs."""
    if not by:
        yield points
        return
    at_once = max(1, LOCAL_CENTRES // (most * (most + 1)))
    sound = points.na.drop(subset=list(by))
    n = sound.select(*by).distinct().count()
    slices = -(-n // at_once)
    for i in range(slices):
        # hashed slices are even up to chance, and need no list of the groups
        yield sound if slices == 1 else sound.where(F.pmod(F.xxhash64(*by), F.lit(slices)) == i)


def first_centres(points: DataFrame, most: int, by: tuple[str, ...] = ()) -> list[tuple[tuple, float, list]]:
    """(group, number of parts, up to ``most`` centres in the order drawn) of each group."""

    def drawn(step: int, weight: Column, rows: DataFrame) -> dict[tuple, tuple]:
        digits = F.substring(F.md5(F.concat(F.col("name"), F.lit(f":{step}"))), 1, 12)
        u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**12))
        key = F.struct((-F.ln(u) / weight).alias("key"), "name")
        picked = rows.groupBy(*by).agg(F.min_by(F.struct("x", "y"), F.when(weight > 0, key)).alias("c"), F.sum("weight").alias("n"))
        return {tuple(r[c] for c in by): (r["n"], r["c"]) for r in picked.collect() if r["c"] is not None}

    found = {g: (n, [(c["x"], c["y"])]) for g, (n, c) in drawn(0, F.col("weight"), points).items()}
    for step in range(1, most):
        state = [Run(g, len(cs), tuple(cs)) for g, (_, cs) in found.items()]
        if not state:
            break
        if by:
            rows = points.join(F.broadcast(run_table(points, state, by).drop("k")), list(by))
        else:
            rows = points.withColumn("centres", F.expr(_constant(state[0])))
        rows = rows.withColumn("near", F.expr(_NEAREST))
        for g, (_, c) in drawn(step, F.col("weight") * F.col("near.d"), rows).items():
            found[g][1].append((c["x"], c["y"]))
    return [(g, n, cs) for g, (n, cs) in found.items()]


def starting_runs(points: DataFrame, k_range: tuple[int, int], by: tuple[str, ...] = ()) -> list[Run]:
    """A run for every k of the range that is below the group's number of parts and
    has so many different points."""
    lo, hi = k_range
    drawn = first_centres(points, hi, by)
    return [Run(g, k, tuple(cs[:k])) for g, n, cs in drawn for k in range(lo, hi + 1) if k <= len(cs) and k < n]


def _assigned(points: DataFrame, runs: list[Run], by: tuple[str, ...]) -> DataFrame:
    """(by, x, y, weight, k, cluster): one row a point and run."""
    if by:  # at most LOCAL_CENTRES centres in all
        rows = points.join(F.broadcast(_per_group(points, runs, by)), list(by)).selectExpr(*by, "x", "y", "weight", "explode(runs) AS run")
    else:
        every = ", ".join(f"named_struct('k', {r.k}, 'centres', {_constant(r)})" for r in runs)
        rows = points.selectExpr("x", "y", "weight", f"explode(array({every})) AS run")
    nearest = _NEAREST.replace("centres", "run.centres")
    return rows.selectExpr(*by, "x", "y", "weight", "run.k AS k", f"{nearest}.cluster AS cluster")


def improved(points: DataFrame, runs: list[Run], by: tuple[str, ...] = ()) -> list[Run]:
    """One pass: every centre at its members' mean (an empty cluster's stays)."""
    sums = _assigned(points, runs, by).groupBy(*by, "k", "cluster").agg(F.expr("sum(weight) AS n"), F.expr("sum(weight * x) AS sx"), F.expr("sum(weight * y) AS sy"))
    means = {(tuple(r[c] for c in by), r["k"], r["cluster"]): (r["sx"] / r["n"], r["sy"] / r["n"]) for r in sums.collect()}
    return [Run(r.group, r.k, tuple(means.get((r.group, r.k, i), c) for i, c in enumerate(r.centres))) for r in runs]


def _still(old: Run, new: Run, tolerance: float) -> bool:
    moved = ((a - c) * (a - c) + (b - d) * (b - d) for (a, b), (c, d) in zip(old.centres, new.centres))
    return max(moved) <= tolerance * tolerance


def fit(
    points: DataFrame, runs: list[Run], tolerance: float, by: tuple[str, ...] = (), iterations: int | None = None
) -> tuple[list[Run], list[Run]]:
    """Lloyd's iterations over all runs at once: (finished, unfinished).  A run is
    finished when no centre moved farther than ``tolerance``.  Without
    ``iterations`` none stays unfinished; with it, the unfinished ones
    can be handed back in as ``runs`` to go on."""
    finished, active, turn = [], list(runs), 0
    while active and turn < (MAX_ITERATIONS if iterations is None else iterations):
        moved = improved(points, active, by)
        ended = [_still(old, new, tolerance) for old, new in zip(active, moved)]
        finished += [r for r, e in zip(moved, ended) if e]
        active = [r for r, e in zip(moved, ended) if not e]
        turn += 1
    return finished, active


def silhouettes(points: DataFrame, runs: list[Run], by: tuple[str, ...] = ()) -> dict[tuple, float]:
    """{(group, k): silhouette} of all runs: mean squared-Euclidean silhouette.

    The mean squared distance of a point to a cluster follows from the
    cluster's size, sum and sum of squares, so two passes do for all runs, whatever their
    sizes.  A part alone in its cluster counts 0."""
    if not runs:
        return {}
    squares = F.col("x") * F.col("x") + F.col("y") * F.col("y")
    assigned = _assigned(points, runs, by)
    w = F.col("weight")
    stats = assigned.groupBy(*by, "k", "cluster").agg(
        F.sum(w).alias("n"), F.sum(w * F.col("x")).alias("sx"), F.sum(w * F.col("y")).alias("sy"), F.sum(w * squares).alias("sq")
    )
    keys = [*by, "k"]
    held: dict[tuple, list] = {}
    for r in stats.collect():
        held.setdefault(tuple(r[c] for c in keys), []).append({c: r[c] for c in ("cluster", "n", "sx", "sy", "sq")})
    stat = T.StructType([T.StructField("cluster", T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in ("n", "sx", "sy", "sq")])
    schema = T.StructType([*[assigned.schema[c] for c in keys], T.StructField("stats", T.ArrayType(stat))])
    rows = assigned.join(F.broadcast(local_rows(points.sparkSession, [(*k, v) for k, v in held.items()], schema)), keys)
    total = lambda c: c["n"] * squares - 2 * (F.col("x") * c["sx"] + F.col("y") * c["sy"]) + c["sq"]
    mine = F.filter("stats", lambda c: c["cluster"] == F.col("cluster"))
    others = F.filter("stats", lambda c: c["cluster"] != F.col("cluster"))
    rows = rows.withColumn("own", F.element_at(mine, 1)).withColumn("b", F.array_min(F.transform(others, lambda c: total(c) / c["n"])))
    a = F.try_divide(total(F.col("own")), F.col("own.n") - 1)
    rows = rows.withColumn("a", F.when(F.col("own.n") > 1, a))
    larger = F.greatest("a", "b")
    score = F.when(F.col("a").isNull() | F.col("b").isNull() | (larger == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / larger)
    scores = rows.groupBy(*keys).agg((F.sum(w * score) / F.sum(w)).alias("silhouette"))
    return {(tuple(r[c] for c in by), r["k"]): r["silhouette"] for r in scores.collect()}


def labelled(features: DataFrame, runs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``features`` with the ``cluster`` of the one run that each group has in
    the table ``runs`` (by, centres)."""
    rows = features.withColumns({"x": F.col(POINT[0]).cast("double"), "y": F.col(POINT[1]).cast("double")})
    rows = rows.join(runs.select(*by, "centres"), list(by)) if by else rows.crossJoin(F.broadcast(runs.select("centres")))
    return rows.withColumn("cluster", F.expr(_NEAREST)["cluster"]).drop("x", "y", "centres")


def centre_rows(runs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, cluster, quantity, frequency) of a table of runs."""
    each = runs.select(*by, F.posexplode("centres").alias("cluster", "c"))
    return each.select(*by, "cluster", F.col("c.x").alias(POINT[0]), F.col("c.y").alias(POINT[1]))
