"""Global row ordinals without funnelling rows through one task.

``row_number()`` over an unpartitioned window moves every row into a single
task.  Here the rows are range-partitioned and sorted by the ordering keys
(a distributed sort), each partition counts its rows, the per-partition
counts (one row per partition) become offsets, and a row's ordinal is its
partition's offset plus its position inside the partition.  The sorted rows
with their (partition, position) tags are written once before the counts
are taken, so the counts and the ordinals see exactly the same partitions
(adaptive execution may coalesce one shuffle differently for two readers).

The ordering keys must form a total order (add a unique tie-breaker) for the
ordinal to be deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelens.plans import physical


def with_ordinal(df: DataFrame, order_by: list[Column | str], name: str = "rank", base: int = 1) -> DataFrame:
    cols = df.columns
    ordered = physical.materialize(
        df.orderBy(*order_by).select(
            *cols,
            F.spark_partition_id().alias("__pid"),
            F.monotonically_increasing_id().alias("__mid"),
        ),
        "ordinal",
    )
    counts = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per shuffle partition: bounded by the partition count.
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (
        ordered.join(F.broadcast(offsets), "__pid")
        .select(*cols, (F.col("__off") + local + F.lit(base)).cast("long").alias(name))
    )


def dense_ordinal(df: DataFrame, key: str, name: str, base: int = 0) -> DataFrame:
    """Ordinal of each distinct ``key`` value in ascending order (dense rank)."""
    return with_ordinal(df.select(key).distinct(), [F.col(key)], name, base)


# Entries (partition x segment) up to which the offsets are broadcast.
BROADCAST_OFFSETS = 200_000


def segmented_ordinal(
    df: DataFrame, segments: list[str], order_by: list[Column | str], name: str = "rank", base: int = 0, total: str | None = None
) -> DataFrame:
    """Ordinal of every row inside its segment, without a window per segment.

    One range sort by (segments, ordering keys) spreads a segment over as many
    partitions as its rows need, however hot it is.  Counts are taken for each
    (partition, segment); a running sum over the partitions of a segment gives
    its offsets, so the one window spans at most the number of partitions.  The
    offsets come back by an equi-join on (partition, segment), whose groups are
    as even as the sort's partitions.  Null segments count as a segment.
    ``total`` names a column for the segment's row count.
    """
    cols = df.columns
    ordered = physical.materialize(
        df.orderBy(*segments, *order_by).select(
            *cols, F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__mid")
        ),
        "ordinal",
    )
    per = ordered.groupBy("__pid", *segments).agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    whole = Window.partitionBy(*segments)
    earlier = whole.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(
        F.col("__pid").alias("__opid"),
        *[F.col(s).alias(f"__o{i}") for i, s in enumerate(segments)],
        "__first",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"),
        F.sum("__n").over(whole).alias("__total"),
    )
    offsets = physical.materialize(offsets, "offsets")
    if offsets.count() <= BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    same = ordered["__pid"] == offsets["__opid"]
    for i, s in enumerate(segments):
        same = same & ordered[s].eqNullSafe(offsets[f"__o{i}"])
    out = [*cols, (F.col("__off") + F.col("__mid") - F.col("__first") + F.lit(base)).cast("long").alias(name)]
    if total:
        out.append(F.col("__total").cast("long").alias(total))
    return ordered.join(offsets, same).select(*out)
