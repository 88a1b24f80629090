"""Plan-shaping helpers: reliable materialisation, lookup tables of any size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens.session import remove_scratch, scratch_path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executions inside remove their shuffle files as they end; otherwise these stay
    until the driver happens to collect its garbage.  The setting is put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in a fresh folder under the shared
    checkpoint folder (``spark.checkpoint.dir``) and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation
    of everything upstream) with one write; the re-read gets column pruning,
    filter pushdown and real size statistics for the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if partition_by:
        # one task's worth of a folder per file; a folder larger than that is split
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    # the write is an execution of its own: nothing else reads its shuffles
    with shuffles_removed(spark):
        w.parquet(path)
    out = spark.read.parquet(path)
    return out.select(*df.columns) if partition_by else out


# Rows of a lookup table up to which every executor gets a copy.
BROADCAST_ROWS = 2_000_000


def lookup(df: DataFrame) -> DataFrame:
    """``df`` as the build side of a hash join with a much larger table: broadcast
    while it is small, beyond that shuffled.  Neither way sorts the larger side."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("shuffle_hash")


def discard(*tables: DataFrame) -> None:
    """Remove materialised tables that nothing reads any more: the caller has
    written or counted everything that was made from them."""
    for df in tables:
        folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
        remove_scratch(df.sparkSession, folders)
