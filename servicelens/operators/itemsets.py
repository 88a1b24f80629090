"""Frequent itemsets of many groups in one level-wise pass.

Baskets are numbered inside their group, and every frequent item gets bitmaps:
for each bucket of 32,768 neighbouring baskets one bitmap of those that hold
the item.  An itemset's bitmap is the AND of two of its subsets' bitmaps, its
count the sum of the set bits.  Each level is one shuffle for all groups:
candidates are grown by joining itemsets with equal prefixes, those with an
infrequent subset are dropped, and the rest are counted.

An item in half of all baskets weighs no more than any other: work is keyed by
(group, itemset, bucket), and a bucket's bitmap has the same size whatever
the number of its baskets.  FP-growth instead gives one task all the
baskets of a hot item, and takes a single count threshold, which the
smallest group would set for all of them; here every group has its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.operators.ordinal import segmented_ordinal
from servicelens.plans import physical

BROADCAST_ROWS = 100_000  # itemsets of a level up to which they are broadcast


def _checked(df: DataFrame) -> DataFrame:
    """``df`` (a written table) marked for broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _candidates(level: DataFrame, by: list[str], size: int) -> DataFrame:
    """(by, items, halves) of ``size`` items whose subsets of one item less are
    all in ``level``; ``halves`` are the two that it was grown from."""
    prefix = F.slice("items", 1, size - 2)
    left = level.select(*by, prefix.alias("__prefix"), F.col("items").alias("a"))
    right = level.select(*by, prefix.alias("__prefix"), F.col("items").alias("b"))
    grown = left.join(right, [*by, "__prefix"]).where(F.element_at("a", -1) < F.element_at("b", -1))
    grown = grown.select(*by, F.concat("a", F.slice("b", -1, 1)).alias("items"), F.array("a", "b").alias("halves"))
    if size == 2:
        return grown
    without = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.filter("items", lambda x, at: at != i))
    subsets = grown.select(*by, "items", "halves", F.explode(without).alias("__subset"))
    known = level.select(*by, F.col("items").alias("__subset"))
    whole = subsets.join(known, [*by, "__subset"], "left_semi").groupBy(*by, "items", "halves").agg(F.count(F.lit(1)).alias("__n"))
    return whole.where(F.col("__n") == size).drop("__n")


def _with_support(counts: DataFrame, totals: DataFrame, by: list[str], min_support: float) -> DataFrame:
    """Itemsets of ``counts`` (by, items, freq) that are frequent in their group."""
    both = counts.join(totals, by)
    support = F.col("freq").cast("double") / F.col("n_baskets").cast("double")
    return both.select(*by, "items", "freq", support.alias("support"), "n_baskets").where(F.col("support") >= F.lit(min_support))


def frequent_itemsets_by(baskets: DataFrame, min_support: float, by: list[str]) -> DataFrame:
    """Itemsets whose share of their own group's baskets is at least
    ``min_support``.

    ``baskets`` holds the ``by`` columns, order_id and items (distinct, no
    nulls).  Columns: by, items (sorted array), size, freq, support, n_baskets.
    """
    numbered = segmented_ordinal(baskets.select(*by, "order_id", "items"), by, ["order_id"], "__basket", base=1, total="n_baskets")
    numbered = physical.materialize(numbered, "numbered-baskets")
    totals = physical.materialize(numbered.groupBy(*by).agg(F.max("n_baskets").alias("n_baskets")), "basket-counts")
    totals = _checked(totals)
    held = numbered.select(*by, "__basket", F.explode("items").alias("__item"))
    counts = held.groupBy(*by, "__item").agg(F.count(F.lit(1)).alias("freq"))
    counts = counts.select(*by, F.array("__item").alias("items"), "freq")
    level = physical.materialize(_with_support(counts, totals, by, min_support), "itemsets")
    frequent = _checked(level.select(*by, F.col("items")[0].alias("__item")))
    bitmaps = held.join(frequent, [*by, "__item"]).groupBy(*by, "__item", F.bitmap_bucket_number("__basket").alias("__bucket"))
    bitmaps = bitmaps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("__basket")).alias("__bits"))
    bitmaps = physical.materialize(bitmaps.select(*by, F.array("__item").alias("items"), "__bucket", "__bits"), "bitmaps")
    found, size = level, 1
    while True:
        size += 1
        candidates = physical.materialize(_candidates(level, by, size), "candidates")
        if candidates.isEmpty():
            break
        halves = candidates.select(*by, F.col("items").alias("__whole"), F.explode("halves").alias("items"))
        both = bitmaps.join(_checked(halves), [*by, "items"]).groupBy(*by, "__whole", "__bucket")
        # a bucket counts where both halves have baskets
        both = both.agg(F.count(F.lit(1)).alias("__n"), F.bitmap_and_agg("__bits").alias("__bits")).where(F.col("__n") == 2)
        both = both.select(*by, F.col("__whole").alias("items"), "__bucket", "__bits", F.bitmap_count("__bits").alias("__k"))
        grown = physical.materialize(both.where(F.col("__k") > 0), "bitmaps")
        counts = grown.groupBy(*by, "items").agg(F.sum("__k").cast("long").alias("freq"))
        level = physical.materialize(_with_support(counts, totals, by, min_support), "itemsets")
        if level.isEmpty():
            break
        bitmaps = grown.join(level.select(*by, "items"), [*by, "items"], "left_semi").drop("__k")
        found = found.unionByName(level)
    return found.select(*by, "items", F.size("items").alias("size"), "freq", "support", "n_baskets")
