"""Parts replaced together: baskets, frequent itemsets, association rules
with multi-item consequents, watch-list filter, rule graph and Sankey tables
(R5, M1-M6, F7, P10, J7).

Itemsets of one type come from MLlib's parallel FP-growth, those of all types
at once from ``itemsets.frequent_itemsets_by``.  MLlib's own rule generator
only emits single-item consequents, so rules are generated here, by splitting
itemsets into (antecedent, consequent) pairs and looking the subset supports
up in the itemset table (every subset of a frequent itemset is frequent, so
the joins never miss).  With a threshold on the confidence, consequents grow
level by level: moving items to the consequent can only lower a rule's
confidence, so a consequent is grown only from consequents that held.  For the
other metrics, which have no such order, every split is enumerated by bit masks.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.functions.scalar import itemset_label, round2
from servicelens.operators.itemsets import frequent_itemsets_by
from servicelens.operators.ordinal import dense_ordinal
from servicelens.plans import physical

METRICS = ("support", "confidence", "lift", "leverage", "conviction", "zhang")

# Split masks are generated in chunks so no single row carries a huge array.
MASK_CHUNK = 4096


def baskets(parts: DataFrame, item_col: str = "part_no", by: tuple[str, ...] = ()) -> DataFrame:
    """One basket per order (of each group of ``by``): sorted distinct items.

    ``collect_set`` aggregates map-side first, so a hot order contributes at
    most its distinct items per task; a basket is bounded by the item
    vocabulary, never by the number of order lines.
    """
    return (
        parts.where(F.col(item_col).isNotNull())
        .groupBy(*by, "order_id")
        .agg(F.array_sort(F.collect_set(F.col(item_col))).alias("items"))
    )


def frequent_itemsets(basket_df: DataFrame, min_support: float, num_partitions: int | None = None) -> DataFrame:
    """Itemsets with support >= ``min_support`` (M2).

    Columns: items (sorted array), size, freq, support, n_baskets.

    The baskets are written once (FP-growth passes over them several times)
    and so is the itemset table: MLlib returns it backed by an unpersisted
    RDD, and rule generation reads it three times.
    """
    items = physical.materialize(basket_df.select("items"), "baskets")
    n = items.count()
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(items)
    sets = model.freqItemsets.select(
        F.array_sort("items").alias("items"),
        F.size("items").alias("size"),
        F.col("freq").cast("long").alias("freq"),
        (F.col("freq").cast("double") / F.lit(float(n))).alias("support"),
        F.lit(n).cast("long").alias("n_baskets"),
    )
    # FP-growth's integer count threshold equals the support threshold; keep
    # the float comparison as the definition.
    return physical.materialize(sets.where(F.col("support") >= F.lit(min_support)), "itemsets")


def _split(items: Column, mask: Column, bit: int) -> Column:
    # Item i goes to the antecedent when bit i of the mask is set.
    return F.filter(items, lambda x, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1)) == F.lit(bit))


def rule_metrics(rules: DataFrame) -> DataFrame:
    """Add confidence, lift, leverage, conviction and Zhang's metric from the
    three supports (M4).  Conviction is +Infinity at confidence 1."""
    s, sa, sc = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    conf = s / sa
    leverage = s - sa * sc
    denom = F.greatest(s * (F.lit(1.0) - sa), sa * (sc - s))
    return rules.select(
        "*",
        conf.alias("confidence"),
        (conf / sc).alias("lift"),
        leverage.alias("leverage"),
        F.when(conf == F.lit(1.0), F.lit(float("inf")))
        .otherwise((F.lit(1.0) - sc) / (F.lit(1.0) - conf))
        .alias("conviction"),
        F.when(denom == F.lit(0.0), F.lit(0.0)).otherwise(leverage / denom).alias("zhang"),
    )


def _every_split(itemsets: DataFrame, by: list[str]) -> DataFrame:
    """(by, antecedents, consequents, support) of every split, by bit masks."""
    multi = itemsets.where(F.col("size") >= 2).select(*by, "items", "size", "support")
    total = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("size")) - 2  # proper, non-empty subsets
    chunked = multi.select(
        *by, "items", "support", total.alias("__total"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((total - 1) / MASK_CHUNK).cast("long"))).alias("__chunk"),
    )
    lo = F.col("__chunk") * MASK_CHUNK + 1
    hi = F.least((F.col("__chunk") + 1) * MASK_CHUNK, F.col("__total"))
    masks = chunked.select(*by, "items", "support", F.explode(F.sequence(lo, hi)).alias("__mask"))
    return masks.select(
        *by,
        _split(F.col("items"), F.col("__mask"), 1).alias("antecedents"),
        _split(F.col("items"), F.col("__mask"), 0).alias("consequents"),
        "support",
    )


def _with_antecedents(splits: DataFrame, itemsets: DataFrame, by: list[str]) -> DataFrame:
    known = itemsets.select(*by, F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    return splits.join(known, [*by, "antecedents"])


def consequent_levels(itemsets: DataFrame, min_confidence: float, by: tuple[str, ...] = (), generated: list[int] | None = None) -> list[DataFrame]:
    """Splits of every itemset with confidence >= ``min_confidence``, one
    written table for each consequent size (M3, M4).

    A consequent of m items comes from two held consequents of the same
    itemset that share their first m - 1 items but the last; that all
    its subsets hold too is left to the confidence test.  Columns: by, items,
    antecedents, consequents, antecedent_support, support.  ``generated``
    receives the number of splits that each level tested.
    """
    by = list(by)
    multi = itemsets.where(F.col("size") >= 2).select(*by, "items", "support")
    splits = multi.select(*by, "items", "support", F.explode("items").alias("__one"))
    splits = splits.select(*by, "items", "support", F.array("__one").alias("consequents"))
    levels, size = [], 1
    while True:
        splits = splits.withColumn("antecedents", F.array_except("items", "consequents"))
        if generated is not None:
            generated.append(splits.count())
        tested = _with_antecedents(splits, itemsets, by).where(F.col("support") / F.col("antecedent_support") >= F.lit(min_confidence))
        held = physical.materialize(tested, "consequents")
        if held.isEmpty():
            return levels
        levels.append(held)
        size += 1
        prefix = F.slice("consequents", 1, size - 2)
        # something must stay in the antecedent
        left = held.where(F.size("items") > size).select(*by, "items", "support", prefix.alias("__prefix"), F.col("consequents").alias("a"))
        right = held.select(*by, "items", prefix.alias("__prefix"), F.col("consequents").alias("b"))
        grown = left.join(right, [*by, "items", "__prefix"]).where(F.element_at("a", -1) < F.element_at("b", -1))
        splits = grown.select(*by, "items", "support", F.concat("a", F.slice("b", -1, 1)).alias("consequents"))


def association_rules(
    itemsets: DataFrame, metric: str = S.DEFAULT_METRIC, min_threshold: float = S.DEFAULT_MIN_THRESHOLD, by: tuple[str, ...] = ()
) -> DataFrame:
    """Every rule A -> C with A, C non-empty, disjoint, A u C frequent, and
    ``metric >= min_threshold`` (M3, M4), inside each group of ``by``.

    Columns: by, antecedents, consequents (sorted arrays), antecedent_support,
    consequent_support, support, confidence, lift, leverage, conviction, zhang.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    by = list(by)
    columns = [*by, "antecedents", "consequents", "antecedent_support", "support"]
    if metric == "confidence":
        levels = consequent_levels(itemsets, min_threshold, by)
        none = _with_antecedents(_every_split(itemsets.limit(0), by), itemsets, by)
        splits = (levels or [none])[0].select(*columns)
        for level in levels[1:]:
            splits = splits.unionByName(level.select(*columns))
    else:
        splits = _with_antecedents(_every_split(itemsets, by), itemsets, by).select(*columns)
    cons = itemsets.select(*by, F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    rules = splits.join(cons, [*by, "consequents"]).select(
        *by, "antecedents", "consequents", "antecedent_support", "consequent_support", "support"
    )
    return rule_metrics(rules).where(F.col(metric) >= F.lit(min_threshold))


def watched_rules(rules: DataFrame, watch=S.WATCH_ITEMS) -> DataFrame:
    """Rules with a watched item on both sides."""
    w = F.array(*[F.lit(x) for x in watch])
    return rules.where(F.arrays_overlap("antecedents", w) & F.arrays_overlap("consequents", w))


def component_associations(
    parts: DataFrame,
    product_type: str | None,
    min_support: float = S.DEFAULT_MIN_SUPPORT,
    metric: str = S.DEFAULT_METRIC,
    min_threshold: float = S.DEFAULT_MIN_THRESHOLD,
    watch=S.WATCH_ITEMS,
    item_col: str = "part_no",
) -> tuple[DataFrame, DataFrame]:
    """Type filter -> baskets -> itemsets -> rules -> watch filter (M1).

    ``product_type=None`` mines all types in one pass (F4): itemsets and rules
    then have a ``product_type`` column, and supports refer to a type's own baskets."""
    if product_type is None:
        by = ("product_type",)
        sets = physical.materialize(frequent_itemsets_by(baskets(parts, item_col, by), min_support, list(by)), "itemsets")
        rules = association_rules(sets, metric, min_threshold, by)
        return sets, watched_rules(rules, watch) if watch is not None else rules
    typed = parts.where(F.col("product_type") == F.lit(product_type))
    sets = frequent_itemsets(baskets(typed, item_col), min_support)
    rules = association_rules(sets, metric, min_threshold)
    return sets, watched_rules(rules, watch) if watch is not None else rules


def with_labels(rules: DataFrame, joiner: str = S.ITEM_JOINER) -> DataFrame:
    """Antecedent / consequent labels (P10)."""
    return rules.withColumns(
        {
            "antecedent": itemset_label(F.col("antecedents"), joiner),
            "consequent": itemset_label(F.col("consequents"), joiner),
        }
    )


def rule_edges(rules: DataFrame) -> DataFrame:
    """Rule graph edges: (source label, target label, confidence) (M5)."""
    return with_labels(rules).select(
        F.col("antecedent").alias("source"), F.col("consequent").alias("target"), "confidence"
    )


def sankey_nodes(rules: DataFrame) -> DataFrame:
    """Sankey nodes (M6): antecedent labels get ids 0..a-1 in label order,
    consequent labels a..a+c-1; a label on both sides appears twice."""
    lab = with_labels(rules)
    a = dense_ordinal(lab.select(F.col("antecedent").alias("label")), "label", "node_id", 0)
    c = dense_ordinal(lab.select(F.col("consequent").alias("label")), "label", "node_id", 0)
    n_a = a.agg(F.count(F.lit(1)).alias("__na"))
    c = c.crossJoin(F.broadcast(n_a)).select((F.col("node_id") + F.col("__na")).alias("node_id"), "label")
    return a.select("node_id", "label", F.lit("antecedent").alias("side")).unionByName(
        c.select("node_id", "label", F.lit("consequent").alias("side"))
    )


def sankey_links(rules: DataFrame, nodes: DataFrame | None = None, digits: int | None = 2) -> DataFrame:
    """Sankey links (M6, J7): source id, target id, value = confidence in %,
    rounded (P8; ``digits=None`` keeps full precision)."""
    nodes = nodes if nodes is not None else sankey_nodes(rules)
    lab = with_labels(rules)
    src = nodes.where(F.col("side") == "antecedent").select(F.col("label").alias("antecedent"), F.col("node_id").alias("source_id"))
    dst = nodes.where(F.col("side") == "consequent").select(F.col("label").alias("consequent"), F.col("node_id").alias("target_id"))
    return lab.join(src, "antecedent").join(dst, "consequent").select(
        "source_id", "target_id", round2(F.col("confidence") * F.lit(100.0), digits).alias("value"), "antecedent", "consequent"
    )
