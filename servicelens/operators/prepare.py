"""Preparation: clean raw tables, merge, keep repair parts, add features.

Raw headers/positions arrive as all-string tables (``sources.csv``); the
typed forms have the columns of ``schema``:

* headers:   order_id, address_code, product_article, product_type, 7 dates
* positions: order_id, position, part_no, part_name, quantity (+ any extras)

Plan shape: stage durations and labour units are per *order*, so they are
computed on the header side (one row per order) before the header x position
join instead of once per position row.  The positions are read once: the lines
that are parts or labour are written, and the labour units and the part
lines both come from that table.  Headers, labour units and part lines are each
shuffled once, by ``order_id``, into as many partitions as the lines need, and
meet in hash joins: nothing is sorted (see ``prepare``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.functions import dates, scalar, workcal
from servicelens.plans import physical


# --------------------------------------------------------------------------
# L1 clean
# --------------------------------------------------------------------------

def clean_headers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw header strings -> (typed headers, quarantined rows).

    Rows with any missing cell are dropped, over *all* columns of the file
    (extra columns included).  Dates that match none of the formats become
    NULL, as in the original; rows where that happens are also reported in
    the quarantine frame with reason ``unparsed_date``, and addresses of more
    than two parts with ``bad_address`` (their parts become NULL, P4).
    """
    # one row of one struct: the cells are worked out here once, where a filter
    # on plain columns would work them out again, twice each, below the join they come from
    row = F.struct(*[scalar.na_to_null(F.col(c)).alias(c) for c in raw.columns])
    normalised = raw.select(F.inline(F.array(row))).na.drop("any")
    names = {k: v for k, v in S.HEADER_SOURCE_COLUMNS.items() if k in raw.columns}

    def typed_col(src: str) -> Column:
        name = names.get(src, src)
        if name == "address_code":
            return scalar.drop_third_char(F.col(src)).alias(name)
        if name in S.STAGE_DATES:
            return dates.parse_timestamp(F.col(src)).alias(name)
        return F.col(src).alias(name)

    typed = normalised.select(*[typed_col(c) for c in raw.columns])
    bad = F.lit(False)
    for c in S.STAGE_DATES:
        bad = bad | F.col(c).isNull()
    reasons = F.array_compact(
        F.array(
            F.when(bad, "unparsed_date"),
            F.when(F.size(scalar.address_parts(F.col("address_code"))) > 2, "bad_address"),
        )
    )
    # each row with a reason appears once per reason
    quarantine = typed.withColumn("reject_reason", F.explode(reasons))
    return typed, quarantine


def clean_positions(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw position strings -> (typed positions, quarantined rows).

    A quantity that is not a decimal number raises in the original, and a
    position that is no number cannot be sorted by; here the row moves to the
    quarantine frame with reason ``bad_quantity`` or ``bad_position``.
    """
    normalised = raw.select(*[scalar.na_to_null(F.col(c)).alias(c) for c in raw.columns]).na.drop("any")
    names = {k: v for k, v in S.POSITION_SOURCE_COLUMNS.items() if k in raw.columns}
    typed = normalised.select(*[F.col(c).alias(names.get(c, c)) for c in raw.columns]).withColumns(
        {
            "position": F.trim("position").try_cast("int"),
            "quantity": scalar.decimal_comma(F.col("quantity_raw")),
        }
    )
    ok = F.col("quantity").isNotNull() & F.col("position").isNotNull()
    good = typed.where(ok).drop("quantity_raw")
    reason = F.when(F.col("quantity").isNull(), "bad_quantity").otherwise("bad_position")
    quarantine = typed.where(~ok).withColumn("reject_reason", reason)
    return good, quarantine


# --------------------------------------------------------------------------
# L2 merge, L3 filter
# --------------------------------------------------------------------------

def merge(headers: DataFrame, positions: DataFrame) -> DataFrame:
    """Header x position inner equi-join on the order (J1); the headers, few next to
    their positions, are the build side, so neither side is sorted."""
    return headers.hint("shuffle_hash").join(positions, "order_id", "inner")


def keep_repair_parts(merged: DataFrame, prefix: str = S.PART_PREFIX) -> DataFrame:
    """Keep part articles (F2), then drop parts that are also product
    articles of the surviving rows (F3, anti join).

    The merged part rows are written once, so that the article set and the
    result read the same rows, and so is the set, whose size decides whether it
    is broadcast.
    """
    kept = physical.materialize(merged.where(F.col("part_no").startswith(prefix)), "merged")
    products = physical.materialize(kept.select(F.col("product_article").alias("part_no")).distinct(), "products")
    return kept.join(physical.lookup(products), "part_no", "left_anti")


# --------------------------------------------------------------------------
# L5 features
# --------------------------------------------------------------------------

def split_address(headers: DataFrame) -> DataFrame:
    """Customer number and contact from the cleaned address code.

    More than two dot-separated parts is an error in the original; such rows
    get NULLs here and ``address_ok = false``.
    """
    parts = scalar.address_parts(F.col("address_code"))
    ok = F.size(parts) <= 2
    return headers.withColumns(
        {
            "customer_no": F.when(ok, F.get(parts, 0)),
            "contact_no": F.when(ok, F.get(parts, 1)),
            "address_ok": ok,
        }
    )


def header_features(headers: DataFrame, years: DataFrame) -> DataFrame:
    """Per-order features: address split and stage durations."""
    return workcal.with_stage_durations(split_address(headers), years)


# Part and labour lines of a partition of the order joins: their orders are the
# build side of the hash joins and must fit a task's memory.
LINES_A_PARTITION = 1_000_000


def labour_per_order(lines: DataFrame, codes=S.LABOUR_CODES) -> DataFrame:
    """Labour units of the orders that have labour lines.

    One hash aggregate over the labour lines only, in the partitions of ``lines``.
    """
    return lines.where(F.col("part_no").isin(*codes)).groupBy("order_id").agg(F.sum("quantity").alias("labour_units"))


def prepare(
    headers: DataFrame,
    positions: DataFrame,
    years: DataFrame | None,
    prefix: str = S.PART_PREFIX,
    labour_codes=S.LABOUR_CODES,
) -> DataFrame:
    """Featured part rows (L3 + L5): one row per surviving part position with
    the header columns, customer/contact, six stage durations, lead time and
    labour units of the order (J2, left join).  ``years=None`` skips the
    address split and calendar features (parts with header columns and
    labour units only).

    Plan: the part and labour lines of the positions are written once to the
    checkpoint folder; their number gives the number of partitions of all order
    joins.  The product-article set of F3 comes from order keys and articles
    alone (headers with a repair part, a semi join).  Headers are shuffled by
    ``order_id`` as they come; the labour units of the order, the durations
    and the part lines are added in that same stage, so the wide rows are
    neither shuffled nor sorted before they are written.  The size of the article
    set decides whether it is broadcast to the part lines.
    """
    is_part = F.col("part_no").startswith(prefix)
    lines = physical.materialize(positions.where(is_part | F.col("part_no").isin(*labour_codes)), "lines")
    n = max(lines.sparkSession.sparkContext.defaultParallelism, -(-lines.count() // LINES_A_PARTITION))

    def by_order(df: DataFrame) -> DataFrame:
        return df.repartition(n, "order_id")

    part_lines = lines.where(is_part)
    with_part = by_order(part_lines.select("order_id")).hint("shuffle_hash")
    articles = by_order(headers.select("order_id", F.col("product_article").alias("part_no")))
    products = physical.materialize(articles.join(with_part, "order_id", "left_semi").select("part_no").distinct(), "products")
    labour = labour_per_order(by_order(lines.select("order_id", "part_no", "quantity").where(F.col("part_no").isin(*labour_codes))), labour_codes)
    h = by_order(headers).join(labour.hint("shuffle_hash"), "order_id", "left")
    if years is not None:
        h = header_features(h, years)
    return h.hint("shuffle_hash").join(by_order(part_lines.join(physical.lookup(products), "part_no", "left_anti")), "order_id", "inner")
