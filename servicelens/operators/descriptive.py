"""Descriptive KPIs: stage times, labour, part consumption.

All operators take the featured part rows from ``prepare.prepare`` and a
report period on the goods-out date.  ``product_type=None`` gives the grouped
form (every type in one pass) instead of one type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.functions import dates, scalar, workcal
from servicelens.operators.ordinal import with_ordinal

PERIOD_COLUMN = "d_goods_out"


def select_rows(featured: DataFrame, product_type, start, end, date_col: str = PERIOD_COLUMN) -> DataFrame:
    """Period filter (F5) plus product-type filter (F4) when a type is given."""
    df = dates.period_filter(featured, date_col, start, end)
    if product_type is not None:
        df = df.where(F.col("product_type") == F.lit(product_type))
    return df


def first_row_per_order(df: DataFrame, cols, keep=("product_type",)) -> DataFrame:
    """One row per order and kept column: the first by (position, goods-in
    date, part), ties by the values themselves (W1).  An order under two
    product types has a row in each of them.

    A hash aggregate (``min_by`` over a struct) rather than a window sort: the
    map side keeps one candidate per order and task, so a hot order stays cheap.
    """
    keep = [c for c in keep if c in df.columns and c not in cols]
    pick = F.min_by(F.struct(*cols), F.struct("position", "d_goods_in", "part_no", *cols))
    return df.groupBy("order_id", *keep).agg(pick.alias("__r")).select("order_id", *keep, "__r.*")


def _period_columns(start, end):
    return [
        F.lit(dates.parse_arg_date(start)).alias("start_date"),
        F.lit(dates.parse_arg_date(end)).alias("end_date"),
    ]


def time_analysis(
    featured: DataFrame, product_type, start, end, digits: int | None = 2
) -> DataFrame:
    """Mean working days per order for lead time and each stage.

    Mean = sum / number of orders, a missing duration counting as 0 (A3).
    One row per type (one row even for a type without orders: NULL means).
    """
    per_order = first_row_per_order(select_rows(featured, product_type, start, end), S.DURATION_COLUMNS)
    n = F.count(F.lit(1))
    aggs = [n.cast("long").alias("n_orders")] + [
        scalar.round2(F.try_divide(F.coalesce(F.sum(c), F.lit(0)).cast("double"), n), digits).alias(f"{c}_avg")
        for c in S.DURATION_COLUMNS
    ]
    if product_type is None:
        out = per_order.groupBy("product_type").agg(*aggs)
    else:
        out = per_order.agg(*aggs).withColumn("product_type", F.lit(product_type))
    return out.select(*_period_columns(start, end), "product_type", "n_orders", *[f"{c}_avg" for c in S.DURATION_COLUMNS])


def time_waterfall(times: DataFrame, include_total: bool = True) -> DataFrame:
    """KPI row -> one bar per stage with its start offset.

    The lead time is the first bar, so stage bars start after it, as in the
    original chart; ``include_total=False`` drops it.
    """
    stages = S.DURATION_COLUMNS if include_total else S.STAGE_DURATIONS
    long = times.unpivot(
        ["product_type"], [f"{c}_avg" for c in stages], "stage", "days"
    ).withColumn("stage", F.regexp_replace("stage", "_avg$", ""))
    order = F.array(*[F.lit(c) for c in stages])
    long = long.withColumn("stage_ord", (F.array_position(order, F.col("stage")) - 1).cast("int"))
    # Window per type over at most seven rows.
    w = Window.partitionBy("product_type").orderBy("stage_ord").rowsBetween(Window.unboundedPreceding, -1)
    return long.select(
        "product_type", "stage_ord", "stage", "days",
        F.coalesce(F.sum("days").over(w), F.lit(0.0)).alias("bar_start"),
    )


def order_figures(featured: DataFrame, product_type, start, end, years: DataFrame, digits: int | None = 2) -> DataFrame:
    """The order-level figures, one row per product type: order count, total
    labour units, labour units per order, and order cycle (working days of the
    period / orders)."""
    rows = select_rows(featured, product_type, start, end)
    group = ["product_type"] if product_type is None else []
    per_order = first_row_per_order(rows, ["labour_units"])
    scalars = per_order.groupBy(*group).agg(
        F.count(F.lit(1)).cast("long").alias("n_orders"),
        F.coalesce(F.sum("labour_units"), F.lit(0.0)).cast("double").alias("total_labour_units"),
    )
    spark = featured.sparkSession
    period_wd = workcal.working_days_between(
        spark, dates.parse_arg_date(start), dates.parse_arg_date(end), years
    )
    return scalars.crossJoin(F.broadcast(period_wd)).select(
        (F.col("product_type") if group else F.lit(product_type)).alias("product_type"),
        "n_orders",
        "total_labour_units",
        scalar.round2(F.try_divide(F.col("total_labour_units"), F.col("n_orders")), digits).alias("labour_units_per_order"),
        scalar.round2(F.try_divide(F.col("wd").cast("double"), F.col("n_orders")), digits).alias("order_cycle"),
    )


def part_totals(featured: DataFrame, product_type, start, end) -> DataFrame:
    """Total quantity per part, without the first-seen numbering."""
    rows = select_rows(featured, product_type, start, end)
    return rows.groupBy("product_type", "part_no").agg(
        F.min_by("part_name", F.struct("order_id", "position", "part_name")).alias("part_name"),
        F.sum("quantity").cast("double").alias("total_part_qty"),
    )


def process_analysis(
    featured: DataFrame,
    product_type,
    start,
    end,
    years: DataFrame,
    digits: int | None = 2,
) -> DataFrame:
    """Labour and part consumption per part of a product type.

    The order-level figures are one row per type, joined to every part row;
    the per-part figures come from one hash aggregate over the part rows.
    ``part_seq`` numbers the parts in first-seen order (first order, then
    position), the row order of the original table.
    """
    rows = select_rows(featured, product_type, start, end)
    group = ["product_type"] if product_type is None else []
    scalars = order_figures(featured, product_type, start, end, years, digits)
    if not group:
        scalars = scalars.drop("product_type")
    parts = rows.groupBy(*group, "part_no").agg(
        F.min_by("part_name", F.struct("order_id", "position", "part_name")).alias("part_name"),
        F.sum("quantity").cast("double").alias("total_part_qty"),
        F.min(F.struct("order_id", "position")).alias("__first"),
    )
    # Parts numbered in first-seen order (by their first order line).
    parts = with_ordinal(
        parts, [*[F.col(g) for g in group], F.col("__first"), F.col("part_no")], "part_seq"
    ).drop("__first")
    joined = (
        parts.join(scalars, group, "inner") if group else parts.crossJoin(F.broadcast(scalars))
    )
    return joined.select(
        *_period_columns(start, end),
        (F.col("product_type") if group else F.lit(product_type)).alias("product_type"),
        "n_orders",
        "total_labour_units",
        "labour_units_per_order",
        "order_cycle",
        "part_seq",
        "part_no",
        "part_name",
        "total_part_qty",
        scalar.round2(F.try_divide(F.col("total_part_qty"), F.col("n_orders")), digits).alias("part_qty_per_order"),
    )


def part_ranking(process: DataFrame) -> DataFrame:
    """Parts (of ``process_analysis`` or ``part_totals``) by total quantity, descending, with a global rank (O2)."""
    return with_ordinal(
        process.select("product_type", "part_no", "part_name", "total_part_qty"),
        [F.col("total_part_qty").desc(), F.col("product_type"), F.col("part_no")],
        "rank",
    )


KEY_FIGURES = ["n_orders", "total_labour_units", "labour_units_per_order", "order_cycle"]


def key_figures(process: DataFrame) -> DataFrame:
    """The four order-level figures, one row each (R2); takes ``order_figures``
    or, as the original did, the rows of ``process_analysis``."""
    one = process.select("product_type", *[F.col(c).cast("double").alias(c) for c in KEY_FIGURES]).dropDuplicates(
        ["product_type"]
    )
    order = F.array(*[F.lit(c) for c in KEY_FIGURES])
    return one.unpivot(["product_type"], KEY_FIGURES, "figure", "value").withColumn(
        "figure_ord", (F.array_position(order, F.col("figure")) - 1).cast("int")
    )
