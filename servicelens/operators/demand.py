"""Monthly part demand and sliding-window training samples.

type/period filter -> month bucket (T6) -> monthly sum per part (A10) ->
share of the grand total (A12) -> exact 0.9 quantile of the shares (A11) ->
top contributors (F8) -> their monthly rows (F9) -> gap-free month grid (R4,
T8) -> 12-months-in / next-month-out samples (W3) -> chronological 80/20
split (W4).  The wide part x month matrix (R3) is only built on request.

Everything stays in long form (month, part, qty): the grid is generated per
part from the global month bounds, samples come from a window per part
(bounded by the number of months), and sample indexes are month arithmetic,
so no step gathers all parts or all months into one task.

Every function takes ``by`` columns (F4): with ``by=("product_type",)`` all
types are treated at once, each with its own shares, quantile, month bounds and
split.  Group totals, quantiles and bounds are one row a group and
come back by an equi-join; quantiles come from counts by digits of all groups at
once (``selection``), so a group with a third of all parts is no heavier
for any task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.functions.dates import month_start, parse_arg_date
from servicelens.operators.selection import exact_quantile
from servicelens.plans import physical


def _with_group_rows(df: DataFrame, rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``df`` with the columns of ``rows``, which has one row a group (one in
    all without ``by``); whether it is broadcast follows from its size."""
    return df.join(rows, list(by)) if by else df.crossJoin(F.broadcast(rows))


def monthly_demand(
    rows: DataFrame, date_col: str = "d_goods_out", part_col: str = "part_no", by: tuple[str, ...] = ()
) -> DataFrame:
    """Quantity per (month, part) (T6, A10).  ``month`` is the first day."""
    return rows.groupBy(*by, month_start(F.col(date_col)).alias("month"), F.col(part_col).alias("part_no")).agg(
        F.sum("quantity").cast("double").alias("qty")
    )


def part_share(monthly: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Total quantity per part and its share of the (group's) grand total."""
    totals = monthly.groupBy(*by, "part_no").agg(F.sum("qty").alias("total_qty"))
    grand = totals.groupBy(*by).agg(F.sum("total_qty").alias("grand_qty"))
    return _with_group_rows(totals, grand, by).select(
        *by, "part_no", "total_qty", F.try_divide(F.col("total_qty"), F.col("grand_qty")).alias("share")
    )


def top_contributors(shares: DataFrame, q: float = S.DEFAULT_QUANTILE, by: tuple[str, ...] = ()) -> DataFrame:
    """Parts whose share is at least the ``q`` quantile of all shares (of their group) (F8)."""
    threshold = exact_quantile(shares, "share", q, by)
    return _with_group_rows(shares, threshold, by).where(F.col("share") >= F.col("quantile")).withColumnRenamed(
        "quantile", "threshold"
    )


def selected_monthly(monthly: DataFrame, top: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Monthly rows of the selected parts (F9, semi join)."""
    return monthly.join(top.select(*by, "part_no"), [*by, "part_no"], "left_semi")


def fill_months(selected: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Gap-free grid: every selected part x every month between the first and
    last month of the selected rows (of its group), missing cells 0 (R4, T8).

    The month bounds are one row a group; each part row expands to its months with a
    generator, then the observed quantities are left-joined on (part, month).
    """
    bounds = selected.groupBy(*by).agg(F.min("month").alias("m0"), F.max("month").alias("m1"))
    parts = selected.select(*by, "part_no").distinct()
    grid = _with_group_rows(parts, bounds, by).select(
        *by, "part_no", F.explode(F.sequence("m0", "m1", F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    return grid.join(selected, [*by, "part_no", "month"], "left").select(
        *by, "month", "part_no", F.coalesce(F.col("qty"), F.lit(0.0)).alias("qty")
    )


def period_months(start, end) -> list[str]:
    """The months (yyyy-MM) from ``start`` to ``end``, both included."""
    a, b = parse_arg_date(start), parse_arg_date(end)
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(a.year * 12 + a.month - 1, b.year * 12 + b.month)]


def demand_pivot(filled: DataFrame, start, end) -> DataFrame:
    """Wide part x month matrix (R3): one row per part, one column per month
    of the period, so the columns follow from the arguments and the parts
    stay rows, however many they are."""
    month = F.date_format("month", "yyyy-MM")
    wide = filled.select("part_no", month.alias("month"), "qty").groupBy("part_no").pivot("month", period_months(start, end))
    return wide.agg(F.first("qty")).na.fill(0.0)


def demand_matrix(monthly: DataFrame, parts: list[str]) -> DataFrame:
    """Month x part matrix (R3) over a given part list: one row per month from
    the first to the last with any of the parts, one column per part, missing
    cells 0.  The columns follow from the argument."""
    chosen = monthly.where(F.col("part_no").isin(*parts))
    bounds = chosen.agg(F.min("month").alias("m0"), F.max("month").alias("m1")).where("m0 is not null")
    months = bounds.select(F.explode(F.sequence("m0", "m1", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    wide = chosen.groupBy("month").pivot("part_no", list(parts)).agg(F.sum("qty"))
    return months.join(wide, "month", "left").na.fill(0.0, list(parts))


def sequences(
    filled: DataFrame,
    length: int = S.DEFAULT_SEQUENCE_LENGTH,
    train_fraction: float = S.DEFAULT_TRAIN_FRACTION,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Sliding samples: the ``length`` previous months in, this month out (W3),
    with a chronological train/validation split (W4) over the months (of the group).

    sample_idx = months since the first month - length; n samples = months -
    length; train when sample_idx < floor(train_fraction * n).  Columns:
    part_no, target_month, sample_idx, split, inputs (array, oldest first),
    target.
    """
    w = Window.partitionBy(*by, "part_no").orderBy("month").rowsBetween(-length, -1)
    bounds = filled.groupBy(*by).agg(F.min("month").alias("m0"), F.max("month").alias("m1"))
    n_months = F.months_between("m1", "m0").cast("long") + 1
    samples = filled.select(*by, "part_no", "month", "qty", F.collect_list("qty").over(w).alias("inputs")).where(
        F.size("inputs") == length
    )
    idx = F.months_between(F.col("month"), F.col("m0")).cast("long") - length
    n_samples = n_months - length
    return _with_group_rows(samples, bounds, by).select(
        *by,
        "part_no",
        F.col("month").alias("target_month"),
        idx.alias("sample_idx"),
        F.when(idx < F.floor(n_samples * F.lit(train_fraction)), F.lit("train")).otherwise(F.lit("validation")).alias("split"),
        "inputs",
        F.col("qty").alias("target"),
    )


def demand_dataset(
    rows: DataFrame, q: float = S.DEFAULT_QUANTILE, length: int = S.DEFAULT_SEQUENCE_LENGTH, by: tuple[str, ...] = ()
) -> DataFrame:
    """The whole forecasting dataset from already type/period-filtered part
    rows (M15), or of all groups of ``by`` at once.  The monthly aggregate
    (parts x months, small next to the order lines) and the selected parts are
    written once each, so the share, quantile, selection and grid branches do
    not recompute their inputs."""
    monthly = physical.materialize(monthly_demand(rows, by=by), "monthly")
    shares = physical.materialize(part_share(monthly, by), "shares")
    top = physical.materialize(top_contributors(shares, q, by), "top")
    filled = physical.materialize(fill_months(selected_monthly(monthly, top, by), by), "filled")
    return sequences(filled, length, by=by)


def lag_columns(inputs: Column, length: int = S.DEFAULT_SEQUENCE_LENGTH) -> list[Column]:
    """``inputs`` as scalar columns lag_<k> (k months before the target)."""
    return [F.get(inputs, length - k).alias(f"lag_{k:02d}") for k in range(length, 0, -1)]
