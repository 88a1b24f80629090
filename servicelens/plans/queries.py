"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group, all over the whole driver tables.

Column names equal those of the DuckDB formulations in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.functions import dates, scalar, workcal
from servicelens.functions.scalar import itemset_label
from servicelens.operators import clusters, demand, descriptive, prepare, rules
from servicelens.plans import physical
from servicelens.plans import workload as WL
from servicelens.session import scratch_path
from servicelens.plans.workload import END, FULL_END, FULL_START, START, TYPE, Workload
from servicelens.sources import csv as csvio
from servicelens.sources import driver_tables as dt

Query = Callable[[SparkSession, str], DataFrame]


def working_days_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Working days between order date and ship date of every line
    (about half of the pairs are reversed)."""
    w = Workload(spark, sf_dir)
    li = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = w.table("orders").select("o_orderkey", "o_orderdate")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )
    return workcal.with_working_days(pairs, "order_date", "ship_date", "working_days", w.years)


def stage_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six stage durations and the lead time per order."""
    w = Workload(spark, sf_dir)
    return workcal.with_stage_durations(w.headers, w.years).select(
        "order_id", "product_type", *S.STAGE_DURATIONS, S.LEAD_TIME
    )


def time_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 (F4, F5, W1, A2, A3) for one type and period."""
    w = Workload(spark, sf_dir)
    return descriptive.time_analysis(w.featured, TYPE, START, END, digits=None)


def time_analysis_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 grouped form: every product type in one pass."""
    w = Workload(spark, sf_dir)
    return descriptive.time_analysis(w.featured, None, START, END, digits=None)


def time_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 (R1, W2) for every type."""
    return descriptive.time_waterfall(time_analysis_by_type(spark, sf_dir))


def time_stage_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 without the lead-time bar: the six stages stacked from zero."""
    return descriptive.time_waterfall(time_analysis_by_type(spark, sf_dir), include_total=False)


def prepared_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2, L3 (J1, F2, F3): merged rows that are repair parts."""
    w = Workload(spark, sf_dir)
    merged = prepare.merge(w.headers, w.positions)
    return prepare.keep_repair_parts(merged).select(
        "order_id", "position", "part_no", "part_name", "quantity", "product_article", "product_type"
    )


def labour_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labour units per order, left-joined to the featured rows."""
    w = Workload(spark, sf_dir)
    return w.featured.select("order_id", "position", "part_no", "labour_units")


def featured_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 (P4, T4, T5, A1, J2): the whole featured table."""
    w = Workload(spark, sf_dir)
    return w.featured.select(
        "order_id", "position", "part_no", "product_type", "customer_no", "contact_no",
        *S.STAGE_DURATIONS, S.LEAD_TIME, "labour_units",
    )


def process_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 (A2, A4-A8, T9) for one type and period."""
    w = Workload(spark, sf_dir)
    return descriptive.process_analysis(w.featured, TYPE, START, END, w.years, digits=None)


def process_analysis_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 grouped form: every product type in one pass."""
    w = Workload(spark, sf_dir)
    return descriptive.process_analysis(w.featured, None, START, END, w.years, digits=None)


def part_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9 (O2): parts of the process analysis by quantity."""
    return descriptive.part_ranking(descriptive.part_totals(Workload(spark, sf_dir).featured, TYPE, START, END))


def key_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9 (R2): the four order-level figures as rows."""
    w = Workload(spark, sf_dir)
    return descriptive.key_figures(descriptive.order_figures(w.featured, TYPE, START, END, w.years, digits=None))


# ---------------------------------------------------------------------------
# Rules (M1-M6, R5, F7, P10, J7)
# ---------------------------------------------------------------------------

def _rule_rows(w: Workload) -> DataFrame:
    return descriptive.select_rows(w.parts, TYPE, START, END)


def _itemsets(w: Workload) -> DataFrame:
    return rules.frequent_itemsets(rules.baskets(_rule_rows(w), WL.RULE_ITEM), WL.RULE_MIN_SUPPORT)


def _rules(w: Workload) -> DataFrame:
    return rules.association_rules(_itemsets(w), "confidence", WL.RULE_MIN_CONFIDENCE)


_RULE_COLUMNS = ["antecedent", "consequent", "antecedent_support", "consequent_support", *rules.METRICS]


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One basket of distinct items per order."""
    b = rules.baskets(_rule_rows(Workload(spark, sf_dir)), WL.RULE_ITEM)
    return b.select("order_id", itemset_label(F.col("items")).alias("items"), F.size("items").cast("long").alias("n_items"))


def frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: FP-growth itemsets with support."""
    fi = _itemsets(Workload(spark, sf_dir))
    return fi.select(itemset_label(F.col("items")).alias("items"), F.col("size").cast("long").alias("size"), "freq", "support")


def association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, M4: every split of every itemset, confidence threshold."""
    return rules.with_labels(_rules(Workload(spark, sf_dir))).select(*_RULE_COLUMNS)


def _watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: labels, nodes and links all read the rules."""
    return physical.materialize(rules.watched_rules(_rules(Workload(spark, sf_dir)), WL.RULE_WATCH), "watched")


def watched_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rules with a watched item on both sides."""
    return rules.with_labels(_watched(spark, sf_dir)).select(*_RULE_COLUMNS)


def rule_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5, P10: rule graph edges."""
    return rules.rule_edges(_watched(spark, sf_dir))


def sankey_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: Sankey nodes."""
    return rules.sankey_nodes(_watched(spark, sf_dir))


def sankey_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sankey links."""
    return rules.sankey_links(_watched(spark, sf_dir), digits=None)


def _grouped_rules(w: Workload) -> tuple[DataFrame, DataFrame]:
    rows = descriptive.select_rows(w.parts, None, START, END)
    return rules.component_associations(
        rows, None, WL.RULE_MIN_SUPPORT, "confidence", WL.RULE_MIN_CONFIDENCE, watch=None, item_col=WL.RULE_ITEM
    )


def frequent_itemsets_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, A15, F4 grouped form: every type's itemsets in one level-wise pass."""
    sets, _ = _grouped_rules(Workload(spark, sf_dir))
    return sets.select("product_type", itemset_label(F.col("items")).alias("items"), F.col("size").cast("long").alias("size"), "freq", "support")


def association_rules_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M3, M4, F4 grouped form: every type's rules in one pass."""
    _, found = _grouped_rules(Workload(spark, sf_dir))
    return rules.with_labels(found).select("product_type", *_RULE_COLUMNS)


# ---------------------------------------------------------------------------
# Demand series (M15: A10-A12, F8, F9, R3, R4, T6, T8, W3, W4)
# ---------------------------------------------------------------------------

def _monthly(w: Workload) -> DataFrame:
    rows = descriptive.select_rows(w.parts, TYPE, WL.FULL_START, WL.FULL_END)
    return physical.materialize(demand.monthly_demand(rows), "monthly")


def _shares(monthly: DataFrame) -> DataFrame:
    """Written once: the quantile's rounds and the selection read it."""
    return physical.materialize(demand.part_share(monthly), "shares")


def _filled(w: Workload) -> DataFrame:
    monthly = _monthly(w)
    top = physical.materialize(demand.top_contributors(_shares(monthly)), "top")
    return physical.materialize(demand.fill_months(demand.selected_monthly(monthly, top)), "filled")


def _month_label(c: str = "month"):
    return F.date_format(F.col(c), "yyyy-MM")


def monthly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per month and part."""
    return _monthly(Workload(spark, sf_dir)).select(_month_label().alias("month"), "part_no", "qty")


def part_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part totals and share of the grand total."""
    return demand.part_share(_monthly(Workload(spark, sf_dir)))


def top_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with share >= the exact 0.9 quantile."""
    top = demand.top_contributors(_shares(_monthly(Workload(spark, sf_dir))))
    return top.select("part_no", "total_qty", "share")


def demand_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free monthly series of the top contributors."""
    return _filled(Workload(spark, sf_dir)).select(_month_label().alias("month"), "part_no", "qty")


def demand_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part x month matrix of the gap-free series."""
    return demand.demand_pivot(_filled(Workload(spark, sf_dir)), FULL_START, FULL_END)


def demand_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month x part matrix of a given part list."""
    wide = demand.demand_matrix(_monthly(Workload(spark, sf_dir)), list(WL.MATRIX_PARTS))
    return wide.select(_month_label().alias("month"), *WL.MATRIX_PARTS)


def demand_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12-month samples with their target and split."""
    seq = demand.sequences(_filled(Workload(spark, sf_dir)))
    return seq.select(
        "part_no", _month_label("target_month").alias("target_month"), "sample_idx", "split",
        *demand.lag_columns(F.col("inputs")), "target",
    )


BY_TYPE = ("product_type",)


def _monthly_by_type(w: Workload) -> DataFrame:
    rows = descriptive.select_rows(w.parts, None, WL.FULL_START, WL.FULL_END)
    return physical.materialize(demand.monthly_demand(rows, by=BY_TYPE), "monthly")


def top_contributors_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, A12, F8, F4 grouped form: every type's parts from its own quantile on."""
    shares = demand.part_share(_monthly_by_type(Workload(spark, sf_dir)), BY_TYPE)
    top = demand.top_contributors(physical.materialize(shares, "shares"), by=BY_TYPE)
    return top.select("product_type", "part_no", "total_qty", "share", "threshold")


def demand_sequences_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15, R4, W3, W4, F4 grouped form: every type's samples in one pass."""
    rows = descriptive.select_rows(Workload(spark, sf_dir).parts, None, WL.FULL_START, WL.FULL_END)
    seq = demand.demand_dataset(rows, by=BY_TYPE)
    return seq.select(
        "product_type", "part_no", _month_label("target_month").alias("target_month"), "sample_idx", "split",
        *demand.lag_columns(F.col("inputs")), "target",
    )


# ---------------------------------------------------------------------------
# Part clusters
# ---------------------------------------------------------------------------

def _features(w: Workload) -> DataFrame:
    return clusters.part_features(descriptive.select_rows(w.parts, TYPE, START, END))


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: quantity, frequency and name per part."""
    return _features(Workload(spark, sf_dir))


def critical_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 (O3, F10, P12): parts named like the top five."""
    return clusters.critical_parts(_features(Workload(spark, sf_dir)))


def translated_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English names of the critical parts."""
    return clusters.translate_names(clusters.critical_parts(_features(Workload(spark, sf_dir))))


def translated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of all parts, by a lookup that holds some of them."""
    return clusters.translate_names(_features(Workload(spark, sf_dir)), WL.NAME_LOOKUP)


def k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette per k, the best one chosen."""
    return clusters.k_sweep(_features(Workload(spark, sf_dir)))


def k_sweep_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9-M11, O4, F4 grouped form: the sweeps of all types in the same passes."""
    rows = descriptive.select_rows(Workload(spark, sf_dir).parts, None, START, END)
    return clusters.k_sweep(clusters.part_features(rows, BY_TYPE), by=BY_TYPE)


def part_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with cluster, critical flag, English name."""
    labelled, _, _ = clusters.cluster_parts(_features(Workload(spark, sf_dir)))
    return clusters.scatter_table(labelled)


def k_sweep_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every k of the range is scored, the best one is chosen."""
    scores = clusters.k_sweep(_features(Workload(spark, sf_dir)))
    best = scores.agg(F.max("silhouette").alias("best"), F.count(F.when(F.col("chosen"), 1)).alias("n_chosen"))
    ok = F.col("silhouette").between(-1.0, 1.0) & (~F.col("chosen") | (F.col("silhouette") == F.col("best")))
    return scores.crossJoin(best).select("k", ok.alias("score_holds"), "n_chosen")


def part_cluster_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the labels whatever their numbers, with
    the critical flag and the English name of every part."""
    labelled, centres, _ = clusters.cluster_parts(_features(Workload(spark, sf_dir)))
    facts = clusters.cluster_facts(labelled, centres).select("part_no", "own_centre_nearest", "centre_is_mean")
    table = clusters.scatter_table(labelled).drop("cluster")
    return table.join(facts, "part_no")


def cluster_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres of the chosen clustering."""
    _, centres, _ = clusters.cluster_parts(_features(Workload(spark, sf_dir)))
    return centres


# ---------------------------------------------------------------------------
# Ingest and cleaning over raw text
# ---------------------------------------------------------------------------

def address_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop the third character, split on the literal dot."""
    raw = dt.raw_header_view(spark, sf_dir)
    h = raw.select(
        F.col("serviceauftrag").alias("order_id"), scalar.drop_third_char(F.col("adresse")).alias("address_code")
    )
    return prepare.split_address(h)


def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal-comma quantities, malformed ones NULL."""
    raw = dt.raw_position_view(spark, sf_dir)
    return raw.select(
        F.col("SERVICEAUFTRAG").alias("order_id"),
        F.col("POSITION").alias("position"),
        F.col("ARTIKEL").alias("part_no"),
        F.col("MENGE").alias("quantity_raw"),
        scalar.decimal_comma(F.col("MENGE")).alias("quantity"),
    )


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position export written sorted as CSV, read
    back with a sniffed delimiter, cleaned and rounded to two digits (half-even)."""
    raw = dt.raw_position_view(spark, sf_dir)
    path = scratch_path(spark, "csv")
    csvio.write_csv(raw.orderBy("SERVICEAUFTRAG", "POSITION"), path, sep=";")
    good, _ = prepare.clean_positions(csvio.read_csv(spark, path))
    return good.select("order_id", F.col("position").cast("long").alias("position"), "part_no", scalar.round2(F.col("quantity") / 8, 2).alias("eighth"))


def quantity_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position rows whose quantity is not a number, with the reason."""
    _, bad = prepare.clean_positions(dt.raw_position_view(spark, sf_dir))
    return bad.select("order_id", "position", "part_no", "quantity_raw", "reject_reason")


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven stage dates of every header, parsed from mixed formats."""
    raw = dt.raw_header_view(spark, sf_dir)
    src = list(S.HEADER_SOURCE_COLUMNS)[4:]
    long = raw.unpivot(["serviceauftrag"], src, "stage", "raw")
    return long.select(
        F.col("serviceauftrag").alias("order_id"), "stage", "raw", dates.parse_timestamp(F.col("raw")).alias("parsed")
    )


def na_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned headers (rows with a missing marker dropped)."""
    typed, _ = prepare.clean_headers(dt.raw_header_view(spark, sf_dir))
    return typed.select("order_id", "address_code", "product_type", "d_goods_in", "d_goods_out")


def delimiter_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimiter profile of the position export rendered with ';'."""
    raw = dt.raw_position_view(spark, sf_dir)
    lines = raw.select(F.concat_ws(";", *[F.col(c) for c in raw.columns]).alias("value"))
    return csvio.delimiter_profile(lines)


def ingested_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L4 over raw text: clean both exports, merge, keep repair parts."""
    headers, _ = prepare.clean_headers(dt.raw_header_view(spark, sf_dir))
    positions, _ = prepare.clean_positions(dt.raw_position_view(spark, sf_dir))
    parts = prepare.keep_repair_parts(prepare.merge(headers, positions))
    return parts.select("order_id", "position", "part_no", "quantity", "product_type", "d_goods_out")


def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does each type's goods-out range cover the report period?"""
    return dates.coverage(Workload(spark, sf_dir).parts, "d_goods_out", START, END, by="product_type")


def part_ranking_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9 (O2) grouped form: parts of every product type by quantity."""
    return descriptive.part_ranking(descriptive.part_totals(Workload(spark, sf_dir).featured, None, START, END))


def key_figures_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L9 (R2) grouped form: the four figures of every product type."""
    w = Workload(spark, sf_dir)
    return descriptive.key_figures(descriptive.order_figures(w.featured, None, START, END, w.years, digits=None))


def coverage_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11, A13 over the whole table (the original's single check)."""
    return dates.coverage(Workload(spark, sf_dir).parts, "d_goods_out", START, END)


QUERIES: dict[str, Query] = {
    "working_days_delta": working_days_delta,
    "stage_durations": stage_durations,
    "time_analysis": time_analysis,
    "time_analysis_by_type": time_analysis_by_type,
    "time_waterfall": time_waterfall,
    "time_stage_bars": time_stage_bars,
    "prepared_parts": prepared_parts,
    "labour_units": labour_units,
    "featured_parts": featured_parts,
    "process_analysis": process_analysis,
    "process_analysis_by_type": process_analysis_by_type,
    "part_ranking": part_ranking,
    "key_figures": key_figures,
    "key_figures_by_type": key_figures_by_type,
    "part_ranking_by_type": part_ranking_by_type,
    "baskets": baskets,
    "frequent_itemsets": frequent_itemsets,
    "association_rules": association_rules,
    "frequent_itemsets_by_type": frequent_itemsets_by_type,
    "association_rules_by_type": association_rules_by_type,
    "watched_rules": watched_rules,
    "rule_edges": rule_edges,
    "sankey_nodes": sankey_nodes,
    "sankey_links": sankey_links,
    "monthly_demand": monthly_demand,
    "part_share": part_share,
    "top_contributors": top_contributors,
    "demand_filled": demand_filled,
    "demand_pivot": demand_pivot,
    "demand_matrix": demand_matrix,
    "demand_sequences": demand_sequences,
    "top_contributors_by_type": top_contributors_by_type,
    "demand_sequences_by_type": demand_sequences_by_type,
    "part_features": part_features,
    "critical_parts": critical_parts,
    "translated_parts": translated_parts,
    "translated_names": translated_names,
    "k_sweep": k_sweep,
    "k_sweep_by_type": k_sweep_by_type,
    "part_clusters": part_clusters,
    "cluster_centers": cluster_centers,
    "k_sweep_facts": k_sweep_facts,
    "part_cluster_facts": part_cluster_facts,
    "address_split": address_split,
    "decimal_comma": decimal_comma,
    "csv_round_trip": csv_round_trip,
    "quantity_quarantine": quantity_quarantine,
    "parse_dates": parse_dates,
    "na_drop": na_drop,
    "delimiter_profile": delimiter_profile,
    "ingested_parts": ingested_parts,
    "coverage_check": coverage_check,
    "coverage_total": coverage_total,
}
