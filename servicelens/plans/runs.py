"""End-to-end runs: raw CSV exports -> stage tables -> result tables
(L4, L5, L10, L12, L13, L14).

Stage tables are Parquet, written once (an existing stage is reused, as the
original reused its stage files) under ``<out>/stages``; results are CSV
folders under ``<out>/results``.  Every step is a Spark job over whole
tables; the driver only sees scalars (k of the sweep, file existence).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.functions import dates, workcal
from servicelens.operators import clusters, demand, descriptive, prepare, rules
from servicelens.plans import physical
from servicelens.sources import csv as csvio


def _paths(out: str) -> dict[str, str]:
    return {
        "preprocessed": os.path.join(out, "stages", "preprocessed"),
        "featured": os.path.join(out, "stages", "featured"),
        "quarantine": os.path.join(out, "stages", "quarantine"),
        "results": os.path.join(out, "results"),
    }


RAGGED = "__ragged_row"


def _whole_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with all cells, quarantine rows of the others); the order of a
    ragged row is its first cell."""
    ragged = F.col(RAGGED).isNotNull()
    first = raw.columns[0]
    bad = raw.where(ragged).select(F.col(f"`{first}`").alias("order_id"), F.lit("ragged_row").alias("reject_reason"), RAGGED)
    return raw.where(~ragged).drop(RAGGED), bad.drop(RAGGED)


def preprocessing(spark: SparkSession, kopf_path: str, pos_path: str, out: str,
                  sep: str | None = None, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """L4: read both exports (S1-S3), clean (L1), merge (L2), keep repair parts
    (L3); rows with unusable cells go to the quarantine stage (S5), and rows
    with too many or too few cells as ``ragged_row``.  ``multi_line`` allows line
    breaks in quoted cells."""
    p = _paths(out)
    raw_h, ragged_h = _whole_rows(csvio.read_csv(spark, kopf_path, sep, encoding, multi_line=multi_line, ragged=RAGGED))
    raw_p, ragged_p = _whole_rows(csvio.read_csv(spark, pos_path, sep, encoding, multi_line=multi_line, ragged=RAGGED))
    headers, bad_h = prepare.clean_headers(raw_h)
    positions, bad_p = prepare.clean_positions(raw_p)
    cols = ["order_id", "reject_reason"]
    rejected = bad_h.select(*cols).unionByName(bad_p.select(*cols)).unionByName(ragged_h).unionByName(ragged_p)
    csvio.write_stage(rejected, p["quarantine"])
    csvio.write_stage(headers, p["preprocessed"] + "_headers")
    csvio.write_stage(positions, p["preprocessed"] + "_positions")
    parts = prepare.keep_repair_parts(
        prepare.merge(csvio.read_stage(spark, p["preprocessed"] + "_headers"),
                      csvio.read_stage(spark, p["preprocessed"] + "_positions"))
    )
    # O1: the export is sorted by order, position and goods-in date (a
    # range-partitioned sort; only the export needs an order).
    csvio.write_csv(parts.orderBy("order_id", "position", "d_goods_in"), os.path.join(p["results"], "preprocessed"))
    return parts


def feature_engineering(spark: SparkSession, out: str, holidays: DataFrame | None = None) -> DataFrame:
    """Featured part rows, written once, partitioned by product type so
    type filters read only their folder."""
    p = _paths(out)
    years = workcal.year_table(holidays) if holidays is not None else workcal.default_year_table(spark)
    headers = csvio.read_stage(spark, p["preprocessed"] + "_headers")
    positions = csvio.read_stage(spark, p["preprocessed"] + "_positions")
    csvio.write_stage(prepare.prepare(headers, positions, years), p["featured"], ["product_type"])
    return csvio.read_stage(spark, p["featured"])


def descriptive_run(spark: SparkSession, out: str, typ: str, start: str, end: str) -> dict[str, DataFrame]:
    """Period coverage (T11), time KPIs (L6) and bars (L7), process KPIs
    (L8), part ranking and key figures (L9); results written as CSV (S9)."""
    p = _paths(out)
    featured = csvio.read_stage(spark, p["featured"])
    years = workcal.default_year_table(spark)
    res = {
        "coverage": dates.coverage(featured, "d_goods_out", start, end),
        "time_periods": descriptive.time_analysis(featured, typ, start, end),
    }
    res["time_bars"] = descriptive.time_waterfall(res["time_periods"])
    process = descriptive.process_analysis(featured, typ, start, end, years)
    res["process"] = process
    res["part_ranking"] = descriptive.part_ranking(descriptive.part_totals(featured, typ, start, end))
    res["key_figures"] = descriptive.key_figures(descriptive.order_figures(featured, typ, start, end, years))
    for name, df in res.items():
        csvio.write_csv(df, os.path.join(p["results"], "descriptive", name))
    return res


def diagnostic_run(spark: SparkSession, out: str, typ: str, start: str, end: str,
                   min_support: float = S.DEFAULT_MIN_SUPPORT, metric: str = S.DEFAULT_METRIC,
                   min_threshold: float = S.DEFAULT_MIN_THRESHOLD, watch=S.WATCH_ITEMS,
                   item_col: str = "part_no") -> dict[str, DataFrame]:
    """Part clusters (L11: M7-M14) and component rules (M1-M6)."""
    p = _paths(out)
    rows = descriptive.select_rows(csvio.read_stage(spark, p["featured"]), typ, start, end)
    features = clusters.part_features(rows)
    labelled, centres, scores = clusters.cluster_parts(features)
    sets, watched = rules.component_associations(rows, typ, min_support, metric, min_threshold, watch, item_col)
    watched = physical.materialize(watched, "watched")  # four results read it
    res = {
        "part_clusters": clusters.with_period(clusters.scatter_table(labelled), typ, start, end),
        "cluster_centers": centres,
        "k_sweep": scores,
        "critical_parts": clusters.critical_list(labelled),
        "itemsets": sets,
        "component_rules": rules.with_labels(watched),
        "rule_edges": rules.rule_edges(watched),
        "sankey_nodes": rules.sankey_nodes(watched),
        "sankey_links": rules.sankey_links(watched),
    }
    for name, df in res.items():
        csvio.write_csv(df, os.path.join(p["results"], "diagnostic", name))
    return res


def predictive_run(spark: SparkSession, out: str, typ: str, start: str, end: str) -> DataFrame:
    """The monthly demand training set (M15), written as Parquet (the
    arrays stay arrays) and as CSV with lag columns."""
    p = _paths(out)
    rows = descriptive.select_rows(csvio.read_stage(spark, p["featured"]), typ, start, end)
    data = demand.demand_dataset(rows)
    target = os.path.join(p["results"], "predictive", "sequences")
    data.write.mode("overwrite").parquet(target)
    flat = spark.read.parquet(target)
    csvio.write_csv(
        flat.select("part_no", F.date_format("target_month", "yyyy-MM").alias("target_month"), "sample_idx", "split",
                    *demand.lag_columns(F.col("inputs")), "target"),
        os.path.join(p["results"], "predictive", "sequences_csv"),
    )
    return flat


def main(spark: SparkSession, kopf_path: str, pos_path: str, out: str,
         typ: str = S.DEFAULT_TYPE, start: str = S.DEFAULT_START, end: str = S.DEFAULT_END, **rule_args) -> None:
    """The five stages in order."""
    dates.parse_arg_date(start), dates.parse_arg_date(end)  # T10: fail fast on bad arguments
    preprocessing(spark, kopf_path, pos_path, out)
    feature_engineering(spark, out)
    descriptive_run(spark, out, typ, start, end)
    diagnostic_run(spark, out, typ, start, end, **rule_args)
    predictive_run(spark, out, typ, start, end)


def cli(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="servicelens", description="Repair-order analytics on Spark")
    ap.add_argument("kopf"), ap.add_argument("pos"), ap.add_argument("out")
    ap.add_argument("--type", default=S.DEFAULT_TYPE)
    ap.add_argument("--start", default=S.DEFAULT_START)
    ap.add_argument("--end", default=S.DEFAULT_END)
    ap.add_argument("--min-support", type=float, default=S.DEFAULT_MIN_SUPPORT)
    ap.add_argument("--min-confidence", type=float, default=S.DEFAULT_MIN_THRESHOLD)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("servicelens").getOrCreate()
    main(spark, a.kopf, a.pos, a.out, a.type, a.start, a.end,
         min_support=a.min_support, min_threshold=a.min_confidence)
