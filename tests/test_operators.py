import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.operators import clusters, demand, descriptive, prepare, rules
from servicelens.operators.ordinal import with_ordinal

D = dt.date


def headers(spark, rows):
    """rows: (order_id, product_article, product_type, goods_in, goods_out)"""
    full = []
    for oid, art, typ, gin, gout in rows:
        full.append((oid, "12345.1", art, typ, gin, gin, gin, gin, gin, gin, gout))
    return spark.createDataFrame(
        full, "order_id string, address_code string, product_article string, product_type string, "
        + ", ".join(f"{c} date" for c in S.STAGE_DATES)
    )


def positions(spark, rows):
    return spark.createDataFrame(rows, "order_id string, position int, part_no string, part_name string, quantity double")


def test_part_filter_drops_product_articles(spark, years):
    h = headers(spark, [("A", "K0100", "T", D(2020, 1, 6), D(2020, 1, 8)), ("B", "K0999", "T", D(2020, 1, 6), D(2020, 1, 8))])
    p = positions(spark, [("A", 1, "K0100", "x", 1.0), ("B", 1, "K0100", "x", 1.0), ("B", 2, "K0200", "y", 2.0),
                          ("A", 2, "X0300", "z", 1.0)])
    out = prepare.prepare(h, p, years)
    assert sorted((r.order_id, r.part_no) for r in out.collect()) == [("B", "K0200")]
    # the generic form on a merged table agrees
    merged = prepare.keep_repair_parts(prepare.merge(h, p))
    assert sorted((r.order_id, r.part_no) for r in merged.collect()) == [("B", "K0200")]


def test_labour_units_survive_part_filter(spark, years):
    h = headers(spark, [("A", "P1", "T", D(2020, 1, 6), D(2020, 1, 8))])
    p = positions(spark, [("A", 1, "KK002", "work", 2.0), ("A", 2, "KK060", "work", 1.5), ("A", 3, "K0500", "part", 1.0)])
    out = prepare.prepare(h, p, years).collect()
    assert [(r.part_no, r.labour_units) for r in out] == [("K0500", 3.5)]


def test_time_analysis_null_counts_as_zero(spark, years):
    h = headers(spark, [("A", "P1", "T", D(2020, 1, 6), D(2020, 1, 8)), ("B", "P1", "T", None, D(2020, 1, 8))])
    p = positions(spark, [("A", 1, "K0500", "n", 1.0), ("A", 2, "K0501", "n", 1.0), ("B", 1, "K0500", "n", 1.0)])
    feat = prepare.prepare(h, p, years)
    row = descriptive.time_analysis(feat, "T", "01.01.2020", "31.01.2020", digits=None).first()
    assert row.n_orders == 2
    # A: goods_in..repair_end all on 6.1, goods_out 8.1 -> last stage 2 days;
    # B: every stage before goods-out is NULL, so its last stage is NULL -> 0
    assert row.wd_repair_end_goods_out_avg == (2 + 0) / 2
    assert row.wd_goods_in_repair_start_avg == 0.0


def test_empty_type_gives_nulls(spark, years):
    h = headers(spark, [("A", "P1", "T", D(2020, 1, 6), D(2020, 1, 8))])
    p = positions(spark, [("A", 1, "K0500", "n", 1.0)])
    feat = prepare.prepare(h, p, years)
    row = descriptive.time_analysis(feat, "NOPE", "01.01.2020", "31.01.2020").first()
    assert row.n_orders == 0 and row.wd_lead_time_avg is None
    assert descriptive.process_analysis(feat, "NOPE", "01.01.2020", "31.01.2020", years).count() == 0


def test_basket_dedupes(spark):
    p = spark.createDataFrame([("A", "x"), ("A", "x"), ("A", "y")], "order_id string, part_no string")
    assert [r.items for r in rules.baskets(p).collect()] == [["x", "y"]]


def _baskets(spark, lists):
    return spark.createDataFrame([(str(i), items) for i, items in enumerate(lists)], "order_id string, items array<string>")


def test_all_splits_rules(spark):
    b = _baskets(spark, [["a", "b", "c"], ["a", "b", "c"], ["a", "b"], ["c"]])
    sets = rules.frequent_itemsets(b, 0.5)
    assert sets.count() == 7
    r = rules.association_rules(sets, "confidence", 0.0)
    assert r.count() == 12
    for row in r.collect():
        assert 0 <= row.confidence <= 1
        assert row.antecedent_support >= row.support and row.consequent_support >= row.support


def test_conviction_infinite(spark):
    b = _baskets(spark, [["a", "b"], ["a", "b"], ["b"]])
    r = rules.association_rules(rules.frequent_itemsets(b, 0.5), "confidence", 0.0)
    row = r.where(F.col("antecedents") == F.array(F.lit("a"))).first()
    assert row.confidence == 1.0 and math.isinf(row.conviction)


def test_watch_filter(spark):
    b = _baskets(spark, [["a", "b", "w"], ["a", "b", "w"], ["a", "b"]])
    r = rules.association_rules(rules.frequent_itemsets(b, 0.5), "confidence", 0.0)
    kept = rules.watched_rules(r, ["w", "a"]).collect()
    assert kept and all(("w" in x.antecedents or "a" in x.antecedents) and ("w" in x.consequents or "a" in x.consequents) for x in kept)
    assert rules.watched_rules(r, ["w"]).count() == 0


def test_one_order_under_two_types(spark):
    from servicelens.operators import descriptive

    day = "TIMESTAMP '2018-03-01 00:00:00'"
    cols = ", ".join(f"{k} AS {c}" for k, c in enumerate(["wd_lead_time", *S.STAGE_DURATIONS]))
    rows = spark.sql(
        f"SELECT 1L AS order_id, t AS product_type, p AS position, {day} AS d_goods_in, {day} AS d_goods_out,"
        f" part AS part_no, part AS part_name, 2.0D AS quantity, lu AS labour_units, {cols}"
        " FROM VALUES ('A', 1, 'x', 3.0D), ('B', 2, 'y', 4.0D), ('B', 3, 'z', 4.0D) AS v(t, p, part, lu)"
    )
    from servicelens.functions import workcal

    years = workcal.default_year_table(spark)
    period = ("01.01.2018", "31.12.2018")
    key = lambda r: tuple(str(x) for x in r)
    for f in (descriptive.time_analysis, lambda *a: descriptive.process_analysis(*a, years).drop("part_seq"), lambda *a: descriptive.order_figures(*a, years)):
        grouped = sorted(f(rows, None, *period).collect(), key=key)
        single = sorted([*f(rows, "A", *period).collect(), *f(rows, "B", *period).collect()], key=key)
        assert [r.asDict() for r in grouped] == [r.asDict() for r in single] and len(grouped) >= 2


def test_sankey_ids(spark):
    b = _baskets(spark, [["a", "b"], ["a", "b"], ["a", "c"], ["a", "c"]])
    r = rules.association_rules(rules.frequent_itemsets(b, 0.5), "confidence", 0.0)
    nodes = rules.sankey_nodes(r).collect()
    ante = sorted((n.node_id, n.label) for n in nodes if n.side == "antecedent")
    cons = sorted((n.node_id, n.label) for n in nodes if n.side == "consequent")
    assert [i for i, _ in ante] == list(range(len(ante)))
    assert [i for i, _ in cons] == list(range(len(ante), len(ante) + len(cons)))
    assert rules.sankey_links(r).count() == r.count()


def test_critical_parts_by_name(spark):
    rows = [(f"P{i}", f"name{i}", float(100 - i), 10) for i in range(8)] + [("P9", "name0", 1.0, 1)]
    f = spark.createDataFrame(rows, "part_no string, part_name string, quantity double, frequency long")
    assert clusters.critical_parts(f, 5).count() == 6


def test_exact_quantile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 8)], "x double").repartition(3)
    assert demand.exact_quantile(df, "x", 0.9).first().quantile == pytest.approx(6.4)


def test_fill_months(spark):
    sel = spark.createDataFrame([(D(2020, 1, 1), "p", 2.0), (D(2020, 3, 1), "p", 3.0)], "month date, part_no string, qty double")
    got = sorted((r.month, r.qty) for r in demand.fill_months(sel).collect())
    assert got == [(D(2020, 1, 1), 2.0), (D(2020, 2, 1), 0.0), (D(2020, 3, 1), 3.0)]


def _months(n):
    out, y, m = [], 2000, 1
    for _ in range(n):
        out.append(D(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def test_sequences_counts(spark):
    filled = spark.createDataFrame([(d, "p", float(i)) for i, d in enumerate(_months(80))], "month date, part_no string, qty double")
    seq = demand.sequences(filled)
    assert seq.count() == 68
    assert seq.where("split = 'train'").count() == 54
    first = seq.orderBy("sample_idx").first()
    assert first.inputs == [float(i) for i in range(12)] and first.target == 12.0
    short = spark.createDataFrame([(d, "p", 1.0) for d in _months(12)], "month date, part_no string, qty double")
    assert demand.sequences(short).count() == 0


def test_k_sweep_clipped(spark):
    f = spark.createDataFrame([(f"P{i}", "n", float(i * 10), i) for i in range(4)], "part_no string, part_name string, quantity double, frequency long")
    ks = [r.k for r in clusters.k_sweep(f).collect()]
    assert ks == [2, 3]


def test_ordinal_is_global(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    got = with_ordinal(df, [F.col("v")], "r").collect()
    assert sorted((r.r, r.v) for r in got) == [(i + 1, i) for i in range(1000)]


def test_rule_masks_across_chunks(spark, monkeypatch):
    b = _baskets(spark, [["a", "b", "c", "d"]] * 3 + [["a"]])
    sets = rules.frequent_itemsets(b, 0.5)
    assert sets.count() == 15
    whole = {(tuple(r.antecedents), tuple(r.consequents)) for r in rules.association_rules(sets, "confidence", 0.0).collect()}
    monkeypatch.setattr(rules, "MASK_CHUNK", 3)
    chunked = {(tuple(r.antecedents), tuple(r.consequents)) for r in rules.association_rules(sets, "confidence", 0.0).collect()}
    assert len(whole) == 3 ** 4 - 2 ** 5 + 1 == 50
    assert chunked == whole
