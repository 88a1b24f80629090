"""Plans that must not sort or shuffle wide rows, and the helpers that see to it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from servicelens import schema as S
from servicelens.operators import prepare
from servicelens.plans import physical
from servicelens.plans.workload import Workload
from servicelens.sources import driver_tables

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark, monkeypatch):
    """Every table counts as too large to broadcast."""
    monkeypatch.setattr(physical, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df, capsys, mode="simple"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def orders(spark):
    day = dt.date(2020, 1, 6)
    rows = [(o, "12345.1", a, "T", *[day] * 7) for o, a in [("A", "K0100"), ("B", "K0999"), ("B", "K0998"), (None, "K0200"), ("C", "K0300")]]
    columns = "order_id string, address_code string, product_article string, product_type string, "
    return spark.createDataFrame(rows, columns + ", ".join(f"{c} date" for c in S.STAGE_DATES))


def lines(spark):
    rows = [("A", 1, "K0100", 1.0), ("A", 2, "K0200", 2.0), ("A", 2, "K0200", 2.0), ("B", 1, "KK002", 3.0), ("B", 2, "KK060", None),
            ("B", 3, "K0500", 4.0), ("C", 1, "KK002", 5.0), (None, 1, "K0200", 6.0), ("D", 1, "K0600", 7.0), ("A", 3, "K0300", 8.0)]
    return spark.createDataFrame(rows, "order_id string, position int, part_no string, quantity double")


def test_prepare_neither_sorts_nor_shuffles_wide_rows(spark, years, large, capsys):
    out = prepare.prepare(orders(spark), lines(spark), years)
    text = plan(out, capsys)
    assert "SortMergeJoin" not in text and "Sort [" not in text and "ShuffledHashJoin" in text
    # C has no repair part, so its article stays a part; repeated rows and headers stay too
    got = sorted((r.order_id, r.product_article, r.position, r.part_no, r.labour_units) for r in out.collect() if r.labour_units is not None)
    assert got == [("B", "K0998", 3, "K0500", 3.0), ("B", "K0999", 3, "K0500", 3.0)]
    got = sorted((r.order_id, r.position, r.part_no) for r in out.collect() if r.labour_units is None)
    assert got == [("A", 2, "K0200"), ("A", 2, "K0200"), ("A", 3, "K0300")]


def test_order_joins_get_as_many_partitions_as_their_lines_need(spark, years, large, monkeypatch):
    monkeypatch.setattr(prepare, "LINES_A_PARTITION", 1)
    few = prepare.prepare(orders(spark), lines(spark), None)
    assert few.rdd.getNumPartitions() == 10
    assert few.count() == 5


def test_merge_and_views_do_not_sort(spark, large, capsys):
    merged = prepare.merge(driver_tables.header_view(spark, SF_SMALL), driver_tables.position_view(spark, SF_SMALL))
    text = plan(merged, capsys)
    assert "SortMergeJoin" not in text and text.count("ShuffledHashJoin") == 3


def test_lookup_is_broadcast_while_it_is_small(spark, capsys, monkeypatch):
    many = spark.range(1000).withColumnRenamed("id", "k")
    few = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(many.join(physical.lookup(few), "k"), capsys)
    monkeypatch.setattr(physical, "BROADCAST_ROWS", 9)
    joined = many.join(physical.lookup(few), "k")
    assert "ShuffledHashJoin" in plan(joined, capsys) and joined.count() == 10


def test_featured_table_is_written_as_joined(spark):
    assert not any("product_type=" in f for f in Workload(spark, SF_SMALL).featured.inputFiles())


def test_the_article_set_is_a_written_table(spark, capsys):
    kept = prepare.keep_repair_parts(prepare.merge(orders(spark), lines(spark)))
    # a small set is broadcast to the part rows, which stay where they are
    text = plan(kept, capsys)
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_header_cells_are_worked_out_once(spark, capsys):
    typed, _ = prepare.clean_headers(driver_tables.raw_header_view(spark, SF_SMALL))
    text = plan(typed, capsys, "extended").split("== Physical Plan ==")[0].split("== Optimized Logical Plan ==")[1]
    assert text.count("transform(") == 7  # one a date


def test_a_date_put_together_equals_the_formatted_one(spark):
    days = spark.range(600).select(
        F.when(F.col("id") % 7 > 0, (F.col("id") - 100) * 7919).alias("key"),
        F.expr("date_add(date'1996-02-27', cast((id - 300) * 9973 as int))").alias("day"),
    ).unionByName(spark.sql("SELECT 5L AS key, CAST(NULL AS date) AS day"))
    held = F.array("day")
    for shift in range(driver_tables.DATE_RENDER_CYCLE):
        new = driver_tables.render_date(F.col("day"), F.col("key"), shift)
        old = F.get(F.transform(held, lambda x: driver_tables._formatted(x, F.col("key"), shift)), 0)
        usual = (F.col("key") >= 0) & F.year("day").between(1, 9999)
        fast = F.get(F.transform(held, lambda x: driver_tables._put_together(x, F.col("key"), shift)), 0)
        assert days.where(~new.eqNullSafe(old) | (usual & ~fast.eqNullSafe(old))).count() == 0
