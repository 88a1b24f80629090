import os
import tempfile

from servicelens.plans import runs
from servicelens.sources import csv as csvio
from servicelens.sources import driver_tables as dt

from conftest import SF_SMALL


def test_end_to_end_run(spark):
    base = tempfile.mkdtemp(prefix="servicelens-run-")
    csvio.write_csv(dt.raw_header_view(spark, SF_SMALL), f"{base}/raw/kopf", sep=";")
    csvio.write_csv(dt.raw_position_view(spark, SF_SMALL), f"{base}/raw/pos", sep=";")
    out = f"{base}/out"
    runs.main(spark, f"{base}/raw/kopf", f"{base}/raw/pos", out, "BUILDING", "01.01.1995", "31.12.2001",
              min_support=0.1, min_threshold=0.4, watch=None, item_col="part_no")
    res = f"{out}/results"
    for sub in ["preprocessed", "descriptive/time_periods", "descriptive/process", "diagnostic/part_clusters",
                "diagnostic/component_rules", "predictive/sequences"]:
        assert os.path.isdir(f"{res}/{sub}"), sub
    time_row = spark.read.option("header", True).csv(f"{res}/descriptive/time_periods").first()
    assert int(time_row["n_orders"]) > 0
    # stages are write-once: a second run reuses them
    assert csvio.write_stage(spark.range(1), f"{out}/stages/featured") is False


def test_ragged_rows_and_line_breaks_in_a_run(spark, tmp_path):
    """An export with long and short rows and a line break in a part's name:
    the odd rows are in quarantine, the others all arrive."""
    from servicelens import schema as S

    heads, lines = list(S.HEADER_SOURCE_COLUMNS), list(S.POSITION_SOURCE_COLUMNS)
    day = ["01.07.2017"] * 7
    kopf = [["1", "12.345.1", "A1", "T", *day], ["2", "12.345.1", "A2", "T", *day], ["3", "12.345.1", "A3", "T", *day, "extra"], ["4", "12.345.1"]]
    pos = [["1", "1", "K0001", '"pump\nlong"', "1,5"], ["2", "1", "K0002", "seal", "2"], ["2", "2", "K0003", "nut", "1", "extra"], ["2", "3"]]
    for name, head, rows in (("kopf.csv", heads, kopf), ("pos.csv", lines, pos)):
        (tmp_path / name).write_text("\n".join(";".join(r) for r in [head, *rows]) + "\n")
    out = str(tmp_path / "out")
    parts = runs.preprocessing(spark, str(tmp_path / "kopf.csv"), str(tmp_path / "pos.csv"), out, sep=";", multi_line=True)
    assert sorted((r.order_id, r.part_no, r.part_name, r.quantity) for r in parts.collect()) == [
        ("1", "K0001", "pump\nlong", 1.5), ("2", "K0002", "seal", 2.0)
    ]
    bad = csvio.read_stage(spark, f"{out}/stages/quarantine").collect()
    assert sorted(map(tuple, bad)) == [("2", "ragged_row"), ("2", "ragged_row"), ("3", "ragged_row"), ("4", "ragged_row")]


def test_scratch_is_released(spark):
    from servicelens.plans import physical
    from servicelens.session import _SCRATCH, release_scratch

    others = list(_SCRATCH)
    _SCRATCH.clear()
    path = physical.materialize(spark.range(5), "t").inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    assert release_scratch(spark) == 1 and not os.path.exists(path) and not _SCRATCH
    _SCRATCH.extend(others)


def test_discard_removes_only_materialised_tables(spark, tmp_path):
    from servicelens.plans import physical
    from servicelens.session import _SCRATCH

    one, two = (physical.materialize(spark.range(k), "t") for k in (5, 6))
    spark.range(3).write.parquet(str(tmp_path / "input"))
    before = len(_SCRATCH)
    physical.discard(one, spark.read.parquet(str(tmp_path / "input")))
    assert len(_SCRATCH) == before - 1 and two.count() == 6
    assert spark.read.parquet(str(tmp_path / "input")).count() == 3
    assert not os.path.exists(one.inputFiles()[0].removeprefix("file://"))
    physical.discard(two)


def test_a_changed_input_is_seen(spark, tmp_path):
    from servicelens.plans.workload import Workload

    spark.range(1).write.parquet(str(tmp_path / "a.parquet"))
    first = Workload(spark, str(tmp_path))
    assert Workload(spark, str(tmp_path)) is first
    spark.range(2).write.parquet(str(tmp_path / "b.parquet"))
    assert Workload(spark, str(tmp_path)) is not first
