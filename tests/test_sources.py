import tempfile

from pyspark.sql import functions as F

import pytest

from servicelens.operators import prepare
from servicelens.sources import csv as csvio
from servicelens.sources import driver_tables as dt

from conftest import SF_SMALL


def test_csv_round_trip_with_sniffed_delimiter(spark):
    base = tempfile.mkdtemp(prefix="servicelens-csv-")
    raw_h = dt.raw_header_view(spark, SF_SMALL)
    raw_p = dt.raw_position_view(spark, SF_SMALL)
    csvio.write_csv(raw_h, f"{base}/kopf", sep=";")
    csvio.write_csv(raw_p, f"{base}/pos", sep=";")
    assert csvio.sniff_delimiter(spark, f"{base}/pos") == ";"
    back_h = csvio.read_csv(spark, f"{base}/kopf")
    back_p = csvio.read_csv(spark, f"{base}/pos")
    assert back_h.columns == raw_h.columns and back_p.columns == raw_p.columns
    h1, _ = prepare.clean_headers(back_h)
    h2, _ = prepare.clean_headers(raw_h)
    assert _rows(h1) == _rows(h2)
    p1, bad1 = prepare.clean_positions(back_p)
    p2, bad2 = prepare.clean_positions(raw_p)
    assert _rows(p1) == _rows(p2) and bad1.count() == bad2.count() > 0


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_stage_written_once(spark):
    base = tempfile.mkdtemp(prefix="servicelens-stage-")
    df = spark.range(5).withColumn("part", F.col("id") % 2)
    assert csvio.write_stage(df, f"{base}/s", ["part"]) is True
    assert csvio.write_stage(spark.range(9), f"{base}/s") is False
    assert csvio.read_stage(spark, f"{base}/s").count() == 5


def test_delimiter_profile_prefers_consistent(spark):
    lines = spark.createDataFrame([("a;b;1,5",), ("c;d;2",), ("e;f;3,0,1",)], "value string")
    prof = {r.delimiter: r for r in csvio.delimiter_profile(lines).collect()}
    assert prof[";"].chosen and prof[";"].consistent and not prof[","].consistent


def test_half_written_stage_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "s")
    (tmp_path / "s" / "_temporary" / "0").mkdir(parents=True)
    assert csvio.write_stage(spark.range(3), path) is True
    assert csvio.read_stage(spark, path).count() == 3
    assert csvio.write_stage(spark.range(9), path) is False


def test_quotes_are_doubled_both_ways(spark, tmp_path):
    df = spark.createDataFrame([('Ring "A";x', "1"), ("plain", "2"), ("a, b; c", '""')], "name string, n string")
    csvio.write_csv(df, str(tmp_path / "q"), sep=";")
    text = "".join(p.read_text() for p in sorted((tmp_path / "q").glob("part-*")))
    assert '"Ring ""A"";x"' in text
    assert sorted(map(tuple, csvio.read_csv(spark, str(tmp_path / "q"), sep=";").collect())) == sorted(map(tuple, df.collect()))


def test_line_breaks_in_cells_and_ragged_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n;t\n1;"two\nlines"\n2;x\n')
    got = csvio.read_csv(spark, str(tmp_path / "a.csv"), sep=";", multi_line=True).collect()
    assert [tuple(r) for r in got] == [("1", "two\nlines"), ("2", "x")]
    (tmp_path / "b.csv").write_text("n;t\n1;a\n2\n3;b;c\n")
    got = csvio.read_csv(spark, str(tmp_path / "b.csv"), sep=";", ragged="bad").collect()
    assert [r.bad for r in got] == [None, "2", "3;b;c"]


def test_header_with_byte_order_mark_and_quotes(spark, tmp_path):
    (tmp_path / "c.csv").write_text('\ufeff"n;1";t\n1;a\n', encoding="utf-8")
    got = csvio.read_csv(spark, str(tmp_path / "c.csv"), sep=";")
    assert got.columns == ["n;1", "t"] and got.count() == 1


def test_swapped_header_is_an_error(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("name;no\nx;1\n")
    (tmp_path / "d" / "b.csv").write_text("no;name\n2;y\n")
    with pytest.raises(Exception, match="header"):
        csvio.read_csv(spark, str(tmp_path / "d"), sep=";").collect()


def test_quoted_delimiters_are_not_counted(spark):
    lines = spark.createDataFrame([('a;b;"Ring, 4,5 x 7, x, y, z"',), ('c;d;"e;f"',), ("g;h;i",)], "value string")
    prof = {r.delimiter: r for r in csvio.delimiter_profile(lines).collect()}
    assert prof[";"].chosen and prof[";"].consistent


def test_materialize_keeps_columns_and_rows(spark):
    from servicelens.plans import physical

    df = spark.range(20).withColumn("g", F.col("id") % 3).select("g", "id")
    out = physical.materialize(df, "t", partition_by=["g"])
    assert out.columns == ["g", "id"] and out.count() == 20


def test_records_across_splits_equal_the_whole_file_read(spark, tmp_path):
    """One file in many splits, with breaks inside cells at all places of them."""
    import random

    rng = random.Random(2)
    cells = ["plain", "", 'a "quoted" word', "two\nlines", "\n", "x;y", 'end "\n"', "many\n\n\nlines;" * 20, " NA", '""', "\n" * 90]
    rows = [[str(i), rng.choice(cells), rng.choice(cells)] for i in range(700)]
    quote = lambda c: '"' + c.replace('"', '""') + '"' if any(x in c for x in ';"\n') else c
    (tmp_path / "in").mkdir()
    for name, part in (("a.csv", rows[:500]), ("b.csv", rows[500:]), ("c.csv", [])):
        text = "\n".join(";".join(map(quote, r)) for r in [["no", "one cell", "two"], *part])
        (tmp_path / "in" / name).write_text(text + "\n" * (name != "b.csv"))
    whole = spark.read.options(header=True, sep=";", escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    whole = [tuple(x or "" for x in r) for r in whole.csv(str(tmp_path / "in")).collect()]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for splits in ("300b", "4k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", splits)
            got = csvio.read_csv(spark, str(tmp_path / "in"), sep=";", multi_line=True)
            assert got.columns == ["no", "one cell", "two"]
            assert sorted(tuple(x or "" for x in r) for r in got.collect()) == sorted(whole) == sorted(map(tuple, rows))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_ragged_rows_among_records_with_line_breaks(spark, tmp_path):
    (tmp_path / "b.csv").write_text('n;t\n1;"a\nb"\n2\n3;b;c\n4;"x\ny";z\n')
    got = csvio.read_csv(spark, str(tmp_path / "b.csv"), sep=";", multi_line=True, ragged="bad").collect()
    assert sorted((r.n, r.bad) for r in got) == [("1", None), ("2", "2"), ("3", "3;b;c"), ("4", '4;"x\ny";z')]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("n;t\n1;2\n")
    (tmp_path / "d" / "b.csv").write_text("t;n\n1;2\n")
    with pytest.raises(ValueError, match="header"):
        csvio.read_csv(spark, str(tmp_path / "d"), sep=";", multi_line=True)
