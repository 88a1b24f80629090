import datetime as dt

from pyspark.sql import functions as F

from servicelens.functions import dates, scalar
from servicelens.operators import prepare


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r.y for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_drop_third_char(spark):
    assert col_values(spark, ["12.345.1", "ab", ""], scalar.drop_third_char) == ["12345.1", "ab", ""]


def test_decimal_comma(spark):
    assert col_values(spark, ["1,5", "1.234,5", "abc", "2", " 3,25 "], scalar.decimal_comma) == [1.5, None, None, 2.0, 3.25]


def test_address_split(spark):
    df = spark.createDataFrame([("12345.10",), ("12345",), ("1.2.3",)], "address_code string")
    rows = prepare.split_address(df).collect()
    assert [(r.customer_no, r.contact_no, r.address_ok) for r in rows] == [
        ("12345", "10", True), ("12345", None, True), (None, None, False)
    ]


def test_parse_timestamp(spark):
    got = col_values(spark, ["01.07.2017", "1.1.2017", "2017-07-01 10:00:00.5", "01.07.17", "31.02.2017", "001.07.2017"],
                     dates.parse_timestamp)
    assert got[:3] == [dt.datetime(2017, 7, 1), dt.datetime(2017, 1, 1), dt.datetime(2017, 7, 1, 10, 0, 0, 500000)]
    assert got[3:] == [None, None, None]


def test_parse_arg_date():
    assert dates.parse_arg_date("01.07.2017") == dt.date(2017, 7, 1)
    assert dates.parse_arg_date("1.12.2017") == dt.date(2017, 12, 1)
    import pytest

    with pytest.raises(ValueError):
        dates.parse_arg_date("2017-13-01")


def test_missing_markers_dropped(spark):
    raw = spark.createDataFrame(
        [("1", "12.345.1", "K0001", "T", *["01.07.2017"] * 7),
         ("2", "NA", "K0001", "T", *["01.07.2017"] * 7),
         ("3", "", "K0001", "T", *["01.07.2017"] * 7),
         ("4", "null", "K0001", "T", *["01.07.2017"] * 7),
         ("5", " NA", "K0001", "T", *["01.07.2017"] * 7)],
        "serviceauftrag string, adresse string, artikel string, typ string, datum_waein string, datum_repstart string,"
        " datum_repkv string, datum_kv string, datum_auftrag string, datum_repend string, datum_wausgang string",
    )
    typed, _ = prepare.clean_headers(raw)
    assert sorted(r.order_id for r in typed.collect()) == ["1", "5"]


def test_period_end_is_midnight(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 12, 31, 0, 0),), (dt.datetime(2018, 12, 31, 10, 0),), (None,)], "d timestamp_ntz"
    )
    assert dates.period_filter(df, "d", "01.01.2018", "31.12.2018").count() == 1


def test_quantity_quarantine(spark):
    raw = spark.createDataFrame([("1", "1", "K01", "n", "1,5"), ("1", "2", "K02", "n", "1.234,5")],
                                "SERVICEAUFTRAG string, POSITION string, ARTIKEL string, NAME string, MENGE string")
    good, bad = prepare.clean_positions(raw)
    assert [r.quantity for r in good.collect()] == [1.5]
    assert [r.quantity_raw for r in bad.collect()] == ["1.234,5"]


def test_bad_positions_and_addresses_are_reported(spark):
    raw = spark.createDataFrame([("1", " 7 ", "K01", "n", "1,5"), ("1", "x", "K02", "n", "2")],
                                "SERVICEAUFTRAG string, POSITION string, ARTIKEL string, NAME string, MENGE string")
    good, bad = prepare.clean_positions(raw)
    assert [r.position for r in good.collect()] == [7]
    assert [(r.part_no, r.reject_reason) for r in bad.collect()] == [("K02", "bad_position")]
    heads = spark.createDataFrame(
        [("1", "12x1.2.3", "K1", "T", *["01.07.2017"] * 7), ("2", "12x1.2.3", "K1", "T", "soon", *["01.07.2017"] * 6),
         ("3", "12x1.2", "K1", "T", *["01.07.2017"] * 7)],
        "serviceauftrag string, adresse string, artikel string, typ string, datum_waein string, datum_repstart string,"
        " datum_repkv string, datum_kv string, datum_auftrag string, datum_repend string, datum_wausgang string",
    )
    typed, bad = prepare.clean_headers(heads)
    assert typed.count() == 3
    assert sorted((r.order_id, r.reject_reason) for r in bad.collect()) == [("1", "bad_address"), ("2", "bad_address"), ("2", "unparsed_date")]


def _first_format(value: str):
    from servicelens import schema as S

    for fmt in S.DATE_FORMATS:
        try:
            return dt.datetime.strptime(value.strip(), fmt)
        except ValueError:
            continue
    return None


def test_parse_matches_formats_in_order(spark):
    samples = [
        "1-10-2017", "01-10-2017", "1.10.2017", "10/1/2017", "2017-1-10", "2017.01.10", "2017/1/1",
        "2017-07-01 10:00:00.123456", "2017-07-01 9:05:07", "2017-07-01 9:5", "01.07.2017 10:00",
        " 01.07.2017 ", "2017-07-01T10:00", "29.02.2019", "29.02.2020", "2017-13-01", "17-07-01",
        "01.07.2017 10:00:00", "2017-07-01 10", "", "abc", "0000-01-01", "01.01.0000", "0001-01-01", "2017-07/01",
        "2017-07-01  10:00", "2017-07-01 24:00", "2017-07-01 10:00:60", "2017-07-01 10:00:00.1234567", "1.1.2017 1:2", "+2017-07-01",
    ]
    got = col_values(spark, samples, dates.parse_timestamp)
    assert got == [_first_format(v) for v in samples]
