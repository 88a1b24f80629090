"""Working-day calendar.

A working day is Monday to Friday and not a public holiday.  The number of
working days between two dates counts the days in the half-open interval
``(min, max]``: reversed arguments give the same count, equal dates give 0,
time of day is ignored.

Instead of walking day by day, every date ``d`` gets a *working-day index*
``P(d)`` = number of working days from a fixed origin up to ``d``, so that
``wd(a, b) = |P(b) - P(a)|``.  ``P`` splits into

* weekdays up to ``d`` - plain integer arithmetic from the origin
  0001-01-01 (a Monday), and
* weekday holidays up to ``d`` - a year's holidays are six 64-bit words with
  one bit a day, each with the number of holidays before it (those of earlier years
  included); a date adds the bits of its own word up to its own day.

The words are a *year table* with one row per calendar year (at most
9,999 rows whatever the data size), so it is broadcast to every task and each
date costs one hash lookup and one bit count, all in generated code.  Holidays are a table argument: any region or
company calendar works without code changes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from servicelens import schema as S

FIRST_YEAR = 1
LAST_YEAR = 9999

# ---------------------------------------------------------------------------
# Public holidays of Rhineland-Palatinate (Germany).
# Month/day holidays, Easter offsets in days, and one-off holidays.
# ---------------------------------------------------------------------------
RLP_FIXED_HOLIDAYS = (
    (1, 1),    # New Year's Day
    (5, 1),    # Labour Day
    (10, 3),   # Day of German Unity
    (11, 1),   # All Saints' Day
    (12, 25),  # Christmas Day
    (12, 26),  # Second Day of Christmas
)
RLP_EASTER_OFFSETS = (
    -2,  # Good Friday
    1,   # Easter Monday
    39,  # Ascension Day
    50,  # Whit Monday
    60,  # Corpus Christi
)
RLP_ONE_OFF_HOLIDAYS = (
    _dt.date(2017, 10, 31),  # 500th anniversary of the Reformation
)

# 0001-01-01, a Monday in the proleptic Gregorian calendar.
_ORIGIN_SQL = "0001-01-01"


def _easter_date(y: int) -> _dt.date:
    """Gregorian Easter Sunday (anonymous algorithm) for one year."""
    a, b, c = y % 19, y // 100, y % 100
    d, e = b // 4, b % 4
    f = (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    ll = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * ll) // 451
    n = h + ll - 7 * m + 114
    return _dt.date(y, n // 31, n % 31 + 1)


def rhineland_palatinate_dates(first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR):
    """Holiday dates of the rules for a year range (a calendar dimension,
    independent of the data)."""
    for y in range(first_year, last_year + 1):
        for m, d in RLP_FIXED_HOLIDAYS:
            yield _dt.date(y, m, d)
        e = _easter_date(y)
        for off in RLP_EASTER_OFFSETS:
            h = e + _dt.timedelta(days=off)
            if h.year == y:
                yield h
    for h in RLP_ONE_OFF_HOLIDAYS:
        if first_year <= h.year <= last_year:
            yield h


def weekday_index(d: Column) -> Column:
    """Number of Mondays-to-Fridays in ``[0001-01-01, d]``."""
    n = F.datediff(d, F.lit(_ORIGIN_SQL).cast("date"))
    return 5 * F.floor(n / 7) + F.least(n % 7 + 1, F.lit(5))


_YEAR_TABLE_SCHEMA = "year int, words array<long>, holidays_before array<long>"
_WORDS = 6  # of 64 days


def _year_rows(holiday_dates, first_year: int, last_year: int):
    per_year: dict[int, set] = {}
    for h in holiday_dates:
        if h is not None and h.weekday() < 5 and first_year <= h.year <= last_year:
            per_year.setdefault(h.year, set()).add(h.timetuple().tm_yday - 1)
    rows, total = [], 0
    for y in range(first_year, last_year + 1):
        words, before = [0] * _WORDS, [0] * _WORDS
        for day in per_year.get(y, ()):
            words[day // 64] |= 1 << day % 64
        for i, word in enumerate(words):
            before[i] = total
            total += word.bit_count()
        # signed, as Spark's 64-bit integers are
        rows.append((y, [w - (1 << 64) if w >> 63 else w for w in words], before))
    return rows


def year_table(holidays: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """One row per year: its weekday holidays as bits of six words, and for
    every word the number of weekday holidays before it.

    Columns: ``year`` INT, ``words`` and ``holidays_before`` ARRAY<BIGINT>.
    Built by Spark from any holiday table: distinct weekday dates as bits by
    year and word, then a running count over the words (at most 59,994 rows).
    """
    spark = holidays.sparkSession
    day = F.col("holiday").cast("date")
    distinct = holidays.select(day.alias("h"), F.year(day).alias("year")).where(
        F.col("h").isNotNull() & (F.weekday("h") < 5) & F.col("year").between(first_year, last_year)
    ).distinct()
    at = F.dayofyear("h") - 1
    bits = distinct.groupBy("year", F.expr("(dayofyear(h) - 1) div 64").cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at % 64)).alias("bits"), F.count(F.lit(1)).alias("n")
    )
    places = spark.range(first_year * _WORDS, (last_year + 1) * _WORDS).select(
        F.expr(f"int(id div {_WORDS})").alias("year"), (F.col("id") % _WORDS).cast("int").alias("word")
    )
    earlier = Window.orderBy("year", "word").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(earlier), F.lit(0)).cast("long")
    words = places.join(bits, ["year", "word"], "left").select("year", "word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"), before.alias("before"))
    table = words.groupBy("year").agg(F.sort_array(F.collect_list(F.struct("word", "bits", "before"))).alias("w"))
    return table.select("year", F.col("w.bits").alias("words"), F.col("w.before").alias("holidays_before")).cache()


def _local_table(spark: SparkSession, rows) -> DataFrame:
    """The year table as a local relation (built from Arrow batches on the
    driver; no Python worker), cached because every stage date joins it."""
    import pandas as pd

    pdf = pd.DataFrame(rows, columns=["year", "words", "holidays_before"])
    df = spark.createDataFrame(pdf, _YEAR_TABLE_SCHEMA).cache()
    df.count()
    return df


_DEFAULT_YEAR_TABLES: dict[int, DataFrame] = {}


def default_year_table(spark: SparkSession) -> DataFrame:
    """Year table of the Rhineland-Palatinate calendar (one per session)."""
    key = id(spark)
    cached = _DEFAULT_YEAR_TABLES.get(key)
    if cached is None or cached.sparkSession is not spark:
        rows = _year_rows(rhineland_palatinate_dates(), FIRST_YEAR, LAST_YEAR)
        _DEFAULT_YEAR_TABLES[key] = _local_table(spark, rows)
    return _DEFAULT_YEAR_TABLES[key]


def _join_year(df: DataFrame, d: Column, tag: str, years: DataFrame) -> tuple[DataFrame, Column]:
    """Broadcast-join the year table on ``year(d)``; return the frame and
    the working-day index expression of ``d`` over the joined columns."""
    yt = F.broadcast(
        years.select(
            F.col("year").alias(f"{tag}_y"),
            F.col("words").alias(f"{tag}_w"),
            F.col("holidays_before").alias(f"{tag}_b"),
        )
    )
    joined = df.join(yt, F.year(d) == F.col(f"{tag}_y"), "left")
    at = F.dayofyear(d) - 1
    word = F.call_function("shiftright", at, F.lit(6))
    # the bits of the date's word up to its own day
    mask = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(63) - at.bitwiseAND(F.lit(63)))
    own = F.bit_count(F.get(f"{tag}_w", word).bitwiseAND(mask))
    return joined, (weekday_index(d) - F.get(f"{tag}_b", word) - own).cast("long")


def _with_indexes(df: DataFrame, date_cols, years: DataFrame):
    """Join the year table once per date column (broadcast hash joins, no
    shuffle) and return (frame, index expressions, helper columns)."""
    idx, helpers = [], []
    for i, c in enumerate(date_cols):
        tag = f"__wc{i}"
        df, expr = _join_year(df, F.col(c).cast("date"), tag, years)
        idx.append(expr)
        helpers += [f"{tag}_y", f"{tag}_w", f"{tag}_b"]
    return df, idx, helpers


def with_working_days(
    df: DataFrame, start_col: str, end_col: str, out_col: str, years: DataFrame
) -> DataFrame:
    """Add ``out_col`` = working days between two date columns."""
    cols = df.columns
    joined, (a, b), _ = _with_indexes(df, [start_col, end_col], years)
    return joined.select(*cols, F.abs(b - a).alias(out_col))


def with_stage_durations(df: DataFrame, years: DataFrame, dates=None) -> DataFrame:
    """Six stage durations over consecutive stage dates plus their sum (T4, T5).

    One index lookup per stage date (seven, not twelve); durations are
    differences of neighbouring indexes.  The lead time is the sum of the six
    with missing stages skipped, so out-of-order dates inflate it exactly as
    the unsigned stage counts do.
    """
    dates = list(dates or S.STAGE_DATES)
    cols = df.columns
    joined, idx, _ = _with_indexes(df, dates, years)
    names = [f"wd_{S.STAGE_SHORT.get(a, a)}_{S.STAGE_SHORT.get(b, b)}" for a, b in zip(dates, dates[1:])]
    durations = [F.abs(q - p) for p, q in zip(idx, idx[1:])]
    lead = sum((F.coalesce(x, F.lit(0)) for x in durations), F.lit(0)).cast("long")
    return joined.select(*cols, *[x.alias(n) for x, n in zip(durations, names)], lead.alias(S.LEAD_TIME))


def working_days_between(spark: SparkSession, start: _dt.date, end: _dt.date, years: DataFrame) -> DataFrame:
    """One-row DataFrame ``wd`` for two literal dates."""
    one = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    return with_working_days(one, "a", "b", "wd", years).select("wd")
