"""Date parsing, period arguments, month buckets and period coverage."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelens import schema as S

# strptime directive -> (Spark datetime pattern letter, strict regex piece).
_DIRECTIVES = {
    "%d": ("d", "(0?[1-9]|[12][0-9]|3[01])"),
    "%m": ("M", "(0?[1-9]|1[0-2])"),
    "%Y": ("yyyy", "[0-9]{4}"),
    "%H": ("H", "([01]?[0-9]|2[0-3])"),
    "%M": ("m", "[0-5]?[0-9]"),
    "%S": ("s", "[0-5]?[0-9]"),
    "%f": ("SSSSSS", "[0-9]{1,6}"),
}


def spark_pattern(fmt: str) -> tuple[str, str]:
    """Translate a strptime format into (Spark pattern, anchored regex).

    Spark's one-letter fields accept one or two digits like strptime, but
    also longer zero-padded input ("001.07.2017"); the regex guard rejects it.
    """
    pattern, regex, i = [], ["^"], 0
    while i < len(fmt):
        tok = fmt[i : i + 2]
        if tok in _DIRECTIVES:
            p, r = _DIRECTIVES[tok]
            pattern.append(p)
            regex.append(r)
            i += 2
        else:
            ch = fmt[i]
            pattern.append(f"'{ch}'" if ch.isalpha() else ch)
            regex.append(re.escape(ch))
            i += 1
    regex.append("$")
    return "".join(pattern), "".join(regex)


_DAY_FIRST = re.compile(r"%d([-./])%m\1%Y( %H:%M(:%S([.]%f)?)?)?")
_YEAR_FIRST = re.compile(r"%Y([-./])%m\1%d( %H:%M(:%S([.]%f)?)?)?")


def _numeric_family(formats) -> bool:
    """Whether all formats are day-month-year or year-month-day with one
    separator, and a time at most."""
    return all(_DAY_FIRST.fullmatch(f) or _YEAR_FIRST.fullmatch(f) for f in formats)


def _parse_family(s: Column, formats) -> Column:
    """One anchored pattern of all formats guards one cast: the date's fields
    are put into year-month-day order, the time follows as it is.  No two of
    the formats read one text differently, so their order does not matter."""
    # as strptime, a blank of a format stands for any number of them
    pattern = "|".join(spark_pattern(f)[1].replace(re.escape(" "), "[ ]+") for f in formats)
    date = F.translate(F.substring_index(s, " ", 1), "./", "--")
    time = F.substring_index(s, " ", -1)  # the date itself where there is no time
    first, last = F.substring_index(date, "-", 1), F.substring_index(date, "-", -1)
    month = F.substring_index(F.substring_index(date, "-", 2), "-", -1)
    year_first = F.length(first) == 4
    iso = F.when(year_first, date).otherwise(F.concat_ws("-", last, month, first))
    iso = F.when(F.contains(s, F.lit(" ")), F.concat_ws(" ", iso, time)).otherwise(iso)
    no_year = F.when(year_first, first).otherwise(last) == "0000"
    return F.when(s.rlike(pattern) & ~no_year, iso).try_cast(T.TimestampNTZType())


def _parse_in_order(s: Column, formats) -> Column:
    """The first format whose guard matches and that parses."""
    tries = []
    for fmt in formats:
        pattern, regex = spark_pattern(fmt)
        tries.append(F.when(s.rlike(regex), F.try_to_timestamp(s, F.lit(pattern))))
    return F.coalesce(*tries).cast(T.TimestampNTZType())


def parse_timestamp(c: Column, formats=S.DATE_FORMATS) -> Column:
    """First format that matches wins; NULL when none does.

    Result type is TIMESTAMP_NTZ (wall-clock, no zone).  Numeric formats of
    the usual two orders are read by one guarded cast, in generated code;
    other formats one after the other.
    """
    s = F.trim(c.cast("string"))
    return _parse_family(s, formats) if _numeric_family(formats) else _parse_in_order(s, formats)


def parse_arg_date(value: str, formats=S.ARG_DATE_FORMATS) -> _dt.date:
    """Validate and parse a period argument (T10).  Driver-side, one value."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    for fmt in formats:
        try:
            return _dt.datetime.strptime(value.strip(), fmt).date()
        except ValueError:
            continue
    raise ValueError(f"date {value!r} matches none of the formats {list(formats)}")


def _literal_like(df: DataFrame, col: str, day: _dt.date) -> Column:
    """Literal of ``day`` at midnight, typed like ``col`` so the comparison
    stays a plain column-vs-literal predicate (pushed down to Parquet)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.DateType):
        return F.lit(day)
    ts = F.lit(_dt.datetime.combine(day, _dt.time()))
    if isinstance(dtype, T.TimestampNTZType):
        return ts.cast(T.TimestampNTZType())
    return ts.cast(dtype)


def period_filter(df: DataFrame, col: str, start, end) -> DataFrame:
    """Inclusive period filter on a typed date column.

    The end bound is midnight, so later times on the end day fall out;
    NULL dates fall out too.
    """
    lo, hi = parse_arg_date(start), parse_arg_date(end)
    return df.where((F.col(col) >= _literal_like(df, col, lo)) & (F.col(col) <= _literal_like(df, col, hi)))


def month_start(c: Column) -> Column:
    """First day of the month."""
    return F.trunc(c.cast("date"), "month")


def coverage(df: DataFrame, col: str, start, end, by: str | None = None) -> DataFrame:
    """Period coverage (T11, A13): does the data reach the requested bounds?

    One aggregate; the original only printed a warning, this returns it.
    """
    lo, hi = parse_arg_date(start), parse_arg_date(end)
    d = F.col(col).cast("date")
    aggs = [F.min(d).alias("min_date"), F.max(d).alias("max_date")]
    out = df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)
    return out.select(
        *([by] if by else []),
        F.lit(lo).alias("start_date"),
        F.lit(hi).alias("end_date"),
        "min_date",
        "max_date",
        (F.col("min_date") <= F.lit(lo)).alias("start_covered"),
        (F.col("max_date") >= F.lit(hi)).alias("end_covered"),
    )
