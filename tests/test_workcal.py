import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from servicelens.functions import workcal

HOLIDAYS = set(workcal.rhineland_palatinate_dates(1990, 2030))


def brute(a: dt.date, b: dt.date) -> int:
    lo, hi = min(a, b), max(a, b)
    n, d = 0, lo + dt.timedelta(days=1)
    while d <= hi:
        if d.weekday() < 5 and d not in HOLIDAYS:
            n += 1
        d += dt.timedelta(days=1)
    return n


def wd(spark, years, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    out = workcal.with_working_days(df, "a", "b", "wd", years)
    return {(r.a, r.b): r.wd for r in out.collect()}


D = dt.date


def test_fixture_cases(spark, years):
    cases = {
        (D(2017, 7, 7), D(2017, 7, 10)): 1,   # Friday -> Monday
        (D(2017, 7, 7), D(2017, 7, 7)): 0,    # same day
        (D(2017, 7, 10), D(2017, 7, 7)): 1,   # reversed
        (D(2017, 4, 13), D(2017, 4, 18)): 1,  # Good Friday and Easter Monday skipped
        (D(2017, 10, 30), D(2017, 11, 2)): 1, # one-off 31.10.2017 and 1.11 skipped
        (D(2017, 7, 1), D(2021, 7, 1)): 1003,
    }
    got = wd(spark, years, list(cases))
    assert got == cases


def test_easter_dates():
    got = {y: workcal._easter_date(y) for y in (2016, 2017, 2021, 2024, 2025)}
    assert got == {2016: D(2016, 3, 27), 2017: D(2017, 4, 16), 2021: D(2021, 4, 4),
                   2024: D(2024, 3, 31), 2025: D(2025, 4, 20)}


def test_holiday_table_as_argument(spark, years):
    """The table built by Spark equals the local one; days of every word of
    the year, the last of a leap year included, and repeated and null holidays."""
    rows = [(h,) for h in sorted(HOLIDAYS)] + [(None,), (D(2017, 10, 31),)]
    made = workcal.year_table(spark.createDataFrame(rows, "holiday date"), 1990, 2030)
    row = lambda t: {r.year: (list(r.words), [n - r.holidays_before[0] for n in r.holidays_before]) for r in t.where("year between 1990 and 2030").collect()}
    assert row(made) == row(years)
    own = {D(2024, 3, 4), D(2024, 3, 5), D(2024, 5, 7), D(2024, 7, 10), D(2024, 12, 30), D(2024, 12, 31), D(2025, 1, 1), D(2024, 3, 9)}
    table = workcal.year_table(spark.createDataFrame([(h,) for h in own], "holiday date"))
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(0, 372)]
    got = wd(spark, table, [(D(2023, 12, 29), d) for d in days])
    n = 0
    for d in days:
        n += d.weekday() < 5 and d not in own
        assert got[D(2023, 12, 29), d] == n


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.dates(D(1995, 1, 1), D(2025, 12, 31)), st.dates(D(1995, 1, 1), D(2025, 12, 31))),
                min_size=1, max_size=40))
def test_matches_brute_force(spark, years, pairs):
    got = wd(spark, years, pairs)
    for a, b in pairs:
        assert got[(a, b)] == brute(a, b)
        assert got[(a, b)] == got.get((b, a), brute(b, a))


def test_null_dates(spark, years):
    df = spark.createDataFrame([(D(2017, 1, 2), None)], "a date, b date")
    assert workcal.with_working_days(df, "a", "b", "wd", years).first().wd is None


def test_lead_time_inflated_by_disorder(spark, years):
    from servicelens import schema as S

    dates = [D(2017, 7, 3), D(2017, 7, 10), D(2017, 7, 5), D(2017, 7, 12), D(2017, 7, 12), D(2017, 7, 13), D(2017, 7, 14)]
    df = spark.createDataFrame([tuple(dates)], ", ".join(f"{c} date" for c in S.STAGE_DATES))
    row = workcal.with_stage_durations(df, years).first()
    assert row[S.LEAD_TIME] > brute(dates[0], dates[-1])
    assert row[S.LEAD_TIME] == sum(row[c] for c in S.STAGE_DURATIONS)


def test_calendar_join_is_broadcast(spark, years):
    df = spark.createDataFrame([(D(2017, 1, 2), D(2017, 2, 2))], "a date, b date")
    plan = workcal.with_working_days(df, "a", "b", "wd", years)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_index_is_in_generated_code(spark, years):
    """No lambda over a year's holidays: the plan is generated code throughout."""
    df = spark.createDataFrame([(D(2017, 1, 2), D(2017, 2, 2))], "a date, b date")
    plan = workcal.with_working_days(df, "a", "b", "wd", years)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
