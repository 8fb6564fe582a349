import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from floortally.functions import durations, nested, numbers, periods, rules, text

c = F.col


def week_by_definition(day: dt.date) -> int:
    """Week 1 runs to the first Saturday; afterwards every Sunday starts a week."""
    week = 1
    for n in range(2, day.day + 1):
        if day.replace(day=n).weekday() == 6:
            week += 1
    return week


def test_calendar_columns_against_their_definitions(evaluate):
    days = [dt.date(2023, 12, 1) + dt.timedelta(n) for n in range(900)]
    got = evaluate(
        [(d,) for d in days],
        "d date",
        periods.month_start(c("d")),
        periods.monday_of(c("d")),
        periods.sunday_of(c("d")),
        periods.rolling_week_start(c("d")),
        periods.look_back_start(c("d")),
        periods.week_of_month(c("d")),
    )
    for day, (month, monday, sunday, rolling, look_back, week) in zip(days, got):
        first = day.replace(day=1)
        assert month == first
        assert monday == day - dt.timedelta(day.weekday())
        assert sunday == day - dt.timedelta((day.weekday() + 1) % 7)
        assert rolling == max(first, day - dt.timedelta(6))
        assert look_back == min(first, day - dt.timedelta(4))
        assert week == week_by_definition(day)
    assert max(week for *_, week in got) == 6


def test_day_labels_and_elapsed_days(evaluate):
    as_of = dt.date(2024, 3, 10)
    rows = [(as_of - dt.timedelta(n), as_of) for n in (-1, 0, 3, 4, 40)] + [(None, as_of)]
    assert [r[0] for r in evaluate(rows, "d date, a date", periods.day_label(c("d"), c("a")))] == [
        "D-X",
        "D-1",
        "D-4",
        "D-X",
        "D-X",
        None,
    ]
    ranges = [(dt.date(2024, 3, 3), dt.date(2024, 3, 9), as_of), (dt.date(2024, 3, 10), dt.date(2024, 3, 16), as_of)]
    ranges += [(dt.date(2024, 3, 17), dt.date(2024, 3, 23), as_of)]
    got = evaluate(ranges, "s date, e date, a date", periods.days_elapsed(c("s"), c("e"), c("a")))
    assert got == [(7,), (1,), (0,)]


def test_ordinals_and_date_texts(evaluate):
    got = [r[0] for r in evaluate([(n,) for n in range(1, 32)], "n int", periods.ordinal(c("n")))]
    assert got[:4] == ["1st", "2nd", "3rd", "4th"]
    assert got[10:13] == ["11th", "12th", "13th"]
    assert got[20:24] == ["21st", "22nd", "23rd", "24th"] and got[30] == "31st"
    dated = evaluate(
        [(dt.date(2025, 12, 1),)], "d date", periods.long_date(c("d")), periods.short_date(c("d"))
    )
    assert dated == [("1st Dec'25", "01-12-2025")]


def test_lenient_date_parsing(evaluate):
    rows = [("2024-01-02 03:04:05",), ("not a date",), (None,)]
    got = evaluate(rows, "x string", periods.parse_timestamp(c("x")), periods.parse_date(c("x")))
    assert got == [(dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2)), (None, None), (None, None)]


def test_dates_in_several_forms(spark, evaluate):
    noon = dt.datetime(2024, 1, 30, 12, 5)
    same = ["2024-01-30 12:05:00", "2024/1/30 12:05", "1/30/2024 12:05:00", "01-30-2024 12:05", "1/30/2024 12:05 PM", "30/01/2024 12:05"]
    same += ["30-1-2024 12:05:00", "30 Jan 2024 12:05", "30-Jan-2024 12:05:00", "Jan 30, 2024 12:05", " 1/30/2024 12:05 "]
    odd = ["1/2/2024", "13/13/2024", "30 Foo 2024", "2024-01-32", ""]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in (zone, "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = evaluate([(x,) for x in same + odd], "x string", periods.parse_timestamp(c("x")), periods.parse_date(c("x")))
            assert got[: len(same)] == [(noon, noon.date())] * len(same)
            assert got[len(same) :] == [(dt.datetime(2024, 1, 2), dt.date(2024, 1, 2))] + [(None, None)] * 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    day_first = periods.parse_date(c("x"), ["d/M/yyyy"])
    assert evaluate([("1/2/2024",), ("30 Jan 2024",)], "x string", day_first) == [(dt.date(2024, 2, 1),), (None,)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_half_even_matches_array_rounding(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for digits in (0, 1, 2):
        got = [r[0] for r in df.orderBy("i").select(numbers.half_even(c("v"), digits)).collect()]
        assert got == [float(np.round(v, digits)) for v in values]


def test_rounding_borders(evaluate):
    assert evaluate([(0.5,), (1.5,), (2.5,), (-0.5,)], "v double", numbers.half_even(c("v"))) == [
        (0.0,),
        (2.0,),
        (2.0,),
        (0.0,),
    ]
    rows = [(1, 400), (3, 400), (1, 0), (0, 5)]
    got = evaluate(rows, "n bigint, d bigint", numbers.sql_percent(c("n"), c("d"), 1), numbers.percent(c("n"), c("d"), 1))
    assert got == [(0.3, 0.2), (0.8, 0.8), (None, None), (0.0, 0.0)]
    assert evaluate([(1, 0)], "n bigint, d bigint", numbers.percent_or_zero(c("n"), c("d"))) == [(0.0,)]
    assert str(evaluate([("0.25",)], "v string", numbers.half_away(c("v").cast("decimal(10,4)")))[0][0])[:3] == "0.3"


def test_lenient_numbers(evaluate):
    rows = [("1,234.5",), ("12%",), ("-",), ("",), (" 7 ",), ("na",), (None,), ("-3.5%",)]
    got = [r[0] for r in evaluate(rows, "x string", numbers.parse_number(c("x")))]
    assert got == [1234.5, 12.0, None, None, 7.0, None, None, -3.5]


def test_guards(evaluate):
    rows = [(math.inf,), (math.nan,), (None,), (0.3,), (-2.0,), (5.0,)]
    got = evaluate(rows, "v double", numbers.finite_or_zero(c("v")), numbers.clamp01(c("v")))
    assert got == [(0.0, 1.0), (0.0, 0.0), (0.0, 0.0), (0.3, 0.3), (-2.0, 0.0), (5.0, 1.0)]
    assert evaluate([(0.25,)], "t double", numbers.interpolate(F.lit(10.0), F.lit(20.0), c("t"))) == [(12.5,)]


def test_interval_texts(evaluate):
    rows = [("00:03:00",), ("9:30:00",), ("26:10:05",), ("1 day 02:03:04",), ("2 days",), ("00:00:01.5",), ("x",), (None,)]
    rows += [("01:75:00",), ("00:00:00",)]
    got = [r[0] for r in evaluate(rows, "x string", durations.interval_seconds(c("x")))]
    assert got == [180.0, 34200.0, 94205.0, 93784.0, 172800.0, 1.5, None, None, None, 0.0]


def test_interval_grammar(evaluate):
    forms = {
        "12:30": 45000.0, "-00:10:00": -600.0, "+1:02:03": 3723.0, "1 day -2:00": 79200.0, "-1 days +02:00:00": -79200.0,
        "2 hours 3 mins 4.5 secs": 7384.5, "90 minutes": 5400.0, "1h30m": 5400.0, "1 hr 1 sec": 3601.0, "250 ms": 0.25, "1.5 hours": 5400.0,
        "300": 300.0, " -2.5 ": -2.5, "1 week 1 day": 691200.0, "1 mon": 2592000.0, "@ 1 minute 5 secs ago": -65.0, "1 Day 00:00:01": 86401.0,
        "- 5 hours": -18000.0, "0 days 00:03:00": 180.0, "1 year": 31557600.0, ".5 s": 0.5,
    }
    bad = ["", " ", "ago", "@", "1 fortnight", "12:", ":30", "1:2:3:4", "1 min 2 hours", "one hour", "10:60", "5 hoursx", "1 2", "hours", "--5"]
    got = evaluate([(x,) for x in [*forms, *bad]], "x string", durations.interval_seconds(c("x")))
    assert dict(zip(forms, (r[0] for r in got))) == forms
    assert [x for x, r in zip(bad, got[len(forms) :]) if r[0] is not None] == []


def test_clock_texts(evaluate):
    rows = [(0.0,), (102600.0,), (59.6,), (None,)]
    got = evaluate(rows, "s double", durations.clock_text(c("s")), durations.clock_text(c("s"), 1))
    assert got == [("00:00:00", "0:00:00"), ("28:30:00", "28:30:00"), ("00:01:00", "0:01:00"), (None, None)]


def test_shift_rules(evaluate):
    rows = [
        ("2024-01-01 10:00:00", "2024-01-01 20:00:00"),
        ("2024-01-01 10:00:00", "2024-01-01 11:00:00"),
        ("bad", "2024-01-01 11:00:00"),
        (None, None),
        ("2024-01-01 00:00:00", "2024-01-02 03:00:00"),
    ]
    got = evaluate(
        rows, "i string, o string", durations.shift_seconds(c("i"), c("o")), durations.shift_seconds(c("i"), c("o"), True)
    )
    assert got == [(30600.0, 30600.0), (34200.0, 34200.0), (34200.0, 34200.0), (34200.0, 34200.0), (91800.0, 5400.0)]
    days = evaluate([(3,)], "n int", durations.default_shift(c("n")), durations.default_shift(c("n"), True))
    assert days == [(102600.0, 16200.0)]


def test_shifts_ignore_clock_changes(spark, evaluate):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = [("2024-03-31 01:00:00", "2024-03-31 06:00:00")]
        assert evaluate(row, "i string, o string", durations.shift_seconds(c("i"), c("o"))) == [(12600.0,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_milliseconds_threshold_is_strict(evaluate):
    rows = [("180000",), ("180001",), ("n/a",), ("-5",), (None,)]
    got = evaluate(rows, "x string", durations.parse_milliseconds(c("x")) > 180000)
    assert [r[0] for r in got] == [False, True, None, False, None]


def test_json_arrays(spark):
    texts = [
        None,
        "[]",
        '[{"k":"a"}]',
        '[{"k":true},{"k":1.5},{"k":{"x":1}},{"z":2},{"k":null}]',
        "junk",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    got = df.select("i", nested.texts(df, "j", "k").alias("k")).orderBy("i").collect()
    assert [r.k for r in got] == [None, [], ["a"], ["true", "1.5", '{"x":1}', None, None], None]
    flags = df.select("i", nested.any_in(nested.texts(df, "j", "k"), ["a", "true"])).orderBy("i").collect()
    assert [r[1] for r in flags] == [False, False, True, True, False]
    typed = spark.createDataFrame([([{"k": "a"}, {"k": None}],)], "j array<map<string,string>>")
    assert typed.select(nested.texts(typed, "j", "k")).first()[0] == ["a", None]
    n = df.select("i", nested.occurrences(nested.texts(df, "j", "k"), "true")).orderBy("i").collect()
    assert [r[1] for r in n] == [0, 0, 0, 1, 0]


def test_malformed_integer_flags_raise(spark):
    df = spark.createDataFrame([('[{"k":"x"}]',)], "j string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(nested.int_field(nested.objects(df, "j", "k")[0], "k")).collect()


def test_blank_rules_at_their_borders(evaluate):
    rows = [
        (100.0, 10.0),
        (100.0, 9.9),
        (100.0, 100.0),
        (100.0, 101.0),
        (100.0, None),
        (0.0, 5.0),
        (None, 5.0),
    ]
    got = evaluate(rows, "d double, s double", *[rules.blank_file(c("d"), c("s"), r) for r in "abc"])
    assert got == [(0, 1, 0), (1, 1, 1), (0, 0, 0), (1, 1, 1), (1, 0, 0), (1, 1, 0), (1, 1, 0)]
    with pytest.raises(ValueError):
        rules.blank_file(c("d"), c("s"), "z")


def test_work_hours_and_same_day(evaluate):
    rows = [(f"20240101_{t}.wav",) for t in ("092959", "093000", "223000", "223001")]
    assert [r[0] for r in evaluate(rows, "f string", rules.recorded_in_hours(c("f")))] == [False, True, True, False]
    day = dt.date(2024, 1, 1)
    rows = [(day, day), (day, day + dt.timedelta(1)), (day, None)]
    got = evaluate(rows, "d date, u date", rules.same_day_upload(c("d"), c("u")))
    assert [r[0] for r in got] == [True, False, None]


def test_bands_and_comments(evaluate):
    rows = [(85.0,), (84.9,), (75.0,), (74.9,), (60.0,), (59.9,), (None,)]
    assert [r[0] for r in evaluate(rows, "v double", rules.band(c("v")))] == [
        "on_track",
        "watch",
        "watch",
        "behind",
        "behind",
        "critical",
        None,
    ]
    rows = [(8.1, 84.9), (8.0, 85.0), (9.0, None), (None, 10.0), (None, None)]
    got = [r[0] for r in evaluate(rows, "b double, a double", rules.comment(c("b"), c("a")))]
    assert got == ["High Blank Files, Low Device Adherence", "", "High Blank Files", "Low Device Adherence", ""]


def test_texts(evaluate):
    assert evaluate([("  Two  Words ",)], "x string", text.slug(c("x"))) == [("two_words",)]
    assert evaluate([("price_issue",)], "x string", text.title(c("x"))) == [("Price Issue",)]
    rows = [("/audio/x/T0012/1",), ("/audio/none/1",), (None,)]
    assert [r[0] for r in evaluate(rows, "p string", text.device_code(c("p")))] == ["t0012", None, None]
    rows = [(3.0,), (2.5,), (None,)]
    got = evaluate(rows, "v double", text.dash_if_missing(c("v")), text.percent_text(c("v")))
    assert got == [("3", "3.0%"), ("2.5", "2.5%"), ("-", None)]
    assert [r[0] for r in evaluate([("a",), (" ",), (None,)], "x string", text.not_blank(c("x")))] == [True, False, False]
    assert evaluate([(7,)], "n int", text.zero_pad(c("n"), 2)) == [("07",)]
