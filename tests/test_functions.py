"""Column functions against plain Python and numpy."""

import decimal
import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskpulse.functions import calendar, dates, text, values
from deskpulse.session import require_utc


def _column(spark, rows, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_hundredths_are_those_of_the_binary_value(spark):
    rng = random.Random(1)
    seconds = [432 + 864 * k for k in range(6000)]
    seconds += [rng.randrange(40_000_000) for _ in range(4000)] + list(range(900))
    seconds += [-s for s in seconds[:3000]]
    got = _column(spark, [float(s) for s in seconds], "double", text.hundredths_text)
    want = [f"{s / 86400:.2f}" if s else "0.00" for s in seconds]
    assert [x for x in zip(seconds, got, want) if x[1] != x[2]] == []


def test_net_hundredths(spark):
    rng = random.Random(2)
    rows = [(432.0 + 864 * rng.randrange(5000), float(rng.randrange(12))) for _ in range(4000)]
    df = spark.createDataFrame(rows, "s double, off double")
    got = df.select("s", "off", text.hundredths_text("s", "off").alias("t")).collect()
    wrong = [r for r in got if r.s / 86400 - r.off > 0 and r.t != f"{r.s / 86400 - r.off:.2f}"]
    assert wrong == []


def _float_texts(spark, numbers):
    df = spark.createDataFrame(list(enumerate(numbers)), "i int, v double")
    return [r.v for r in text.with_float_texts(df, "v").orderBy("i").collect()]


def test_float_text_is_the_shortest(spark):
    rng = random.Random(3)
    numbers = [n / 86400 for n in range(1, 20000)] + [float(n) for n in range(50)]
    numbers += [rng.random() * 10 ** rng.randrange(-12, 16) for _ in range(4000)]
    numbers += [1e-05, 1e16, 1e15, 12345678.0, 123456789012345.6, 0.0001, 1e22, 2.0**-44, -2.0**-44, -1e-7, -3.25]
    got = _float_texts(spark, numbers)
    wrong = [(n, g) for n, g in zip(numbers, got) if g != repr(n)]
    assert wrong == []
    specials = _float_texts(spark, [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, None])
    assert specials == ["nan", "inf", "-inf", "0.0", "-0.0", None]


def test_float_text_of_any_double(spark):
    rng = np.random.default_rng(4)
    numbers = rng.integers(0, 1 << 64, 100_000, dtype=np.uint64).view(np.float64)
    numbers = numbers[np.isfinite(numbers)]
    whole = rng.integers(1, 10**9, 20_000) * 10.0 ** rng.integers(-20, 25, 20_000)
    binary = 2.0 ** np.arange(-1074, 1024)
    numbers = np.concatenate([numbers, whole, binary, np.arange(1, 2000) * 5e-324, 2.0**53 + np.arange(-50, 50)])
    got = _float_texts(spark, numbers.tolist())
    wrong = [(n, g) for n, g in zip(numbers.tolist(), got) if g != repr(n)]
    assert wrong == []


def test_ticket_time(spark):
    texts = [
        "01/06/2020 08:00:00 +00:00",
        "1/6/2020 8:0:0 +00:00",
        "06/05/2020 09:00:00 AM +00:00",
        "06/05/2020 12:00:00 am +00:00",
        "06/05/2020 12:00:00 PM +00:00",
        "01/06/2020   08:00:00  +00:00",
        "13/05/2020 09:00:00 PM +00:00",
        "01/06/20 08:00:00 +00:00",
        "01/06/2020 25:00:00 +00:00",
        "",
        None,
    ]

    def python(value):
        for pattern in ("%d/%m/%Y %H:%M:%S +00:00", "%m/%d/%Y %I:%M:%S %p +00:00"):
            try:
                return dt.datetime.strptime(value, pattern).strftime("%Y-%m-%d %H:%M:%S")
            except (TypeError, ValueError):
                pass
        return None

    got = _column(spark, texts, "string", lambda c: dates.ticket_time(c).cast("string"))
    assert got == [python(t) for t in texts]


def test_bad_start_fails_or_is_null(spark):
    df = spark.createDataFrame([("x",)], "v string")
    assert df.select(dates.start_time("v", "null").alias("t")).head().t is None
    with pytest.raises(Exception, match="not a ticket time: x"):
        df.select(dates.start_time("v")).collect()
    with pytest.raises(ValueError):
        dates.start_time("v", "skip")


def test_utc_is_required(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_months_and_closing_dates(spark):
    assert _column(spark, ["20200615", "0", None, "0.0"], "string", dates.month_text) == [
        "01/06/2020", None, None, None,
    ]
    days = [dt.date(2020, 6, 15), None]
    assert _column(spark, days, "date", dates.closing_text) == ["20200615", "0"]


def test_holidays_move_into_years(spark):
    raw = spark.createDataFrame([("10/06/2019",), ("29/02/2016",), ("10/06/2018",)], "date string")
    moved = sorted(r.day for r in dates.holidays_in_years(raw, (2020, 2021)).collect())
    assert moved == [dt.date(2020, 2, 29), dt.date(2020, 6, 10), dt.date(2021, 6, 10)]
    kept = sorted(r.day for r in dates.holidays_in_years(raw).collect())
    assert kept == [dt.date(2016, 2, 29), dt.date(2018, 6, 10), dt.date(2019, 6, 10)]


def _numpy_days_off(begin, end, holidays):
    whole = (end - begin).days + 1
    working = np.busday_count(begin, end + dt.timedelta(days=1), holidays=holidays)
    return float(max(whole - working, 0))


@pytest.mark.parametrize("n_holidays", [0, 1, 40])
def test_days_off_match_numpy(spark, n_holidays):
    rng = random.Random(n_holidays)
    day = lambda: dt.date(2015, 1, 1) + dt.timedelta(days=rng.randrange(3000))
    holidays = [day() for _ in range(n_holidays)]
    holidays += holidays[:5]
    pairs = [(i, day(), day()) for i in range(1500)]
    pairs += [(1500 + i, d, d) for i, d in enumerate(holidays)]
    df = spark.createDataFrame(pairs, "i int, b date, e date")
    table = spark.createDataFrame([(d,) for d in holidays], "day date")
    want = [_numpy_days_off(b, e, holidays) for _, b, e in pairs]
    for upto in (calendar.holiday_counter(table),):
        rows = df.select(
            "i",
            calendar.days_off("b", "e", upto).alias("off"),
            calendar.business_days("b", "e", upto).alias("on"),
        ).orderBy("i").collect()
        assert [r.off for r in rows] == want
        assert all(r.on == max((e - b).days + 1, 0) - w for r, (_, b, e), w in zip(rows, pairs, want))
    whole = calendar.off_day_calendar(table, F.lit(dt.date(2015, 1, 1)), F.lit(dt.date(2023, 12, 31)))
    joined = calendar.with_days_off_by_calendar(df, "b", "e", whole, "off").orderBy("i").collect()
    assert [r.off for r in joined] == want
    short = calendar.off_day_calendar(table, F.lit(dt.date(2016, 1, 1)), F.lit(dt.date(2016, 12, 31)))
    with pytest.raises(Exception, match="outside the calendar"):
        calendar.with_days_off_by_calendar(df, "b", "e", short, "off").collect()


def test_days_off_without_end(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 6), None)], "b date, e date")
    upto = calendar.holiday_counter(spark.createDataFrame([], "day date"))
    assert df.select(calendar.days_off("b", "e", upto).alias("o")).head().o == 0.0


def test_small_rules(spark):
    df = spark.createDataFrame(
        [(0.0, -1.0, "OK"), (-1.0, 3.0, "KO"), (7.0, 0.0, None)], "v double, ok double, f string"
    )
    rows = df.select(
        values.repaired_volume("v").alias("v"),
        values.repaired_ok_cases("ok").alias("ok"),
        values.credited_cases("f", "v").alias("c"),
        values.limit_flag("v").alias("flag"),
        values.not_below_zero("v").alias("z"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (1.0, 1.0, 0.0, "OK", 0.0),
        (1.0, 3.0, 0.0, "OK", 0.0),
        (7.0, 0.0, 0.0, "KO", 7.0),
    ]
    assert _column(spark, ["nan", "1.0"], "string", text.nan_text_as_zero) == ["0.0", "1.0"]
    assert _column(spark, ["Órdenes", None], "string", lambda c: text.request_key(c, F.lit("A"), F.lit("B"))) == [
        "órdenes_a_b", None,
    ]
    assert _column(spark, [None, "Validación", "Cerrado", "en gestión"], "string", values.is_working) == [
        True, True, False, False,
    ]


def test_comma_texts_keep_every_digit(spark):
    numbers = [
        0.0, 2.6, 12345678.0, -1e-11, 0.12345678901234, 1e28, 1.5e30, 0.001, 9999999.0, 1e7, 2.0 / 3.0, 2.2250738585072014e-308,
        1.7976931348623157e308, 6.25, -0.1, 123456789012345680.0,
    ]
    df = spark.createDataFrame([(x, x) for x in numbers], "spark double, plain double")
    df = text.with_comma_texts(text.with_comma_texts(df, "spark"), "plain", plain=True)
    for x, r in zip(numbers, df.collect()):
        for spelled in r:
            assert float(spelled.replace(",", ".")) == x
        assert "E" not in r.plain and "," in r.plain
        assert r.plain == format(decimal.Decimal(repr(x)), "f").replace(".", ",") + ("" if "." in format(decimal.Decimal(repr(x)), "f") else ",0")
        small = 0.001 <= abs(x) < 1e7 or x == 0
        assert ("E" in r.spark) == (not small)
    assert [r.spark for r in df.collect()][1:4] == ["2,6", "1,2345678E7", "-1,0E-11"]


def test_whole_numbers_of_any_size(spark):
    numbers = [0.0, 5.0, 9999999.0, 10000000.0, 123456789012.0, 1e15, None]
    want = [None if x is None else repr(x) for x in numbers]
    assert _column(spark, numbers, "double", text.whole_number_text) == want


def test_numbers_or_zero(spark):
    read = _column(spark, ["1.5", "1e-05", "x", None, "nan", "-3", "inf"], "string", values.number_or_zero)
    assert read == [1.5, 1e-05, 0.0, 0.0, 0.0, -3.0, math.inf]
