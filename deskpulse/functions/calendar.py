"""Days off between two dates: weekends and public holidays, both ends counted.

Both forms rest on counts up to a day, so that an interval costs two lookups
however long it is:

* closed form: weekends by arithmetic, holidays from an array with one entry per
  day between the first and the last holiday. The array reaches the tasks as a
  scalar subquery, so the rows are neither joined nor shuffled.
* calendar join: one row per day with the running number of days off, looked up for
  both ends with equi-joins.
"""

import functools

from pyspark.sql import Window
from pyspark.sql import functions as F

MONDAY = "1900-01-01"


def _as_column(column):
    return F.col(column) if isinstance(column, str) else column


def is_weekend(day):
    return F.weekday(_as_column(day)) >= 5


def weekend_days_before(day):
    """Saturdays and Sundays from a fixed Monday up to, but without, the day."""
    passed = F.datediff(_as_column(day), F.lit(MONDAY).cast("date"))
    into_week = F.pmod(passed, F.lit(7))
    weeks = ((passed - into_week) / 7).cast("int")
    return weeks * 2 + F.greatest(into_week - 5, F.lit(0))


def _running_counts(days):
    """struct(first, upto) for a sorted array of distinct days.

    ``upto[i]`` is the number of days on or before ``first + i``.
    """
    upto = F.flatten(
        F.transform(
            days,
            lambda day, i: F.array_repeat(
                i + 1, F.datediff(F.coalesce(F.get(days, i + 1), F.date_add(day, 1)), day)
            ),
        )
    )
    return F.struct(F.get(days, F.lit(0)).alias("first"), upto.alias("upto"))


def _count_upto(index, day):
    at = F.least(F.datediff(_as_column(day), index["first"]), F.size(index["upto"]) - 1)
    return F.when(at >= 0, F.get(index["upto"], at)).otherwise(F.lit(0))


def holiday_counter(holidays):
    """Function day -> number of weekday holidays up to it, from a ``day`` table.

    The table is reduced to one row with at most one entry per calendar day.
    Holidays at weekends and repeated ones do not count twice.
    """
    index = holidays.filter(~is_weekend("day")).agg(
        _running_counts(F.array_sort(F.collect_set("day"))).alias("index")
    )
    return functools.partial(_count_upto, index.scalar())


def days_off(begin, end, holidays_upto):
    """Non-business days in [begin, end]; 0 when the end is missing or earlier."""
    begin, end = _as_column(begin), _as_column(end)
    weekends = weekend_days_before(F.date_add(end, 1)) - weekend_days_before(begin)
    holidays = holidays_upto(end) - holidays_upto(F.date_sub(begin, 1))
    return F.when(end >= begin, weekends + holidays).otherwise(F.lit(0)).cast("double")


def business_days(begin, end, holidays_upto):
    """Working days in [begin, end]; 0 when the end is missing or earlier."""
    begin, end = _as_column(begin), _as_column(end)
    whole = F.when(end >= begin, F.datediff(end, begin) + 1).otherwise(F.lit(0))
    return whole.cast("double") - days_off(begin, end, holidays_upto)


def off_day_calendar(holidays, first, last):
    """One row per day from first to last (date columns or scalars) with ``off_upto``.

    Running sums are taken inside each year; only the yearly totals, at most one
    row per year, meet in one window.
    """
    days = holidays.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    marked = (
        days.join(holidays.select("day", F.lit(True).alias("holiday")).distinct(), "day", "left")
        .withColumn("off", (is_weekend("day") | F.col("holiday").isNotNull()).cast("int"))
        .withColumn("year", F.year("day"))
    )
    earlier = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        marked.groupBy("year")
        .agg(F.sum("off").alias("total"))
        .select("year", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    )
    within = F.sum("off").over(Window.partitionBy("year").orderBy("day"))
    return (
        marked.withColumn("within", within)
        .join(before, "year")
        .select("day", "off", (F.col("before") + F.col("within")).alias("off_upto"))
    )


def with_days_off_by_calendar(rows, begin, end, calendar, name="days_off"):
    """Append the days off between two date columns by looking both ends up.

    The calendar must cover the dates; a date outside fails the job. Spark picks the
    join by the calendar's size, which the range of dates bounds.
    """
    at_begin = calendar.select(
        F.col("day").alias(begin), (F.col("off_upto") - F.col("off")).alias("_off_before")
    )
    at_end = calendar.select(F.col("day").alias(end), F.col("off_upto").alias("_off_upto"))
    counted = F.coalesce(
        F.col("_off_upto") - F.col("_off_before"),
        F.raise_error(F.lit("date outside the calendar")).cast("bigint"),
    )
    return (
        rows.join(at_begin, begin, "left")
        .join(at_end, end, "left")
        .withColumn(
            name,
            F.when(F.col(end) >= F.col(begin), counted).otherwise(F.lit(0)).cast("double"),
        )
        .select(*rows.columns, name)
    )
