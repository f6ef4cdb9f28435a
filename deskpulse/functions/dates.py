"""Ticket times, closing dates, months and holidays as column expressions."""

from pyspark.sql import functions as F

from deskpulse.schemas import NO_DATE

# The two spellings of a ticket time and those of the day columns.
TIME_24H = "d/M/yyyy H:m:s '+00:00'"
TIME_12H = "M/d/yyyy h:m:s a '+00:00'"
DAY_TEXT = "d/M/yyyy"
CLOSING_TEXT = "yyyyMMdd"
MONTH_TEXT = "dd/MM/yyyy"


def _as_column(column):
    return F.col(column) if isinstance(column, str) else column


def ticket_time(column):
    """Timestamp of a ticket time in either spelling; null when it fits neither.

    Only the 12-hour spelling has letters, so one look tells which pattern can
    fit and each text is parsed once. Runs of blanks are squeezed only for texts
    that did not parse.
    """
    text = _as_column(column)

    def parsed(value):
        return F.when(
            F.upper(value).contains("M"), F.try_to_timestamp(value, F.lit(TIME_12H))
        ).otherwise(F.try_to_timestamp(value, F.lit(TIME_24H)))

    return F.coalesce(parsed(text), parsed(F.regexp_replace(text, r"\s+", " ")))


def start_time(column, on_bad="fail"):
    """Like ticket_time; a text that does not parse fails the job or gives null."""
    text = _as_column(column)
    if on_bad == "null":
        return ticket_time(text)
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad}")
    message = F.concat(F.lit("not a ticket time: "), F.coalesce(text, F.lit("null")))
    return F.coalesce(ticket_time(text), F.raise_error(message).cast("timestamp"))


def day_of(column):
    return F.to_date(_as_column(column))


def elapsed_seconds(start, end):
    """Whole seconds from start to end as a double, 0 when the end is missing."""
    gap = F.unix_seconds(_as_column(end)) - F.unix_seconds(_as_column(start))
    return F.coalesce(gap, F.lit(0)).cast("double")


def days_of(seconds):
    return _as_column(seconds) / F.lit(86400.0)


def closing_text(column):
    """yyyyMMdd, or '0' when there is no closing date."""
    return F.coalesce(F.date_format(_as_column(column), CLOSING_TEXT), F.lit(NO_DATE))


def month_text(column):
    """First of the month (dd/MM/yyyy) of a yyyyMMdd text; null for '0'."""
    day = F.try_to_timestamp(_as_column(column), F.lit(CLOSING_TEXT))
    return F.date_format(F.trunc(day, "MM"), MONTH_TEXT)


def holidays_in_years(holidays, years=None, column="date", on_missing="fail"):
    """Distinct holiday dates (column ``day``) of a dd/MM/yyyy text table.

    With ``years`` every day and month is moved into each of those years, and
    29 February drops out of the years that lack it. Without, dates stay as given.
    A holiday without a date fails the job; ``on_missing="drop"`` leaves it out.
    """
    day = F.to_date(F.col(column), DAY_TEXT)
    if on_missing == "fail":
        day = F.coalesce(day, F.raise_error(F.lit("holiday without a date")).cast("date"))
    elif on_missing != "drop":
        raise ValueError(f"on_missing must be 'fail' or 'drop', not {on_missing}")
    dated = holidays.select(day.alias("day")).filter("day IS NOT NULL")
    if years is None:
        return dated.distinct()
    moved = dated.select(
        F.date_format("day", "dd/MM/").alias("day_month"),
        F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("year"),
    )
    text = F.concat("day_month", F.lpad(F.col("year").cast("string"), 4, "0"))
    return (
        moved.select(F.try_to_timestamp(text, F.lit(MONTH_TEXT)).cast("date").alias("day"))
        .filter("day IS NOT NULL")
        .distinct()
    )
