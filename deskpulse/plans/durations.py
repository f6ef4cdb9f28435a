"""Ticket history -> one row per state visit, and the published detail table."""

from pyspark.sql import functions as F

from deskpulse.functions import dates, text
from deskpulse.functions.calendar import days_off, holiday_counter
from deskpulse.functions.values import is_working
from deskpulse.operators.next_row import SPLIT_ROWS, next_in_group, next_in_sequence
from deskpulse.schemas import CREATE_STATES, DETAIL_COLUMNS, HOLIDAY_YEARS, NO_NEXT
from deskpulse.session import require_utc

HISTORY_COLUMNS = ("id_ticket", "estado", "fecha", "date", "row_seq")
# What the detail and verdict tables are made of.
VISIT_COLUMNS = (
    "id_ticket",
    "estado",
    "fecha",
    "date",
    "has_next",
    "next_state",
    "next_time",
    "seconds",
    "off_days",
    "end_day",
)


def with_next_state(
    history, scope="ticket", on_bad_start="fail", split_rows=SPLIT_ROWS, keep=()
):
    """Append the start time and the state and time that follow each row.

    ``scope="ticket"`` looks inside a ticket of one export, by time and then
    ``row_seq``; ``scope="file"`` takes the next row of the whole table by
    ``row_seq``. Nothing follows the last row or a row before a newly opened ticket.
    ``keep`` names further history columns to carry along.
    """
    def parsed(rows):
        return rows.withColumn("start_ts", dates.start_time("fecha", on_bad_start))

    rows = history.select(*HISTORY_COLUMNS, *keep)
    values = ["estado", "fecha", "start_ts"]
    if scope == "ticket":
        led = next_in_group(
            rows, ["id_ticket", "date"], "start_ts", "row_seq", values, split_rows, parsed
        )
    elif scope == "file":
        led = next_in_sequence(parsed(rows), "row_seq", values, split_rows)
    else:
        raise ValueError(f"scope must be 'ticket' or 'file', not {scope}")
    opens = F.coalesce(F.col("next_estado").isin(*CREATE_STATES), F.lit(False))
    follows = F.col("has_next") & ~opens
    return led.withColumns(
        {
            "has_next": follows,
            "next_state": F.when(follows, F.col("next_estado")),
            "next_time": F.when(follows, F.col("next_fecha")),
            "end_ts": F.when(follows, F.col("next_start_ts")),
        }
    ).drop("next_estado", "next_fecha", "next_start_ts")


def visits(
    history,
    holidays,
    years=HOLIDAY_YEARS,
    scope="ticket",
    on_bad_start="fail",
    split_rows=SPLIT_ROWS,
    keep=(),
):
    """One row per history row with seconds, days off and end date of the visit.

    ``holidays`` is the raw dd/MM/yyyy table; ``years`` moves its days into those
    years (None keeps the dates as they are).
    """
    require_utc(history.sparkSession)
    holidays_upto = holiday_counter(dates.holidays_in_years(holidays, years))
    followed = with_next_state(history, scope, on_bad_start, split_rows, keep)
    return followed.withColumns(
        {
            "seconds": dates.elapsed_seconds("start_ts", "end_ts"),
            "off_days": days_off(dates.day_of("start_ts"), dates.day_of("end_ts"), holidays_upto),
            "end_day": dates.day_of("end_ts"),
        }
    )


def detail_of(visited, keep=()):
    """The published detail table: working states only, durations as text.

    Columns named in ``keep`` follow behind.
    """
    working = visited.filter(is_working("estado"))
    net = dates.days_of("seconds") - F.col("off_days")
    missing = ~F.col("has_next")
    return working.select(
        "id_ticket",
        "estado",
        "fecha",
        F.col("date").alias("date_particion"),
        F.when(missing, NO_NEXT).otherwise(F.col("next_state")).alias("Estadofinal"),
        F.when(missing, NO_NEXT).otherwise(F.col("next_time")).alias("FechaFinal"),
        dates.closing_text("end_day").alias("date"),
        text.whole_number_text("off_days").alias("dias_festivos"),
        text.hundredths_text("seconds").alias("diferencia_tiempo_dias"),
        F.when(net > 0, text.hundredths_text("seconds", "off_days"))
        .otherwise("0.00")
        .alias("diferencia_tiempo_festivos"),
        *keep,
    ).select(*DETAIL_COLUMNS, *keep)


def state_detail(history, holidays, keep=(), **options):
    """Each visit to a working state with its length in days, gross and net."""
    return detail_of(visits(history, holidays, keep=keep, **options), keep)
