"""Verdicts + ticket descriptions -> the ticket list the indicators are built on."""

from pyspark.sql import functions as F

from deskpulse.functions import dates, text
from deskpulse.functions.values import credited_cases, repaired_ok_cases, repaired_volume
from deskpulse.operators.columns import as_text, fill_missing, insert_column, move_last
from deskpulse.operators.dedupe import first_per_key

CREDIT_POSITION = 14


def repaired_description(description):
    """Descriptions with missing cells filled and unset volumes counted as one case."""
    named = description.filter("id_ticket IS NOT NULL").drop("date")
    if "user_name" in named.columns:
        named = as_text(named, "user_name")
    return fill_missing(named).withColumns(
        {
            "volumen_total_casos": repaired_volume("volumen_total_casos"),
            "total_casos_ok": repaired_ok_cases("total_casos_ok"),
        }
    )


def dated_verdicts(verdicts):
    """Published verdicts with the closing date cut to its month; null for '0'."""
    return fill_missing(verdicts.filter("id_ticket IS NOT NULL")).withColumn(
        "date", dates.month_text("date")
    )


def ticket_list(description, verdicts):
    """One row per ticket, project, flow and month.

    Both sides lose their copies before they meet: the result keeps the first row by
    description and then by verdict, and the first of each side gives just that.
    Copies of one ticket never multiply in the join.
    """
    described = first_per_key(
        repaired_description(description), ["id_ticket", "proyecto", "flujo"]
    )
    judged = first_per_key(dated_verdicts(verdicts), ["id_ticket", "date"])
    joined = described.join(judged, "id_ticket")
    credit = credited_cases("ok_ko", "volumen_total_casos")
    credited = insert_column(joined, CREDIT_POSITION, "sum_casos_ok", credit)
    published = text.with_float_texts(credited, "sum_casos_ok").withColumn(
        "sum_casos_ok", text.nan_text_as_zero("sum_casos_ok")
    )
    return move_last(published, "date")


def tickets_without_month(tickets):
    """How many tickets have no closing month and so belong to no monthly indicator."""
    return tickets.agg(F.count_if(F.col("date").isNull()).alias("without_month"))
