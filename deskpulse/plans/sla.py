"""State visits -> one verdict per ticket."""

from pyspark.sql import functions as F

from deskpulse.functions import dates, text
from deskpulse.functions.values import is_working, limit_flag, not_below_zero
from deskpulse.plans.durations import visits
from deskpulse.schemas import SLA_DAYS, VERDICT_COLUMNS


def closing_days(visited):
    """Latest end date per ticket and export, over all states."""
    return (
        visited.filter("id_ticket IS NOT NULL AND date IS NOT NULL")
        .groupBy("id_ticket", F.col("date").alias("date_particion"))
        .agg(F.max("end_day").alias("end_day"))
    )


def ticket_totals(visited):
    """Working time, days off and closing date per ticket and export.

    The time counts working states only and the closing date all states, so one
    pass with a condition replaces two groupings and a join. Rows of one ticket come
    out on one partition, ready for the choice of export.

    Visits straight from the window are already partitioned by its keys and are summed
    by those first, without a shuffle; only the sums move.
    """
    named = visited.filter("id_ticket IS NOT NULL AND date IS NOT NULL")
    sums = {
        "seconds": F.sum(F.when(is_working("estado"), F.col("seconds"))),
        "off_days": F.sum(F.when(is_working("estado"), F.col("off_days"))),
        "end_day": F.max("end_day"),
        "working_rows": F.count_if(is_working("estado")),
    }
    sums = [column.alias(name) for name, column in sums.items()]
    if {"_group", "_slice"} <= set(visited.columns):
        partial = named.groupBy("_group", "_slice").agg(*sums).select("_group.*", "*")
    else:
        partial = named.groupBy("id_ticket", "date").agg(*sums)
    return (
        partial.repartition("id_ticket")
        .groupBy("id_ticket", F.col("date").alias("date_particion"))
        .agg(
            F.sum("seconds").alias("seconds"),
            F.sum("off_days").alias("off_days"),
            F.max("end_day").alias("end_day"),
            F.sum("working_rows").alias("working_rows"),
        )
        .filter("working_rows > 0")
        .drop("working_rows")
    )


def earliest_export(totals):
    """One row per ticket: that of its earliest export."""
    kept = F.min_by(F.struct("seconds", "off_days", "end_day"), "date_particion")
    return totals.groupBy("id_ticket").agg(kept.alias("kept")).select("id_ticket", "kept.*")


def verdict_of(visited, sla_days=SLA_DAYS):
    """Verdicts as numbers: seconds, off_days, days, net_days, end_day, ok_ko."""
    kept = earliest_export(ticket_totals(visited))
    days = dates.days_of("seconds")
    return kept.select(
        "id_ticket",
        "end_day",
        "seconds",
        "off_days",
        days.alias("days"),
        not_below_zero(days - F.col("off_days")).alias("net_days"),
    ).withColumn("ok_ko", limit_flag("net_days", sla_days))


def ticket_verdict(history, holidays, sla_days=SLA_DAYS, **options):
    return verdict_of(visits(history, holidays, **options), sla_days)


def verdict_table(verdicts, sort=False):
    """The published verdict table, numbers as text; sorted by ticket on request."""
    published = verdicts.select(
        "id_ticket",
        dates.closing_text("end_day").alias("date"),
        F.col("seconds").alias("Diferencia_tiempo"),
        text.whole_number_text("off_days").alias("dias_festivos"),
        F.col("net_days").alias("diferencia_tiempo_festivos"),
        F.col("days").alias("Diferencia_tiempo_dias"),
        "ok_ko",
    )
    published = text.with_float_texts(
        published, "diferencia_tiempo_festivos", "Diferencia_tiempo_dias"
    ).select(*VERDICT_COLUMNS)
    return published.orderBy("id_ticket") if sort else published


def regrouped(verdicts):
    """Sums per ticket and closing date; verdicts have one row each, so nothing changes."""
    return verdicts.groupBy("id_ticket", "end_day").agg(
        F.sum("seconds").alias("seconds"), F.sum("off_days").alias("off_days")
    )
