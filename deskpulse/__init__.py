"""Service-desk indicators on Spark: DataFrames in, DataFrames out."""

from deskpulse.plans.durations import state_detail, visits
from deskpulse.plans.indicators import indicator_totals, indicators
from deskpulse.plans.landing import standardise
from deskpulse.plans.publish import primary_output, publish
from deskpulse.plans.sla import ticket_verdict, verdict_table
from deskpulse.plans.tickets import ticket_list

__all__ = [
    "indicator_totals",
    "indicators",
    "primary_output",
    "publish",
    "standardise",
    "state_detail",
    "ticket_list",
    "ticket_verdict",
    "verdict_table",
    "visits",
]
