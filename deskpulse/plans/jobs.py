"""The six jobs with their reads, guards, writes and run reports.

Each job writes nothing when a required input has no rows. The report lists the
empty inputs and the number of rows written.
"""

from dataclasses import dataclass, field

from deskpulse.operators.counts import counted, empty_tables
from deskpulse.plans.durations import VISIT_COLUMNS, detail_of, visits
from deskpulse.plans.indicators import indicators
from deskpulse.plans.landing import standardise
from deskpulse.plans.publish import primary_output, publish
from deskpulse.plans.sla import verdict_of, verdict_table
from deskpulse.plans.tickets import ticket_list
from deskpulse.schemas import SLA_DAYS
from deskpulse.sources.tables import stage, unstage, write_table


@dataclass
class Report:
    empty: list = field(default_factory=list)
    written: dict = field(default_factory=dict)
    left_out: list = field(default_factory=list)

    def messages(self):
        lines = [f"Table {name} doesn't have new records" for name in self.empty]
        lines += [f"Records written to {path}: {n}" for path, n in self.written.items()]
        lines += [f"Table {name} left out: {n} columns" for name, n in self.left_out]
        return lines


def _write(df, path, report, **options):
    watched, seen = counted(df, path)
    write_table(watched, path, **options)
    report.written[path] = seen.get["records"]


def _guarded(tables):
    report = Report(empty=empty_tables(tables))
    return report, not report.empty


def run_states(history, holidays, detail_path, verdict_path, sla_days=SLA_DAYS, options=None, **sink):
    """History -> detail and verdict tables. The visits are staged once for both.

    The staged table is removed when both are written, and also when one fails.
    """
    report, go = _guarded({"history": history})
    if go:
        options = dict(options or {})
        keep = options.get("keep", ())
        visited = visits(history, holidays, **options).select(*VISIT_COLUMNS, *keep)
        visited, staged = stage(visited, "visits")
        try:
            _write(detail_of(visited, keep), detail_path, report, **sink)
            _write(verdict_table(verdict_of(visited, sla_days)), verdict_path, report, **sink)
        finally:
            unstage(history.sparkSession, staged)
    return report


def run_tickets(description, verdicts, path, **sink):
    report, go = _guarded({"description": description, "verdicts": verdicts})
    if go:
        _write(ticket_list(description, verdicts), path, report, **sink)
    return report


def run_indicators(tickets, categories, path, options=None, **sink):
    report, go = _guarded({"tickets": tickets})
    if go:
        _write(indicators(tickets, categories, **(options or {})), path, report, **sink)
    return report


def run_landing(tables, path, **sink):
    """Landed tables -> standard table. Empty tables are skipped, not required."""
    report = Report(empty=empty_tables(tables))
    filled = {name: df for name, df in tables.items() if name not in report.empty}
    if filled:
        standard, _ = standardise(filled)
        report.left_out = [
            (name, len(df.columns))
            for name, df in filled.items()
            if len(df.columns) != len(standard.columns)
        ]
        if len(report.left_out) < len(filled):
            _write(standard, path, report, **sink)
    return report


def run_primary(standard, computed, path, options=None, **sink):
    report, go = _guarded({"standard": standard, "indicators": computed})
    if go:
        _write(primary_output(standard, computed, **(options or {})), path, report, **sink)
    return report


def run_output(primary, claims, path, mode="override", **sink):
    report, go = _guarded({"primary": primary, "claims": claims})
    if go:
        _write(publish(primary, claims, mode), path, report, **sink)
    return report
