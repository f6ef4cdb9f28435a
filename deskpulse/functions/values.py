"""Small rules on single values: repairs, flags, clamps and safe ratios."""

from pyspark.sql import functions as F

from deskpulse.schemas import ALL_REQUESTS, SLA_DAYS, WORKING_STATES


def _as_column(column):
    return F.col(column) if isinstance(column, str) else column


def is_working(state):
    """Time in this state counts. A missing state counts too."""
    state = _as_column(state)
    return state.isNull() | state.isin(*WORKING_STATES)


def not_below_zero(column):
    return F.greatest(_as_column(column), F.lit(0.0))


def limit_flag(net_days, sla_days=SLA_DAYS):
    return F.when(_as_column(net_days) >= F.lit(float(sla_days)), "KO").otherwise("OK")


def repaired_volume(column):
    """A volume of 0 or -1 was never filled in and counts as one case."""
    volume = _as_column(column)
    return F.when(volume.isin(0.0, -1.0), 1.0).otherwise(volume)


def repaired_ok_cases(column):
    cases = _as_column(column)
    return F.when(cases == -1.0, 1.0).otherwise(cases)


def credited_cases(flag, volume):
    """The whole volume of a ticket inside the limit, nothing of one outside."""
    return F.when(_as_column(flag) == "OK", _as_column(volume)).otherwise(F.lit(0.0))


def number_or_null(column):
    return _as_column(column).try_cast("double")


def number_or_zero(column):
    """A number, zero where it is missing, unreadable or NaN."""
    number = number_or_null(column)
    return F.when(number.isNull() | F.isnan(number), 0.0).otherwise(number)


def covers_all_requests(request):
    """True for 'Todas', false for a single request type, null when missing."""
    return _as_column(request) == ALL_REQUESTS
