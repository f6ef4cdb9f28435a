"""Standard table + computed indicators + approved claims -> the published table."""

from pyspark.sql import functions as F

from deskpulse.functions.text import with_comma_texts
from deskpulse.operators.columns import conform, in_order
from deskpulse.operators.combine import union_distinct
from deskpulse.operators.dedupe import distinct_rows, first_per_key, preferred_per_key
from deskpulse.schemas import INDICATOR_COLUMNS, PUBLISHED, STANDARD_KEY


def published_indicators(indicators, plain_numbers=False):
    """Computed indicators under the standard names, with a decimal comma."""
    ordered = in_order(indicators, INDICATOR_COLUMNS)
    return conform(with_comma_texts(ordered, "valor", plain=plain_numbers), PUBLISHED)


def primary_output(standard, indicators, plain_numbers=False):
    """One landed row per key together with the computed indicators, without copies."""
    landed = first_per_key(conform(standard, PUBLISHED), list(STANDARD_KEY))
    return union_distinct([landed, published_indicators(indicators, plain_numbers)])


def publish(primary, claims, mode="override"):
    """The final table.

    ``override``: one row per key, an approved claim replacing the computed row.
    ``passthrough``: the primary rows as they are; claims have no effect.
    """
    if mode == "passthrough":
        return distinct_rows(primary)
    if mode != "override":
        raise ValueError(f"mode must be 'override' or 'passthrough', not {mode}")
    return preferred_per_key(
        [conform(claims, PUBLISHED), conform(primary, PUBLISHED)], list(STANDARD_KEY)
    )


def claimed_keys(primary, claims):
    """How many published keys a claim decides, for the run report."""
    keys = claims.select(*STANDARD_KEY).distinct()
    return primary.join(keys, list(STANDARD_KEY), "left_semi").agg(
        F.count(F.lit(1)).alias("overridden")
    )
