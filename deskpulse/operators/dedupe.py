"""Distinct rows and one stable row per key.

``row_number() = 1`` is planned with a group limit before the shuffle: every task
sends at most one row per key, so a key with very many copies stays cheap.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F


def distinct_rows(df):
    return df.distinct()


def first_per_key(df, keys, order=()):
    """The first row of each key by ``order``, ties broken by all other columns."""
    named = [c for c in order if isinstance(c, str)]
    ties = [c for c in df.columns if c not in keys and c not in named]
    by = [*order, *ties]
    window = Window.partitionBy(*keys).orderBy(*(by or keys))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def earliest_per_key(df, keys, by):
    return first_per_key(df, keys, [by])


def preferred_per_key(sources, keys, tag="filtro"):
    """Rows of several same-shaped sources, the earlier source winning on equal keys."""
    tagged = [df.withColumn(tag, F.lit(str(i))) for i, df in enumerate(sources)]
    merged = tagged[0]
    for df in tagged[1:]:
        merged = merged.unionByName(df)
    return first_per_key(merged, keys, [tag]).drop(tag)
