"""Row counts and empty-input guards."""

from pyspark.sql import Observation
from pyspark.sql import functions as F


def row_counts(tables):
    """One row per named table with its row count."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        for name, df in tables.items()
    ]
    counted = frames[0]
    for frame in frames[1:]:
        counted = counted.unionByName(frame)
    return counted


def empty_tables(tables):
    """Names of the tables without rows; each check stops at the first row found."""
    return [name for name, df in tables.items() if df.isEmpty()]


def counted(df, name):
    """The frame and an Observation that holds its row count after the next action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen
