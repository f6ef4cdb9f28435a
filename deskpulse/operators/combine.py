"""Set operators and membership joins."""

import functools

from pyspark.sql import DataFrame


def union_all(frames):
    return functools.reduce(DataFrame.unionByName, frames)


def union_distinct(frames):
    return union_all(frames).distinct()


def fitting(tables, width):
    """Split named tables by column count: (those of this width, report rows)."""
    taken = {name: df for name, df in tables.items() if len(df.columns) == width}
    report = [(name, len(df.columns), name in taken) for name, df in tables.items()]
    return taken, report


def members(df, values, on):
    """Rows whose key occurs in another table; nulls never match."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(values.select(*keys), keys, "left_semi")


def split_by(df, condition):
    """Rows where the condition holds and rows where it fails; nulls are in neither."""
    return df.filter(condition), df.filter(~condition)
