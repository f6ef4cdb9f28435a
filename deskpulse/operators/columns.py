"""Column-level operators: renames, order, constants, whole-cell replacement."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_all(df, names):
    """Rename every column by position."""
    return df.toDF(*names)


def insert_column(df, position, name, value):
    """Append a column at a position; past the end it becomes the last one."""
    names = [c for c in df.columns if c != name]
    names.insert(min(position, len(names)), name)
    return df.withColumn(name, value).select(*names)


def move_last(df, name):
    return df.select(*[c for c in df.columns if c != name], name)


def in_order(df, names):
    return df.select(*names)


def as_text(df, *names):
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def conform(df, schema):
    """Name and cast the columns by position to a schema."""
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns, {len(schema)} expected")
    renamed = df.toDF(*schema.fieldNames())
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def replace_cells(df, *mappings):
    """Replace whole cells in all text columns, one pass per mapping.

    A mapping is a dict, or a small frame with the text columns ``old`` and ``new``. A
    frame travels as one value; an old text that it lists twice fails the job.
    """
    for mapping in mappings:
        if isinstance(mapping, dict):
            df = df.na.replace(mapping)
            continue
        pairs = mapping.filter("old IS NOT NULL").agg(F.collect_list(F.struct("old", "new")))
        table = F.map_from_entries(pairs.scalar())
        names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        df = df.withColumns(
            {n: F.when(F.map_contains_key(table, F.col(n)), F.try_element_at(table, F.col(n))).otherwise(F.col(n)) for n in names}
        )
    return df


def fill_missing(df):
    """Nulls and NaNs become 0.0, in text columns the text '0.0'."""
    return df.na.fill(0.0).na.fill("0.0")

