"""Helpers the operators share."""

import sys
import tempfile
import types

from pyspark.sql import functions as F

# Words are runs of anything but the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark):
    """The session's folder for intermediate results, which all executors share.

    It is ``spark.checkpoint.dir``; only a local session may go without it and gets a
    folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df):
    """The rows written to the shared checkpoint folder, and read from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def kept(key, make):
    """make(), called once in the life of a Python worker."""
    holder = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


def word_list(text):
    """The words of a text as an array; null and blank texts have none."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")), " ")
    return F.filter(words, lambda w: w != "")


def fresh_name(columns, name):
    """A column name that no input column has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name):
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value, body):
    """body(value) with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def small(df, rows=100_000):
    """Marked for broadcast if it has at most so many rows; joined by shuffle beyond."""
    return F.broadcast(df) if df.count() <= rows else df
