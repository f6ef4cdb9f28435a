"""Reading and writing tables, and the shared folder for intermediate ones."""

import re
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

# Row numbers of different files are kept this far apart.
FILE_STRIDE = 1 << 40
URI_SCHEME = "^[A-Za-z0-9]+:/+"


def _bare(uri):
    """A file URI without its scheme, whichever number of slashes follows it."""
    return re.sub(URI_SCHEME, "/", uri)


def read_table(spark, name, schema=None, fmt="parquet"):
    """A catalog table by name, or files by path (anything with a slash)."""
    if "/" not in name:
        return spark.read.table(name)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(name)


def read_tables(spark, names, **options):
    return {name: read_table(spark, name, **options) for name in names}


def read_history(spark, path, schema=None):
    """Parquet history with ``row_seq`` from the order of files and of rows in a file.

    Files are ranked by name in Spark: their names meet in one task, their rows do not. The
    names travel to the rows, as the driver lists them all anyway; shuffled by its file, a
    large file would land in one task. Needed only for histories that do not bring a ``row_seq``.
    """
    rows = read_table(spark, path, schema)
    if "row_seq" in rows.columns:
        return rows
    placed = rows.select(
        "*",
        F.regexp_replace("_metadata.file_path", URI_SCHEME, "/").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    by_name = Window.orderBy("_file")
    ranks = placed.select("_file").distinct().withColumn("_rank", F.row_number().over(by_name) - 1)
    return (
        placed.join(F.broadcast(ranks), "_file")
        .withColumn("row_seq", F.col("_rank") * F.lit(FILE_STRIDE) + F.col("_row"))
        .drop("_file", "_rank", "_row")
    )


def write_table(df, path, mode="append", single_file=False, partition_by=()):
    """Add rows to a parquet table. ``single_file`` is for small results only."""
    writer = (df.coalesce(1) if single_file else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def work_folder(spark, name):
    """A new folder in the shared folder for intermediate tables.

    That is the session's spark.checkpoint.dir, or what setCheckpointDir has named.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.sparkContext.getCheckpointDir()
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df, name):
    """Write an intermediate table to the shared folder and read it back.

    Later steps then start from the files, whatever happens to the executors. The caller
    removes the table (``unstage``) when nothing reads it any more.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def unstage(spark, path):
    delete(spark, path)


# --- single files and folders, in whatever file system the path names -----------------


def _place(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark, path):
    files, where = _place(spark, path)
    return files.exists(where)


def delete(spark, path):
    """Remove a file, or a folder with all it holds."""
    files, where = _place(spark, path)
    return files.delete(where, True)


def children(spark, path):
    """Names in a folder, sorted; none if there is no such folder."""
    files, where = _place(spark, path)
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def write_note(spark, path, text):
    """A small text file, whole or not at all; an older one is replaced in the same step."""
    files, where = _place(spark, path)
    draft = where.suffix(f".{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(draft), context.makeQualified(where), overwrite)


def read_note(spark, path):
    """The text of a small file, or None."""
    files, where = _place(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text
