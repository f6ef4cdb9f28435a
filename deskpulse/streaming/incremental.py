"""Runs over the records that are new since the last run.

A run is a file stream with the available-now trigger. Its checkpoint remembers
which files were read, so a run takes each new record once and stops.

A stream is known by an id in its checkpoint. What it writes lies under its name, and a
note beside that says which id owns the name. So neither a lost checkpoint nor a second
stream under one name can double or replace rows unnoticed: such a run stops before it
reads, unless it is told to replace what the name holds.
"""

import uuid
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.plans import indicators as computing
from deskpulse.plans import landing, publish, sla, tickets
from deskpulse.plans.durations import VISIT_COLUMNS, detail_of, state_detail, visits
from deskpulse.schemas import SLA_DAYS
from deskpulse.sources.tables import delete, read_note, stage, unstage, write_note


def new_records(spark, path, schema, fmt="parquet", **options):
    """Streaming frame over a growing folder."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def run_new(source, checkpoint, job):
    """Call job(batch, batch_id) with the new records, if any; commit and stop."""
    query = (
        source.writeStream.foreachBatch(job)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def claim(spark, checkpoint, path, stream, replace=False):
    """Make sure that the checkpoint's stream owns its name under a path.

    With ``replace`` what another stream, or this one before its checkpoint was lost, has
    written under the name is removed first. Returns the stream's id.
    """
    id_note, owner_note = f"{checkpoint}/stream-id", f"{path}/_owners/{stream}"
    own = read_note(spark, id_note)
    if own is None:
        own = uuid.uuid4().hex
        write_note(spark, id_note, own)
    owner = read_note(spark, owner_note)
    if owner == own:
        return own
    if owner is not None and not replace:
        raise ValueError(
            f"{path} holds rows of another stream named {stream}, or of this one before its "
            "checkpoint was lost; use another name, or replace=True to read everything anew"
        )
    if owner is not None:
        delete(spark, f"{path}/stream={stream}")
    write_note(spark, owner_note, own)
    return own


def append_new(source, checkpoint, transform, path, stream="main", replace=False):
    """Add transform(new records) to a table.

    Every batch owns the folder stream=<name>/batch=<id> and replaces it when it is
    repeated after a failure, so a row is never written twice. Several streams may feed
    one table under names of their own; see ``claim``.
    """
    claim(source.sparkSession, checkpoint, path, stream, replace)

    def write(batch, batch_id):
        transform(batch).write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")

    return run_new(source, checkpoint, write)


def read_appended(spark, path, schema=None):
    """What append_new has written so far."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop("stream", "batch")


def append_state_detail(source, holidays, checkpoint, path, **options):
    """State detail of the new history records against the whole holiday table."""
    return append_new(source, checkpoint, lambda new: state_detail(new, holidays, **options), path)


def join_new(source, static, keys, checkpoint, path, **options):
    """New records joined to all rows of a static table."""
    return append_new(source, checkpoint, lambda new: new.join(static, keys), path, **options)


def together(sources):
    """Several streams as one: every row carries its source's name and is a struct there."""
    names = sorted(sources)
    kinds = {name: sources[name].schema for name in names}

    def tagged(name):
        cells = [
            (F.struct(*[F.col(_quoted(c)) for c in kinds[n].names]) if n == name else F.lit(None).cast(kinds[n])).alias(n)
            for n in names
        ]
        return sources[name].select(F.lit(name).alias("_source"), *cells)

    return reduce(DataFrame.union, map(tagged, names))


def _quoted(name):
    return "`" + name.replace("`", "``") + "`"


def apart(batch, name):
    """The rows of one source in a batch of ``together``; only its files are read."""
    rows = batch.where(F.col("_source") == name)
    return rows.select(*[F.col(_quoted(name)).getField(c).alias(c) for c in batch.schema[name].dataType.names])


def run_new_together(spark, sources, checkpoint, folder, job, need="all", replace=False):
    """Call job(frames, run) with the new records of several sources, by name.

    The sources are one streaming query, so its checkpoint commits their progress
    together: a run takes the files that are new in any of them. Without new rows in one
    source (for ``need="all"``) or in all of them (``"any"``) the job is not called, and
    the run is done; rows of different runs do not meet. A run whose job failed is offered
    again, with the same files, before newer ones are looked for. A job may so see a run
    twice and should replace what it wrote for it; see ``append_together``.

    ``folder`` remembers which checkpoint these sources belong to, so that a lost one
    stops the run; ``replace`` starts anew with a fresh checkpoint. The names of the
    sources belong to the checkpoint. Returns the number of runs the job was called for.
    """
    if need not in ("all", "any"):
        raise ValueError(f"need must be 'all' or 'any', not {need}")
    claim(spark, checkpoint, folder, "-".join(sorted(sources)), replace)
    called, failures = [], []

    def offer(batch, batch_id):
        frames = {name: apart(batch, name) for name in sources}
        frames = {name: frame for name, frame in frames.items() if not frame.isEmpty()}
        if frames and (need == "any" or len(frames) == len(sources)):
            try:
                job(frames, f"{batch_id:08d}")
            except Exception as failure:
                failures.append(failure)
                raise
            called.append(batch_id)

    try:
        run_new(together(sources), checkpoint, offer)
    except StreamingQueryException as stopped:
        raise failures[0] if failures else stopped
    return len(called)


def run_both_new(spark, left, right, checkpoint, folder, job, replace=False):
    """Call job(left, right) with the new records of two sources; see ``run_new_together``.

    Without new records on either side the job is not called, and rows that arrive in
    different runs never meet. True if it was called.
    """
    sources = {"left": left, "right": right}
    call = lambda frames, run: job(frames["left"], frames["right"])
    return run_new_together(spark, sources, checkpoint, folder, call, replace=replace) > 0


def append_together(spark, sources, checkpoint, folder, transform, path, need="all", replace=False):
    """Add transform(frames) of every run to a table; a repeated run replaces its folder."""
    if replace:
        delete(spark, path)

    def write(frames, run):
        transform(frames).write.mode("overwrite").parquet(f"{path}/run={run}")

    return run_new_together(spark, sources, checkpoint, folder, write, need, replace)


def read_runs(spark, path, schema=None):
    """What append_together has written so far."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop("run")


# --- the six jobs over new records ------------------------------------------------------


def append_states(
    source,
    holidays,
    checkpoint,
    detail_path,
    verdict_path,
    sla_days=SLA_DAYS,
    stream="main",
    replace=False,
    **options,
):
    """First job: detail and verdicts of the new records, both tables from one batch.

    A ticket is computed from the records of the batch alone.
    """
    spark = source.sparkSession
    for path in (detail_path, verdict_path):
        claim(spark, checkpoint, path, stream, replace)

    def write(batch, batch_id):
        visited = visits(batch, holidays, **options).select(*VISIT_COLUMNS)
        visited, staged = stage(visited, "visits")
        try:
            for table, path in (
                (detail_of(visited), detail_path),
                (sla.verdict_table(sla.verdict_of(visited, sla_days)), verdict_path),
            ):
                table.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")
        finally:
            unstage(spark, staged)

    return run_new(source, checkpoint, write)


def append_tickets(spark, description, verdicts, checkpoint, folder, path, **options):
    """Second job: new descriptions with new verdicts."""
    sources = {"description": description, "verdicts": verdicts}
    make = lambda new: tickets.ticket_list(new["description"], new["verdicts"])
    return append_together(spark, sources, checkpoint, folder, make, path, **options)


def append_indicators(source, categories, checkpoint, path, stream="main", replace=False, **options):
    """Third job: indicators of the new tickets against the whole category table."""
    make = lambda new: computing.indicators(new, categories, **options)
    return append_new(source, checkpoint, make, path, stream, replace)


def append_landing(spark, sources, checkpoint, folder, path, **options):
    """Fourth job: new rows of whichever landed tables have some."""
    make = lambda new: landing.standardise(new)[0]
    return append_together(spark, sources, checkpoint, folder, make, path, need="any", **options)


def append_primary(spark, standard, computed, checkpoint, folder, path, **options):
    """Fifth job: new standard rows with new indicators."""
    sources = {"standard": standard, "indicators": computed}
    make = lambda new: publish.primary_output(new["standard"], new["indicators"])
    return append_together(spark, sources, checkpoint, folder, make, path, **options)


def append_output(spark, primary, claims, checkpoint, folder, path, mode="override", **options):
    """Sixth job: new primary rows with new claims."""
    sources = {"primary": primary, "claims": claims}
    make = lambda new: publish.publish(new["primary"], new["claims"], mode)
    return append_together(spark, sources, checkpoint, folder, make, path, **options)
