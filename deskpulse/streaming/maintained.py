"""Tables that stay those of the whole history while records arrive run by run.

A ticket's records may come in several runs. Every run keeps its records, looks up all
that is kept of the tickets it has met, computes these tickets anew and replaces them in
the tables. Records and tables are dealt out to buckets by ticket; a run reads and writes
no other buckets than those of its tickets.

Files are never changed. A run writes its buckets under its own number, and then one
manifest that names the number of every bucket, for all tables at once. Readers follow
the newest manifest, so they see a run wholly or not at all. A run that is repeated after
a failure starts from the manifest before it and writes the same again. What neither of
the two newest manifests names is removed.
"""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskpulse.plans import sla
from deskpulse.plans.durations import VISIT_COLUMNS, detail_of, visits
from deskpulse.schemas import SLA_DAYS
from deskpulse.sources.tables import children, delete, read_note, stage, unstage, write_note
from deskpulse.streaming.incremental import claim, run_new

BUCKETS = 64
KEPT_MANIFESTS = 2


def bucket_of(keys, buckets):
    """The bucket of a row; rows without a key have one as well."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _manifests(spark, folder):
    return [n for n in children(spark, f"{folder}/_manifests") if n.isdigit()]


def manifest(spark, folder, before=None):
    """The newest manifest, or the newest of the runs before one; {} if there is none."""
    names = [n for n in _manifests(spark, folder) if before is None or int(n) < before]
    return json.loads(read_note(spark, f"{folder}/_manifests/{names[-1]}")) if names else {}


def _read_buckets(spark, folder, table, schema, versions):
    """Rows of some buckets, each in the version that is named for it."""
    paths = [f"{folder}/{table}/version={v}/bucket={b}" for b, v in sorted(versions.items(), key=lambda x: int(x[0]))]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_maintained(spark, folder, table):
    """A table as its newest manifest has it; None before the first run."""
    now = manifest(spark, folder)
    if table not in now:
        return None
    entry = now[table]
    return _read_buckets(spark, folder, table, T.StructType.fromJson(entry["schema"]), entry["buckets"])


def _without(rows, keys, names):
    """Rows of other keys; a missing key equals a missing key."""
    return rows.join(keys, _same(rows, keys, names), "left_anti")


def _same(rows, keys, names):
    same = F.lit(True)
    for name in names:
        same = same & rows[name].eqNullSafe(keys[name])
    return same


def replace_keys(spark, folder, number, keys, names, touched, tables, buckets):
    """Publish run ``number``: in every table the rows of ``keys`` give way to new ones.

    ``tables`` maps names to all new rows of those keys; ``touched`` lists their buckets,
    the only ones that are read and written.
    """
    before = manifest(spark, folder, number)
    now = {}
    for table, fresh in tables.items():
        old = before.get(table, {"buckets": {}})["buckets"]
        here = {b: v for b, v in old.items() if int(b) in touched}
        kept = _without(_read_buckets(spark, folder, table, fresh.schema, here), keys, names)
        path = f"{folder}/{table}/version={number}"
        rows = kept.unionByName(fresh).withColumn("bucket", bucket_of(names, buckets))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = {n.removeprefix("bucket="): number for n in children(spark, path) if n.startswith("bucket=")}
        others = {b: v for b, v in old.items() if int(b) not in touched}
        now[table] = {"schema": fresh.schema.jsonValue(), "buckets": {**others, **written}}
    write_note(spark, f"{folder}/_manifests/{number:010d}", json.dumps(now))
    _remove_unnamed(spark, folder, list(tables))


def _remove_unnamed(spark, folder, tables):
    """Remove old manifests and the versions that no manifest left names."""
    names = _manifests(spark, folder)
    for name in names[:-KEPT_MANIFESTS]:
        delete(spark, f"{folder}/_manifests/{name}")
    left = [json.loads(read_note(spark, f"{folder}/_manifests/{n}")) for n in names[-KEPT_MANIFESTS:]]
    newest = int(names[-1])
    for table in tables:
        named = {(str(v), b) for m in left for b, v in m.get(table, {"buckets": {}})["buckets"].items()}
        for version in children(spark, f"{folder}/{table}"):
            number = version.removeprefix("version=")
            if int(number) > newest:
                continue
            parts = [n for n in children(spark, f"{folder}/{table}/{version}") if n.startswith("bucket=")]
            unnamed = [n for n in parts if (number, n.removeprefix("bucket=")) not in named]
            if len(unnamed) == len(parts):
                delete(spark, f"{folder}/{table}/{version}")
            else:
                for n in unnamed:
                    delete(spark, f"{folder}/{table}/{version}/{n}")


def maintain(source, names, compute, checkpoint, folder, buckets=BUCKETS, replace=False):
    """Keep tables equal to compute(whole history) while the history grows.

    ``names``: the key columns; compute(records) takes all records of some keys and returns
    the tables' rows of those keys, by table name, and a function to call when they are
    written. It must treat every key by itself. Rows without a key share one. The number
    of buckets belongs to the folder.
    """
    spark = source.sparkSession
    claim(spark, checkpoint, folder, "maintained", replace)
    if replace and not children(spark, f"{checkpoint}/commits"):
        for name in children(spark, folder):
            if name != "_owners":
                delete(spark, f"{folder}/{name}")
    known = read_note(spark, f"{folder}/_buckets")
    if known is not None and int(known) != buckets:
        raise ValueError(f"{folder} has {known} buckets, not {buckets}")
    write_note(spark, f"{folder}/_buckets", str(buckets))
    schema = T.StructType([*source.schema.fields, T.StructField("_run", T.LongType()), T.StructField("_bucket", T.IntegerType())])

    def update(batch, number):
        if batch.isEmpty():
            return
        placed = batch.withColumn("_bucket", bucket_of(names, buckets))
        placed.write.mode("overwrite").partitionBy("_bucket").parquet(f"{folder}/history/_run={number}")
        history = spark.read.schema(schema).option("basePath", f"{folder}/history").parquet(f"{folder}/history/_run=*")
        touched = sorted(r[0] for r in history.where(F.col("_run") == number).select("_bucket").distinct().collect())
        kept = history.where((F.col("_run") <= number) & F.col("_bucket").isin(touched))
        keys = kept.where(F.col("_run") == number).select(*names).distinct()
        records = kept.join(keys, _same(kept, keys, names), "left_semi").drop("_run", "_bucket")
        tables, done = compute(records)
        try:
            replace_keys(spark, folder, number, keys, names, set(touched), tables, buckets)
        finally:
            done()

    return run_new(source, checkpoint, update)


def maintain_states(source, holidays, checkpoint, folder, sla_days=SLA_DAYS, buckets=BUCKETS, replace=False, **options):
    """First job with tickets that span runs: tables ``detail`` and ``verdicts``.

    After any split of a history into runs they equal the batch result over all of it;
    see ``read_maintained``. ``append_states`` computes a ticket from one run alone.
    """
    if options.get("scope", "ticket") != "ticket":
        raise ValueError("only scope='ticket' treats every ticket by itself")
    spark = source.sparkSession

    def compute(records):
        visited, staged = stage(visits(records, holidays, **options).select(*VISIT_COLUMNS), "visits")
        tables = {
            "detail": detail_of(visited),
            "verdicts": sla.verdict_table(sla.verdict_of(visited, sla_days)),
        }
        return tables, lambda: unstage(spark, staged)

    return maintain(source, ["id_ticket"], compute, checkpoint, folder, buckets, replace)
