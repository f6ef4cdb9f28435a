"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source whose target is r times its size should appear r times on
average. The whole part of r is certain; the rest is a probability, and probabilities
are made whole in duels: two of them trade mass at random until one is 0 or 1. A duel
keeps the sum, and duels run in order of size, so a source ends near its target in words.
Bounded groups of documents are rounded in parallel; each leaves at most one document
undecided, and those meet in a tree of further groups until a source has one left.
"""

import random

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from deskpulse.llm.common import checkpointed, column

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 42
# Documents of one group of the first level, about, and children of a tree node.
GROUP = 250
FAN = 64
# Size classes for each doubling of the size.
CLASSES = 8
# Tables of targets or group counts up to this size are broadcast.
BROADCAST_ROWS = 100_000
EPSILON = 1e-9
# Rows alike are numbered in runs of so many.
RUN = 10_000


def source_targets(sizes, weights=WEIGHTS, share=SHARE, most=MOST):
    """Targets of sources: ``source``, ``source_size``, ``target``.

    ``sizes`` has ``source`` and ``source_size``. Sources in order of code points, null
    last, take the weights in turn and share ``share`` times all sizes by weight; a
    target stops at ``most`` times its source's size, and what is over is shared among
    the others by weight. The row numbers need all sources in one task: one row each.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    behind = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ahead = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("ratio", most * F.col("source_size") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
    )
    # What a unit of weight gets if exactly the sources with smaller ratios are full.
    levelled = ranked.withColumn(
        "level",
        (share * F.col("total") - most * F.coalesce(F.sum("source_size").over(ahead), F.lit(0)))
        / F.sum("weight").over(behind),
    ).withColumn("open", F.col("level") < F.col("ratio"))
    first_open = F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.struct("ratio", "place")))
    full = most * F.col("source_size")
    return levelled.withColumn("unit", first_open.over(everything)).select(
        "source",
        "source_size",
        F.when(F.col("unit").isNull(), full)
        .otherwise(F.least(full, F.col("unit") * F.col("weight")))
        .alias("target"),
    )


def _small(df):
    """Marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def duels(chances, sizes, rng):
    """(whole, undecided): 0, 1 or None per chance; (place, chance) of the None left, if any.

    Two undecided ones meet at a time, in the given order. Words move from one to the
    other until a chance is 0 or 1; the direction is drawn so that neither chance changes
    on average. The expected number of words stays as it is throughout.
    """
    whole = [None] * len(chances)
    held = None
    for at, chance in enumerate(chances):
        if held is None:
            held = at, chance
            continue
        other, p = held
        mine, theirs = sizes[at], sizes[other]
        up = min((1.0 - p) * theirs, chance * mine)
        down = min(p * theirs, (1.0 - chance) * mine)
        moved = up if rng.random() * (up + down) < down else -down
        held = None
        for place, left in ((other, p + moved / theirs), (at, chance - moved / mine)):
            if EPSILON < left < 1.0 - EPSILON:
                held = place, left
            else:
                whole[place] = int(left > 0.5)
    return whole, held


def _round(rows, keys, seed, last):
    """One level of the tree: each group of ``keys`` keeps one undecided row at most."""
    schema = rows.schema

    def run(table):
        table = table.sort_by([("size", "descending"), ("tie", "ascending")])
        name = "|".join(str(table.column(k)[0].as_py()) for k in keys)
        rng = random.Random(f"{seed}|{name}")
        chance = table.column("chance").to_pylist()
        whole, held = duels(chance, table.column("size").to_pylist(), rng)
        chance = [None] * len(whole)
        if held is not None and last:
            whole[held[0]] = int(rng.random() < held[1])
        elif held is not None:
            chance[held[0]] = held[1]
        for field, values in (("extra", whole), ("chance", chance)):
            at = table.schema.get_field_index(field)
            table = table.set_column(
                at, field, pa.array(values, type=table.schema.field(at).type)
            )
        return table.cast(pa.schema([table.schema.field(f.name) for f in schema.fields]))

    return checkpointed(rows.groupBy(*keys).applyInArrow(run, schema))


def _numbered(sized):
    """The rows, with ``nth`` telling rows alike apart.

    Rows alike are counted and written out again, so their numbers need no sort and do
    not depend on the order of rows.
    """
    alike = sized.groupBy(*sized.columns).agg(F.count("*").alias("rows"))
    first = F.explode(F.sequence(F.lit(1).cast("long"), "rows", F.lit(RUN).cast("long")))
    runs = alike.select(*sized.columns, "rows", first.alias("first"))
    last = F.least(F.col("rows"), F.col("first") + (RUN - 1))
    return runs.select(*sized.columns, F.explode(F.sequence("first", last)).alias("nth"))


def copies(documents, id_cols=("doc_id",), source_col="source", text_col="text", weights=WEIGHTS,
           share=SHARE, most=MOST, seed=SEED, group=GROUP):
    """Per document: ``size``, ``source_size``, ``target`` (its source's), ``copies``, ``taken``.

    ``size`` is the number of words, 0 for null and blank texts, and ``taken`` is
    ``copies`` times ``size``. Documents without words get no copy. A null source is a
    source of its own. Repeated rows are documents of their own. The choice depends on
    the rows and the seed, not on their order or partitions; rows alike in id, source
    and size may trade places. An empty table gives no rows.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    # ids get names of their own: an id column may have the name of a result column
    names = [f"key{i}" for i in range(len(id_cols))]
    sized = documents.select(
        *[column(c).alias(n) for c, n in zip(id_cols, names)],
        column(source_col).alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
    )
    # many rows may share an id, or have none: their number spreads them over the groups
    sized = checkpointed(_numbered(sized))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpointed(source_targets(sizes, weights, share, most))
    near = _small(targets.withColumnRenamed("source", "of"))
    wanted = sized.join(near, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ratio = F.least(
        F.lit(float(most)),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
    )
    base = F.when(F.col("size") == 0, 0).otherwise(F.floor(ratio + EPSILON)).cast("long")
    wanted = (
        wanted.withColumn("base", base)
        .withColumn("chance", F.when(F.col("size") > 0, F.greatest(F.lit(0.0), ratio - F.col("base"))))
        .withColumn("chance", F.when(F.col("chance") > EPSILON, F.col("chance")))
        .withColumn("extra", F.lit(None).cast("int"))
        .withColumn("class", F.floor(F.log2("size") * CLASSES).cast("int"))
        .withColumn("tie", F.xxhash64(*names, "nth", F.lit(seed)))
    )
    open_rows = wanted.where("chance is not null")
    counts = checkpointed(
        open_rows.groupBy("source", "class").agg(F.ceil(F.count("*") / group).alias("slots"))
    )
    most_slots = counts.agg(F.max("slots")).first()[0] or 0
    slots = _small(counts.withColumnRenamed("source", "of").withColumnRenamed("class", "sized"))
    level = (
        open_rows.join(
            slots, F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("sized"))
        )
        .withColumn("slot", F.pmod("tie", "slots"))
        .drop("of", "sized", "slots")
    )
    done = []
    keys = ["source", "class", "slot"]
    while most_slots:
        last = len(keys) == 1
        rounded = _round(level, keys, seed, last)
        done.append(rounded.where("extra is not null"))
        if last:
            break
        level = rounded.where("chance is not null")
        if most_slots > 1:
            most_slots = -(-most_slots // FAN)
            level = level.withColumn("slot", F.floor(F.col("slot") / FAN))
        else:
            keys = ["source"]
    settled = wanted.where("chance is null")
    for part in done:
        settled = settled.unionByName(part.drop("slot"))
    total = F.col("base") + F.coalesce("extra", F.lit(0))
    return settled.select(
        *[F.col(n).alias(c) for n, c in zip(names, id_cols)],
        "size",
        "source_size",
        "target",
        total.alias("copies"),
        (total * F.col("size")).alias("taken"),
    )


def mixed(documents, id_col="doc_id", source_col="source", text_col="text", **options):
    """The documents, each as often as the mix takes it; all columns stay.

    Rows with a null or repeated id are told apart by a number of their own.
    """
    columns = documents.columns
    ids = documents.groupBy(column(id_col).alias("odd")).count()
    odd = checkpointed(ids.where("odd is null or count > 1").select("odd"))
    row = F.struct(*[column(c) for c in columns]).alias("row")
    rows = documents.select(
        row, *[column(c).alias(n) for c, n in ((id_col, "id"), (source_col, "source"), (text_col, "text"))]
    )
    same = F.col("id").eqNullSafe(F.col("odd"))
    if odd.isEmpty():
        rows = rows.withColumn("at", F.lit(-1).cast("long"))
    else:
        numbered = rows.join(odd, same, "left_semi").withColumn("at", F.monotonically_increasing_id())
        rows = rows.join(odd, same, "left_anti").withColumn("at", F.lit(-1).cast("long"))
        rows = rows.unionByName(checkpointed(numbered))
    taken = copies(rows, ("id", "at"), "source", "text", **options).where("copies > 0")
    taken = taken.select(F.col("id").alias("of"), F.col("at").alias("nth"), "copies")
    joined = rows.join(taken, F.col("id").eqNullSafe(F.col("of")) & (F.col("at") == F.col("nth")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
