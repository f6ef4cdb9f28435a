"""Exact top-k search by inner product, block at a time.

A vector is a document, a dimension a term, and a component the term's weight, turned
into a whole number. Documents are put into an order in which alike ones are close and
cut into blocks: ranges of that order, each with a forward index (the weights of its
documents, row by row) and the largest and smallest weight of every term. A query adds
up, over its terms, the larger of its two products; no score in the block is higher.

Ranges of blocks form shards of a bounded number of documents, which have a summary of
the same kind. A query is searched in its own shard first, which gives it a k-th score
to start from, then travels to the shards whose summary reaches that score. There it
takes the blocks by falling bound and scores them through their forward indexes until
the bounds of the rest lie below its k-th score. A block whose bound equals that score
is scored, because of ties. So nothing is left out that could be among the k.

What is sampled (about ``ORDERED_BY`` vectors) only decides the order of documents, never
the result. Where vectors have no clusters the bounds seldom help and nearly all blocks
are scored, as in a search by brute force.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from deskpulse.llm.common import checkpointed, column, small

# Documents of a block and, about, of a shard; queries that meet a shard at once.
BLOCK, SHARD, PART = 128, 8192, 1024
# Vectors, about, whose leading directions put the documents in order, and how many.
ORDERED_BY, DIRECTIONS = 5000, 12
# Longer vectors are ordered by a hash: no table of directions is made for them.
WIDEST = 2048
# Shard summaries that meet queries at once.
SUMMARIES = 512
SCALE = 256

EXACT = 2.0**53
FOUND = "query_id long, vec_id long, score long"
PLACED = (
    "shard int, kind string, query_id long, ids array<long>, weights array<long>, "
    "most array<long>, least array<long>"
)
VISITS = "query_id long, weights array<long>, floor long, shard int"


def usable(df, id_column, vector_column):
    """Rows that take part, as (id, vector)."""
    rows = df.select(
        column(id_column).cast("long").alias("id"), column(vector_column).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))


def whole_weights(values, scale=SCALE):
    """floor(scale * x), failing where 64 bits do not hold it."""
    scaled = np.floor(values * scale)
    if scaled.size and not np.abs(scaled).max() < 2.0**62:
        raise ValueError("a weight does not fit 64 bits")
    return scaled.astype(np.int64)


def exact_kind(queries, weights):
    """A type in which all scores are exact: doubles where they are, else 64-bit integers."""
    if not queries.size or not weights.size:
        return np.float64
    most = float(np.abs(queries).max()) * float(np.abs(weights).max()) * queries.shape[1]
    if most < EXACT:
        return np.float64
    if most < 2.0**62:
        return np.int64
    raise ValueError("a score does not fit 64 bits")


def bounds(queries, most, least):
    """Upper bounds of every query's scores in every block."""
    return np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T


def search(queries, floors, own, blocks, most, least, k):
    """The k best documents of some blocks for each query.

    ``floors``: scores that k documents elsewhere have already; ``own``: the id that is
    no candidate of a query; ``blocks``: (ids, weights) of each block. Returns the best
    ids and scores of each query, ties to smaller ids, and the number of blocks scored.
    """
    upper = bounds(queries, most, least)
    order = np.argsort(-upper, axis=1, kind="stable")
    none = np.empty(0, dtype=np.int64)
    best = [(none, none)] * len(queries)
    kth, scored = floors.copy(), 0
    everyone = np.arange(len(queries))
    for place in range(len(blocks)):
        chosen = order[:, place]
        asks = everyone[upper[everyone, chosen] >= kth]
        if not len(asks):
            break
        asks = asks[np.argsort(chosen[asks], kind="stable")]
        for group in np.split(asks, np.flatnonzero(np.diff(chosen[asks])) + 1):
            ids, weights = blocks[chosen[group[0]]]
            scores = queries[group] @ weights.T
            scored += len(group)
            reach = (scores >= kth[group][:, None]) & (ids[None, :] != own[group][:, None])
            for row in np.flatnonzero(reach.any(axis=1)):
                q = group[row]
                seen = np.concatenate([best[q][0], ids[reach[row]]])
                value = np.concatenate([best[q][1], scores[row][reach[row]].astype(np.int64)])
                keep = np.lexsort((seen, -value))[:k]
                best[q] = seen[keep], value[keep]
                if len(keep) == k:
                    kth[q] = max(kth[q], value[keep[-1]])
    return best, scored


def _directions(sample, count):
    """The directions in which the sample spreads most."""
    centred = sample - sample.mean(axis=0)
    spread, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, np.argsort(-spread, kind="stable")[:count]]


def _padded(lists, width, kind=np.float64):
    """Lists of numbers as rows of a matrix, shorter ones followed by zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), dtype=kind)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _placing(directions, middle, width):
    """Where documents of a batch stand in the order: the sides they are on, as bits."""

    def place(batches):
        for batch in batches:
            matrix = _padded(batch.column("vector"), width)
            sides = (matrix - middle) @ directions > 0
            number = sides @ (1 << np.arange(sides.shape[1])[::-1]) if sides.shape[1] else np.zeros(len(matrix))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(number.astype(np.int32))],
                ["id", "vector", "place"],
            )

    return place


def _packing(width, every, block, scale):
    """The documents of a partition, which is a shard, as blocks, a summary and queries."""

    def pack(batches):
        from pyspark import TaskContext

        table = list(batches)
        table = pa.Table.from_batches(table) if table else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("place", "ascending"), ("id", "ascending")])
        weights = whole_weights(_padded(table["vector"], width), scale)
        ids = table["id"].to_numpy()
        shard = TaskContext.get().partitionId()

        def row(kind, query=None, some=None, inside=None, most=None, least=None):
            return dict(shard=shard, kind=kind, query_id=query, ids=some, weights=inside, most=most, least=least)

        schema = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("query_id", pa.int64())]
                           + [(name, pa.list_(pa.int64())) for name in ("ids", "weights", "most", "least")])
        yield pa.RecordBatch.from_pylist(
            [row("summary", most=weights.max(axis=0), least=weights.min(axis=0))], schema
        )
        for start in range(0, len(ids), block):
            inside, some = weights[start : start + block], ids[start : start + block]
            yield pa.RecordBatch.from_pylist(
                [row("block", None, some, inside.reshape(-1), inside.max(axis=0), inside.min(axis=0))], schema
            )
        asks = np.flatnonzero(ids % every == 0)
        if len(asks):
            yield pa.RecordBatch.from_pylist(
                [row("query", int(ids[i]), None, weights[i]) for i in asks], schema
            )

    return pack


def _searching(width, k):
    """A function that meets some queries with the blocks of a shard."""

    def meet(left, right):
        found = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            queries = _padded(left["weights"], width, np.int64)
            own = left["query_id"].to_numpy()
            floors = left["floor"].to_numpy()
            most, least = (_padded(right[name], width, np.int64) for name in ("most", "least"))
            kind = exact_kind(queries, np.concatenate([most, least]))
            blocks = []
            for ids, weights in zip(right["ids"].combine_chunks(), right["weights"].combine_chunks()):
                ids = ids.values.to_numpy()
                blocks.append((ids, weights.values.to_numpy().reshape(len(ids), width).astype(kind)))
            best, _ = search(queries.astype(kind), floors, own, blocks, most.astype(kind), least.astype(kind), k)
            for q, (ids, scores) in enumerate(best):
                found["query_id"].append(np.full(len(ids), own[q]))
                found["vec_id"].append(ids)
                found["score"].append(scores)
        none = np.empty(0, dtype=np.int64)
        return pa.table({name: pa.array(np.concatenate([none, *parts])) for name, parts in found.items()})

    return meet


def _visiting(width):
    """A function that finds which shards some queries have to go to."""

    def visit(left, right):
        schema = pa.schema([("query_id", pa.int64()), ("weights", pa.list_(pa.int64())), ("floor", pa.int64()), ("shard", pa.int32())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        queries = _padded(left["weights"], width, np.int64)
        most, least = (_padded(right[name], width, np.int64) for name in ("most", "least"))
        kind = exact_kind(queries, np.concatenate([most, least]))
        upper = bounds(queries.astype(kind), most.astype(kind), least.astype(kind))
        home, shards = left["shard"].to_numpy(), right["shard"].to_numpy()
        go = (upper >= left["floor"].to_numpy()[:, None]) & (home[:, None] != shards[None, :])
        query, shard = np.nonzero(go)
        picked = left.take(pa.array(query))
        return pa.table(
            [picked["query_id"], picked["weights"], picked["floor"], pa.array(shards[shard], pa.int32())], schema=schema
        )

    return visit


def _best(found, k):
    """The k best rows of every query, numbered."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(df, every=50, k=5, id_column="vec_id", vector_column="embedding", scale=SCALE, block=BLOCK, shard=SHARD, part=PART):
    """(query_id, rank, vec_id, score): each query's k highest inner products.

    Queries are the rows whose id is divisible by ``every``, candidates all rows of
    another id; ties go to the smaller id. Components count as floor(scale * x). Rows
    without an id or a vector, and vectors with null or non-finite components, take no
    part. Shorter vectors end in zeros; an empty one scores 0. A candidate id that comes
    in several rows may be found several times; a query id that does asks with the least
    of its vectors. Weights or scores beyond 64 bits fail the job. An empty table gives
    no rows; other columns, whatever their names, are ignored.
    """
    rows = usable(df, id_column, vector_column)
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    middle, directions = np.zeros(width), np.zeros((width, 0))
    if 0 < width <= WIDEST and count > block:
        order = F.xxhash64("id", "vector", F.monotonically_increasing_id())
        sample = rows.withColumn("order", order).orderBy("order").limit(ORDERED_BY).select("vector").collect()
        matrix = np.zeros((len(sample), width))
        for i, (vector,) in enumerate(sample):
            matrix[i, : len(vector)] = vector
        wanted = min(DIRECTIONS, width, math.ceil(math.log2(count / block)))
        scale_down = max(1.0, float(np.abs(matrix).max()))
        middle = matrix.mean(axis=0)
        directions = _directions(matrix / scale_down, wanted)
    placed = rows.mapInArrow(_placing(directions, middle, width), "id long, vector array<double>, place int")
    shards = max(1, math.ceil(count / shard))
    slot = F.xxhash64("id", F.monotonically_increasing_id())
    dealt = placed.withColumn("slot", slot).repartitionByRange(shards, "place", "slot").drop("slot")
    packed = checkpointed(dealt.mapInArrow(_packing(width, every, block, scale), PLACED))
    blocks = packed.where("kind = 'block'").select("shard", "ids", "weights", "most", "least")

    asked = packed.where("kind = 'query'").groupBy("query_id").agg(F.min(F.struct("weights", "shard")).alias("it"))
    lowest = F.lit(-(2**62)).cast("long")
    queries = asked.select("query_id", "it.weights", "it.shard", lowest.alias("floor"))
    meet = _searching(width, k)
    at_home = checkpointed(
        queries.groupBy("shard").cogroup(blocks.groupBy("shard")).applyInArrow(meet, FOUND)
    )

    floors = at_home.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(lowest).alias("floor")
    )
    started = queries.drop("floor").join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", lowest))
    summaries = packed.where("kind = 'summary'").select("shard", "most", "least")
    number = summaries.agg(F.max("shard")).first()[0]
    groups = 1 + (number or 0) // SUMMARIES
    parts = max(1, math.ceil(count / every / part))
    started = started.withColumn("asks", F.pmod(F.xxhash64("query_id"), F.lit(parts))).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    grouped = summaries.withColumn("group", F.floor(F.col("shard") / SUMMARIES).cast("int")).withColumn(
        "asks", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    )
    visit = _visiting(width)
    visits = checkpointed(
        started.groupBy("asks", "group").cogroup(grouped.groupBy("asks", "group")).applyInArrow(visit, VISITS)
    )
    wanted = small(visits.groupBy("shard").agg(F.ceil(F.count("*") / part).cast("long").alias("parts")))
    went = visits.join(wanted, "shard").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts"))
    copies = blocks.join(wanted, "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    away = (
        went.drop("parts")
        .groupBy("shard", "part")
        .cogroup(copies.drop("parts").groupBy("shard", "part"))
        .applyInArrow(meet, FOUND)
    )
    return _best(at_home.union(away), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
