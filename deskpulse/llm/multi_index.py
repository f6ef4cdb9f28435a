"""Nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised apart; a pair of centroids is a cell. A query
visits cells by the sum of its two squared distances, which a heap yields in order
without sorting all pairs, until the cells hold a given share of all entries. Those are
reranked by exact cosines.
"""

import heapq
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from deskpulse.llm.common import checkpointed, column

NEAREST = 5
# Vectors the centroids and the share of entries are fitted on, about, and queries of it.
SAMPLE = 20_000
SAMPLE_QUERIES = 200
# Share of the sample's true neighbours that must lie in the visited cells.
RECALL = 0.97
ROUNDS = 12
MOST_CENTROIDS = 256
# Entries and queries that meet in one task, about, and queries of one matrix product.
BLOCK = 2048
SLICE = 256
# Cosines of equal vectors may differ by so much between matrix products.
ROUNDING = 1e-12


def _assign(points, centroids):
    """Squared distances of points to centroids."""
    squares = (points * points).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)
    return squares - 2.0 * points @ centroids.T


def fit_half(points, k, rng):
    """k-means centroids of one half of the sample."""
    distinct = np.unique(points, axis=0)
    k = min(k, len(distinct))
    centroids = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = _assign(points, centroids).argmin(axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
    return centroids


def unit(vectors):
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cells_of(vectors, halves):
    """The cell of each vector."""
    cut = halves[0].shape[1]
    normed = unit(vectors)
    first = _assign(normed[:, :cut], halves[0]).argmin(axis=1)
    return first * len(halves[1]) + _assign(normed[:, cut:], halves[1]).argmin(axis=1)


def visit(first, second):
    """Cells in order of the sum of a distance from each list, by a heap."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    width = len(b)
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(rows[i]) * width + int(columns[j])
        if j + 1 < width:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def probed(vector, halves, counts, wanted):
    """The first cells that hold ``wanted`` entries together."""
    cut = halves[0].shape[1]
    normed = unit(vector[None, :])
    distances = _assign(normed[:, :cut], halves[0])[0], _assign(normed[:, cut:], halves[1])[0]
    cells, held = [], 0
    for cell in visit(*distances):
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
            if held >= wanted:
                break
    return cells


def fit(sample, n, nearest=NEAREST, recall=RECALL, seed=0):
    """(halves, share): centroids of both halves, and the share of entries to visit.

    The share is the one that reaches ``recall`` for queries of the sample against the
    sample itself. Neighbours among more vectors are closer, so it errs to the safe side.
    """
    rng = np.random.default_rng(seed)
    k = int(min(MOST_CENTROIDS, max(2, 2 ** round(log2(max(2, n / 64)) / 2))))
    cut = max(1, sample.shape[1] // 2)
    normed = unit(sample)
    halves = fit_half(normed[:, :cut].copy(), k, rng), fit_half(normed[:, cut:].copy(), k, rng)
    cells = cells_of(sample, halves)
    counts = np.bincount(cells, minlength=len(halves[0]) * len(halves[1]))
    needed = []
    for at in rng.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False):
        cosines = normed @ normed[at]
        cosines[at] = -2.0
        best = np.argsort(-cosines, kind="stable")[: min(nearest, len(sample) - 1)]
        held = {}
        total = 0
        for cell in probed(sample[at], halves, counts, len(sample)):
            total += counts[cell]
            held[cell] = total / len(sample)
        needed += [held[cell] for cell in cells[best]]
    share = float(np.quantile(needed, recall, method="higher")) if needed else 1.0
    return halves, share


def _valid(vectors, id_col, vector_col):
    """(id, vector) of the rows that take part, all of the most frequent length."""
    rows = vectors.select(
        column(id_col).cast("long").alias("id"),
        F.transform(column(vector_col), lambda x: x.cast("double")).alias("vector"),
    ).where(F.col("id").isNotNull())
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(sound & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count()
    dim = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == dim["n"]) if dim else rows.where("false"), dim


def _matrix(array):
    """The vectors as rows, each times the power of two that brings its largest component
    to between a half and one: cosines stay the same, and no square leaves the range."""
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(array), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def nearest(vectors, every=50, id_col="vec_id", vector_col="embedding", k=NEAREST, share=None):
    """The ``k`` nearest rows found of each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but
    those with the query's id. Score is the cosine in double precision, ties go to the
    smaller id; with fewer candidates all are returned. Rows without an id, and vectors
    that are null, zero, not finite, hold nulls or have another length than most, take no
    part. Repeated rows are candidates each; a repeated query is answered once.
    ``share`` of the entries is visited for a query; by default it is fitted.
    """
    spark = vectors.sparkSession
    rows, dim = _valid(vectors, id_col, vector_col)
    result = "query_id long, rank int, vec_id long, score double"
    if dim is None:
        return spark.createDataFrame([], result)
    n = rows.count()
    # each row by itself, so that one repeated over a large share is no larger a sample
    thin = rows.where(F.rand(0) * n < SAMPLE)
    if thin.isEmpty():
        thin = rows.limit(1)
    sample = _matrix(thin.select("vector").toArrow().column(0).combine_chunks())
    halves, fitted = fit(sample, n, k)
    wanted = max(k + 1, int(np.ceil(n * (fitted if share is None else share))))

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                cells = cells_of(_matrix(batch.column("vector")), halves)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells, type=pa.int32())], names=["id", "vector", "cell"]
                )

    placed = checkpointed(rows.mapInArrow(place, "id long, vector array<double>, cell int"))
    # At most MOST_CENTROIDS squared rows.
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    counts = np.zeros(len(halves[0]) * len(halves[1]), dtype=np.int64)
    counts[list(sizes)] = list(sizes.values())
    # Small cells share a block; a large one is cut into slots of about a block.
    first_block = np.zeros(len(counts), dtype=np.int64)
    slots = np.maximum(1, -(-counts // BLOCK))
    block, room = 0, 0
    for cell in np.flatnonzero(counts):
        if slots[cell] > 1 or room < counts[cell]:
            block, room = block + 1, BLOCK
        first_block[cell] = block
        if slots[cell] > 1:
            block, room = block + int(slots[cell]) - 1, 0
        else:
            room -= int(counts[cell])
    queries = placed.where(F.pmod("id", F.lit(every)) == 0).dropDuplicates(["id"])
    n_query_blocks = max(1, -(-n // (every * BLOCK)))

    def spread(batches):
        """Entries with the block they lie in; rows that share an id spread by their place."""
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            ids = batch.column("id").to_numpy().astype(np.uint64)
            slot = (ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) + np.arange(len(ids), dtype=np.uint64)
            slot = slot % slots[cells].astype(np.uint64)
            blocks = first_block[cells] + slot.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blocks, type=pa.int64())],
                names=["id", "vector", "cell", "block"],
            )

    def ask(batches):
        """A query once for each block it visits, with the visited cells there."""
        for batch in batches:
            matrix = _matrix(batch.column("vector")) if batch.num_rows else ()
            for at, vector in enumerate(matrix):
                cells = np.array(probed(vector, halves, counts, wanted), dtype=np.int64)
                where = np.repeat(first_block[cells], slots[cells])
                what = np.repeat(cells, slots[cells])
                start = np.repeat(np.cumsum(slots[cells]) - slots[cells], slots[cells])
                where = where + np.arange(len(where)) - start
                order = np.argsort(where, kind="stable")
                blocks, begin = np.unique(where[order], return_index=True)
                parts = np.split(what[order], begin[1:])
                m = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(m, batch.column("id")[at].as_py()), type=pa.int64()),
                        pa.array([vector] * m, type=pa.list_(pa.float64())),
                        pa.array(blocks, type=pa.int64()),
                        pa.array(parts, type=pa.list_(pa.int32())),
                    ],
                    names=["id", "vector", "block", "cells"],
                )

    entries = placed.mapInArrow(spread, "id long, vector array<double>, cell int, block long")
    entries = entries.withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)))
    )
    asked = queries.select("id", "vector").mapInArrow(
        ask, "id long, vector array<double>, block long, cells array<int>"
    ).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(n_query_blocks)).cast("int"))

    def rerank(asking, entry):
        answers = []
        if asking.num_rows and entry.num_rows:
            asking, entry = asking.combine_chunks(), entry.combine_chunks()
            e, ids = _matrix(entry.column("vector").chunk(0)), entry.column("id").to_numpy()
            cell = entry.column("cell").to_numpy()
            order = np.argsort(ids, kind="stable")
            e, ids, cell = e[order], ids[order], cell[order]
            norms = np.linalg.norm(e, axis=1)
            q, names = _matrix(asking.column("vector").chunk(0)), asking.column("id").to_numpy()
            cells = asking.column("cells").chunk(0)
            for at in range(0, len(q), SLICE):
                cosines = (q[at : at + SLICE] @ e.T) / norms
                for i, cosine in enumerate(cosines, at):
                    visited = np.isin(cell, cells[i].values.to_numpy())
                    answers.append(_best(cosine, q[i], names[i], visited, e, ids, norms, k))
        if answers:
            merged = [np.concatenate(x) for x in zip(*answers)]
        else:
            merged = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), merged)))

    found = (
        asked.groupBy("block", "part")
        .cogroup(entries.groupBy("block", "part"))
        .applyInArrow(rerank, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _best(cosines, query, name, visited, entries, ids, norms, k):
    """The best ``k`` visited entries of a block; ids are sorted."""
    allowed = np.flatnonzero(visited & (ids != name))
    if len(allowed) > k:
        cosine = cosines[allowed]
        limit = np.partition(cosine, len(cosine) - k)[len(cosine) - k]
        # the scale of a product is that of the query's length
        allowed = allowed[cosine >= limit - ROUNDING * np.linalg.norm(query)]
    score = (entries[allowed] * query).sum(axis=1) / (norms[allowed] * np.linalg.norm(query))
    best = np.lexsort((ids[allowed], -score))[:k]
    return np.full(len(best), name, dtype=np.int64), ids[allowed][best], score[best]
