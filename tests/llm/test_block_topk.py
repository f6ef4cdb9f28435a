"""Exact top-k search against all inner products."""

import random

import numpy as np
import pytest

from deskpulse.llm import block_topk

KIND = "vec_id long, embedding array<double>"


def plain(rows, every, k):
    """Every query's k best by scoring all candidates in Python's whole numbers."""
    import math

    weights = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i in {i for i, _ in weights if i % every == 0}:
        query = min(w for j, w in weights if j == i)
        scored = sorted((-sum(a * b for a, b in zip(query, w)), j) for j, w in weights if j != i)
        out[i] = [(j, -s) for s, j in scored[:k]]
    return {i: found for i, found in out.items() if found}


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_search_stops_at_the_bound():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 1000, (16, 8))
    blocks = [(np.arange(b * 32, b * 32 + 32), np.round(centres[b] + rng.normal(0, 5, (32, 8)))) for b in range(16)]
    most = np.array([w.max(axis=0) for _, w in blocks])
    least = np.array([w.min(axis=0) for _, w in blocks])
    queries = np.concatenate([w[:2] for _, w in blocks])
    own = np.concatenate([i[:2] for i, _ in blocks])
    best, scored = block_topk.search(queries, np.full(32, -(2**62)), own, blocks, most, least, 5)
    assert scored < 32 * 16 / 2
    ids, weights = np.concatenate([i for i, _ in blocks]), np.concatenate([w for _, w in blocks])
    for q, (found, scores) in enumerate(best):
        every = queries[q] @ weights.T
        order = [j for j in np.lexsort((ids, -every)) if ids[j] != own[q]][:5]
        assert list(found) == list(ids[order]) and list(scores) == list(every[order])


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert collected(block_topk.top_k(table)) == plain(rows, 50, 5)


@pytest.mark.parametrize("shard, part", [(64, 8), (1000, 1000)])
def test_clusters_ties_and_hot_vector(spark, shard, part, monkeypatch):
    monkeypatch.setattr(block_topk, "SUMMARIES", 3)
    rng = random.Random(shard)
    centres = [[rng.gauss(0, 3) for _ in range(6)] for _ in range(8)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in centres[i % 8]]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    df = spark.createDataFrame(rows, KIND)
    assert collected(block_topk.top_k(df, every=10, block=8, shard=shard, part=part)) == plain(rows, 10, 5)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, -0.5]), (50, [0.0, 2.0]), (None, [9.0, 9.0]), (100, None), (150, [0.0, 0.0]), (200, [1.0, None]),
        (250, [nan, 1.0]), (300, [inf, 1.0]), (350, [1.0, 2.0, 3.0]), (400, []), (7, [3.0, 0.0]), (7, [3.0, 0.0]),
        (500, [1.0, 1.0]), (500, [0.5, 1.0]), (8, [1e9, -1e9]),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND + ", rank int, SCORE string")
    assert collected(block_topk.top_k(df, k=4)) == plain(rows, 50, 4)
    assert collected(block_topk.top_k(df, k=50)) == plain(rows, 50, 50)
    assert block_topk.top_k(df.where("false")).collect() == []
    assert block_topk.top_k(df.where("vec_id = 0")).collect() == []
    with pytest.raises(Exception, match="does not fit 64 bits"):
        block_topk.top_k(spark.createDataFrame([(0, [1e300]), (1, [1.0])], KIND)).collect()
