"""Nearest neighbours against brute force."""

import random

import numpy as np
import pytest

from deskpulse.llm import multi_index


def plain(rows, every, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    best = {}
    for i in sorted(set(ids[ids % every == 0])):
        cosine = unit @ unit[np.flatnonzero(ids == i)[0]]
        order = [j for j in np.lexsort((ids, -np.round(cosine, 12))) if ids[j] != i]
        best[int(i)] = [(int(ids[j]), cosine[j]) for j in order[:k]]
    return best


def test_heap_visits_cells_in_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    cells = list(multi_index.visit(a, b))
    sums = [a[c // 5] + b[c % 5] for c in cells]
    assert sorted(cells) == list(range(35)) and sums == sorted(sums)


def test_recall_on_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want = plain(rows, 10)
    got = {}
    for r in multi_index.nearest(table, every=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    cosines = {(q, i): c for q, best in plain(rows, 10, len(rows)).items() for i, c in best}
    for q, found in got.items():
        assert [rank for _, _, rank in found] == list(range(1, len(found) + 1))
        assert all(score == pytest.approx(cosines[q, i], abs=1e-12) for i, score, _ in found)


@pytest.mark.parametrize("block", [16, 8192])
def test_all_cells_give_the_exact_answer(spark, block, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # a hot cell of ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.nearest(df, every=10, share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for i, _ in best] for q, best in plain(rows, 10).items()}


def test_vectors_of_any_length(spark):
    rng = random.Random(4)
    directions = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(200)]
    rows = list(enumerate(directions))
    far = [(i, [x * 10.0 ** (i % 5 * 140 - 290) for x in v]) for i, v in rows]
    df = spark.createDataFrame(far, "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.nearest(df, every=10, share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = plain(rows, 10)
    assert {q: [i for i, _ in best] for q, best in got.items()} == {q: [i for i, _ in best] for q, best in want.items()}
    for q, best in got.items():
        assert [c for _, c in best] == pytest.approx([c for _, c in want[q]], abs=1e-12)


def test_id_repeated_over_a_large_share(spark, monkeypatch):
    """The sample stays small, and the rows of one id fill several blocks."""
    monkeypatch.setattr(multi_index, "SAMPLE", 100)
    monkeypatch.setattr(multi_index, "BLOCK", 32)
    sampled, fit = [], multi_index.fit
    monkeypatch.setattr(multi_index, "fit", lambda sample, *rest: sampled.append(len(sample)) or fit(sample, *rest))
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(7, rows[7][1])] * 300
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.nearest(df, every=10, share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for i, _ in best] for q, best in plain(rows, 10).items()}
    assert 50 <= sampled[0] <= 200


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (50, [0.0, 2.0]), (None, [1.0, 1.0]), (100, None), (150, [0.0, 0.0]), (200, [1.0, None]),
        (250, [float("nan"), 1.0]), (300, [float("inf"), 1.0]), (350, [1.0, 2.0, 3.0]), (350, []), (7, [3.0, 0.0]), (7, [3.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = [tuple(r) for r in multi_index.nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 1.0), (0, 2, 7, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 7, 0.0), (50, 3, 7, 0.0)]
    assert multi_index.nearest(df.where("false")).collect() == []
    assert multi_index.nearest(df.where("vec_id = 0")).collect() == []
