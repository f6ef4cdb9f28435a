"""Mixing: targets against repeated sharing, taken words against targets."""

import random
import re

import pytest

from deskpulse.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while len(full) < len(names):
        unit = (total - sum(most * sizes[n] for n in full)) / sum(weight[n] for n in names if n not in full)
        over = {n for n in names if n not in full and unit * weight[n] > most * sizes[n]}
        if not over:
            break
        full |= over
    return {n: most * sizes[n] if n in full else unit * weight[n] for n in names}


def check(df, rows, tolerance=1.0):
    """Everything that holds for any mix of (id, source, text) rows."""
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    targets = plain_targets(sizes)
    got = df.collect()
    assert len(got) == len(rows)
    largest, taken, by_id = {}, {}, {}
    for i, source, text in rows:
        by_id[i] = source
        largest[source] = max(largest.get(source, 0), len(WORD.findall(text or "")))
    for r in got:
        source = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source], abs=1e-6)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    for source, words in taken.items():
        assert abs(words - targets[source]) <= tolerance * largest[source] + 1e-6
    return got


def test_whole_table(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in documents.collect()]
    first = check(mixing.copies(documents), rows)
    dealt = documents.repartition(13, "text")
    again = mixing.copies(dealt).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


@pytest.mark.parametrize("group", [3, 40])
def test_tree_of_groups(spark, group, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 3)
    rng = random.Random(group)
    rows = [(i, rng.choice(["a", "b", "c", "c", "c", None]), "w " * rng.randint(0, 60)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    check(mixing.copies(df, group=group), rows)


def test_duels_keep_words_and_chances():
    rng = random.Random(0)
    chosen = [0, 0, 0]
    for _ in range(6000):
        whole, held = mixing.duels([0.3, 0.5, 0.45], [10, 20, 40], rng)
        words = sum(s * w for s, w in zip([10, 20, 40], whole) if w is not None)
        if held:
            words += held[1] * [10, 20, 40][held[0]]
            whole[held[0]] = int(rng.random() < held[1])
        assert words == pytest.approx(0.3 * 10 + 0.5 * 20 + 0.45 * 40)
        chosen = [c + w for c, w in zip(chosen, whole)]
    assert [c / 6000 for c in chosen] == pytest.approx([0.3, 0.5, 0.45], abs=0.02)


def test_edges(spark):
    rows = [
        (1, "a", None), (2, "a", ""), (3, "b", "w " * 5_000), (4, None, "x y"), (5, None, "x y"),
        (None, "b", "q r s"), (7, "b", "q r s"), (7, "b", "q r s"),
    ]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, source string, text string, size int")
    got = mixing.copies(df).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["taken"] for r in got if r["doc_id"] in (1, 2)} == {1: 0, 2: 0}
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    sizes = {"a": 0, "b": 5009, None: 4}
    words = dict.fromkeys(sizes, 0)
    for r in mixed.collect():
        assert r["size"] == 9
        words[r["source"]] += len((r["text"] or "").split())
    for source, target in plain_targets(sizes).items():
        assert abs(words[source] - target) <= {"a": 0, "b": 5000, None: 2}[source]


def test_no_rows_and_no_words(spark):
    df = spark.createDataFrame([(1, "a", " "), (2, None, None)], "doc_id long, source string, text string")
    assert [(r["target"], r["taken"]) for r in mixing.copies(df).collect()] == [(0.0, 0), (0.0, 0)]
    assert mixing.copies(df.where("false")).collect() == []
    assert mixing.mixed(df.where("false")).collect() == []


def test_rows_that_share_an_id_are_spread(spark, monkeypatch):
    """A third of the rows have no id, one size and one source; no group takes them all."""
    monkeypatch.setattr(mixing, "RUN", 7)
    sized = spark.createDataFrame(
        [(None, "a", 5)] * 400 + [(i, "a", 5) for i in range(800)], "key0 long, source string, size long"
    )
    numbered = mixing._numbered(sized)
    assert numbered.count() == 1200
    assert sorted(r["nth"] for r in numbered.where("key0 is null").collect()) == list(range(1, 401))

    seen, whole = [], mixing._round

    def spy(rows, keys, seed, last):
        seen.append(rows.groupBy(*keys).count().agg({"count": "max"}).first()[0])
        return whole(rows, keys, seed, last)

    monkeypatch.setattr(mixing, "_round", spy)
    rows = [(None, "a", "b c d e f")] * 400 + [(i, "b", "b c d e f") for i in range(800)]
    documents = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.copies(documents, group=50).collect()
    assert max(n or 0 for n in seen) <= 150 and len(got) == 1200
    by_source = {}
    for r in got:
        key = None if r["doc_id"] is None else "b"
        by_source[key] = by_source.get(key, 0) + r["taken"]
    targets = plain_targets({"a": 2000, "b": 4000})
    assert abs(by_source[None] - targets["a"]) <= 5 and abs(by_source["b"] - targets["b"]) <= 5
