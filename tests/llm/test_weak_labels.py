"""Weak labels: expectation-maximisation row by row, and held-out accuracy."""

import random
from collections import Counter

import pytest

from deskpulse.llm import weak_labels


def plain_em(rows):
    """P(good) of each vote string, from the rows themselves."""
    p = [0.1 if "0" in r else 0.9 for r in rows]
    for _ in range(weak_labels.EM_STEPS):
        prior = (sum(p) + 1) / (len(rows) + 2)
        said = []
        for weight in (p, [1 - x for x in p]):
            own = []
            for k in range(len(rows[0])):
                good = sum(w for w, r in zip(weight, rows) if r[k] == "1")
                bad = sum(w for w, r in zip(weight, rows) if r[k] == "0")
                own.append((good + 1) / (good + bad + 2))
            said.append(own)
        new = []
        for r in rows:
            like = [prior, 1 - prior]
            for k, v in enumerate(r):
                for c in (0, 1):
                    like[c] *= {"1": said[c][k], "0": 1 - said[c][k], "-": 1.0}[v]
            new.append(like[0] / sum(like))
        p = new
    return dict(zip(rows, p))


def test_pattern_counts_equal_rows():
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        good = rng.random() < 0.8
        rows.append("".join(rng.choices("10-", (8, 1, 1) if good else (3, 6, 1))[0] for _ in range(4)))
    found, prior, right = weak_labels.estimate(Counter(rows))
    assert found == pytest.approx(plain_em(rows), rel=1e-6)
    assert 0.6 < prior < 0.95 and (right[0] > right[1]).all()


def test_held_out_accuracy(spark, sf_dir):
    """True labels take no part in training, so all of them are held out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = weak_labels.classify(documents)
    assert scored.count() == documents.count()
    rows = scored.join(labels, "doc_id").select("quality", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_stage_keeps_what_the_query_keeps(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = weak_labels.keep_good(documents)
    assert kept.columns == documents.columns
    want = {r["doc_id"] for r in weak_labels.classify(documents).collect() if r["kept"]}
    assert {r["doc_id"] for r in kept.collect()} == want
    dealt = weak_labels.keep_good(documents.repartition(7, "text"))
    assert {r["doc_id"] for r in dealt.collect()} == want


def test_edges(spark):
    good = "Some words make a sentence, and a few more make another. It ends here."
    bad = "$$$ &&& A!! *** B!! ||| ### C!! " * 30
    rows = [(i, good + f" No {i}.") for i in range(40)] + [(100 + i, bad) for i in range(10)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, good), (203, good + " word." * 30_000), (1, rows[1][1])]
    df = spark.createDataFrame([(*r, "v", 1.0) for r in rows], "doc_id long, text string, votes string, score double")
    got = weak_labels.classify(df).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert not any(by_id[i]["kept"] or by_id[i]["score"] for i in (200, 201, 202))
    assert by_id[None]["kept"] and by_id[1]["kept"] and not by_id[100]["kept"]
    kept = weak_labels.keep_good(df)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["kept"])
    assert weak_labels.classify(df.where("false")).collect() == []
    assert weak_labels.keep_good(df.where("false")).collect() == []
