"""Collocations against plain counting."""

import random
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from deskpulse.llm import collocations


def plain(docs, least=10, top=2000):
    """Every phrase counted in dictionaries."""
    f, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        text = "".join(c.lower() if c < "\x80" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for width in (1, 2, 3):
                counts.update(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        kept = []
        for p, a in candidates.items():
            if 100 * longer[p] >= 50 * a:
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def pairs_of(table):
    return [(r["lang"], r["text"]) for r in table.select("lang", "text").collect()]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain(pairs_of(docs))
    assert len(want) > 100
    assert found(collocations.collocations(docs)) == want


@pytest.mark.parametrize("sampled, bits", [(1, 27), (10**9, 27), (3, 8)])
def test_border_failures_are_mended(spark, sampled, bits, monkeypatch):
    """All texts sampled, none sampled, and bit tables in which nearly everything looks proposed."""
    monkeypatch.setattr(collocations, "SAMPLED", sampled)
    monkeypatch.setattr(collocations, "BITS", bits)
    monkeypatch.setattr(collocations, "COUNTED_AT_ONCE", 300)
    r = random.Random(sampled)
    words = [f"w{i}" for i in range(12)]
    docs = [(r.choice(("en", "de", None)), " ".join(r.choices(words, range(1, 13), k=r.randint(0, 30)))) for _ in range(300)]
    docs += [("en", "alpha beta gamma")] * 15 + [("en", "alpha beta")] * 10
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, lang string, text string")
    assert found(collocations.collocations(df, least=5, top=40)) == plain(docs, 5, 40)


def test_one_number_for_two_words_is_noticed(spark, monkeypatch):
    import xxhash

    real = xxhash.xxh64_intdigest
    docs = spark.createDataFrame([(1, "en", "one two " * 12), (2, "en", "six ten " * 12)], "doc_id long, lang string, text string")
    want = plain(pairs_of(docs))

    def weak(word, seed=0):
        return real(word, seed) if seed else len(word)

    monkeypatch.setattr(collocations, "_hash", weak)
    assert found(collocations.collocations(docs)) == want


def test_edges(spark):
    docs = [
        ("en", None), (None, ""), ("en", "..;;"), (None, "NULL lang\tphrase " * 11), ("en", "hot pair " * 60_000), ("en", "x" * 100_000 + " y"),
        ("de", "Tie Éa,tie Éa\rtie Éa\x0ctie Éa. " * 3), ("de", "a\x00b c\x1cd! " * 11), ("xx", "a  b\n" * 9), ("", "no name " * 10),
    ]
    df = spark.createDataFrame([(7, *d, 1, "x") for d in docs], "doc_id long, lang string, text string, N long, phrase string")
    got = found(collocations.collocations(df))
    assert got == plain(docs)
    assert collocations.collocations(df.where("false")).collect() == []
    assert collocations.collocations(df.where("text IS NULL")).collect() == []


def test_shuffle_files_of_a_pass_are_removed(spark):
    """Nothing that has been shuffled stays on disk beside the checkpoint."""
    block_manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def shuffled():
        folders = [str(f) for f in block_manager.diskBlockManager().localDirs()]
        return {str(p) for f in folders for p in Path(f).rglob("shuffle_*")}

    setting = spark.conf.get(collocations.REMOVED)
    before = shuffled()
    kept = collocations.settled(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(collocations.REMOVED) == setting
    assert sum(r["count"] for r in kept.collect()) == 1000
