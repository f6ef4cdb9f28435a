"""Byte-level BPE by a tree and token counts, against the libraries."""

import hashlib
import random

import numpy as np
import pytest

from deskpulse.llm import bpe_tree, token_counts

PIECES = [
    "a", "b", "ll", "'", "'s", "'ll", " ", "  ", "\n", "\t", "1", "22", "!", "..", "é", "漢", "字",
    " ", "́", "xxx", "the", "ING", "²", "Ⅷ", "🙂", "\x1c", "​", "<|endoftext|>",
    "<|startoftext|>", "<|", "A", "İ", "ß", "ſ",
]
EDGES = [None, "", " ", "\n", "word", "x" * 40_000, "漢字" * 9_000, " " * 30_000, "ab' " * 5_000, "a b " * 20_000]


def texts(seed, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    return bpe_tree.codec()


@pytest.mark.parametrize("leaf", [1, 3, 7, 50])
def test_tree_equals_library(codec, leaf):
    for text in texts(leaf, 1500, 60):
        assert codec.encode(text, leaf) == codec.encoding.encode_ordinary(text), repr(text)


def test_runs_without_a_boundary_are_joined_by_tokens(codec, monkeypatch):
    monkeypatch.setattr(bpe_tree, "WIDE", 3)
    rng = random.Random(1)
    for _ in range(800):
        run = "".join(rng.choices(["a", "th", "ing", "é", "漢", "字", "tion", "qu"], k=rng.randint(0, 300)))
        text = rng.choice(["", " ", "! "]) + run + rng.choice(["", " z"])
        assert codec.encode(text, rng.randint(1, 30)) == codec.encoding.encode_ordinary(text)


def test_round_trip_of_whole_table(spark, sf_dir, codec):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in bpe_tree.round_trip(documents).collect()}
    for r in documents.collect():
        ids = codec.encoding.encode_ordinary(r["text"] or "")
        raw = np.array(ids, dtype="<u4").tobytes()
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        want = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == want
    assert len(got) == documents.count()


def test_edges_repeats_and_clashing_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(EDGES)] + [(None, "word", None), (4, "word", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe_tree.encode_texts(df, leaf=1000)
    assert encoded.columns == ["doc_id", "ids"]
    back = bpe_tree.decode_ids(encoded, leaf=500)
    want = sorted((i is not None, i, t or "") for i, t, _ in rows)
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["text"]) for r in back.collect())
    assert [w[1:] for w in want if w[0]] == [g[1:] for g in got if g[0]] and len(got) == len(rows)
    assert bpe_tree.round_trip(df.where("false")).count() == 0
    assert bpe_tree.encode_texts(df.where("false")).collect() == []


def test_counts_equal_library(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows += list(enumerate(texts(2, 500, 40) + EDGES, 10**6))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe_tree.tokenizer_file(token_counts.TOKENIZER)[0])
    for r, (_, text) in zip(token_counts.token_counts(df, max_tokens=100).orderBy("doc_id").collect(), sorted(rows, key=lambda x: x[0])):
        n = len(library.encode(text or "", add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 100)


def test_counts_of_nothing_and_of_repeats(spark):
    df = spark.createDataFrame([(None, "a b", 1), (1, "a b", 2), (1, "a b", 2)], "doc_id long, text string, n_tokens int")
    assert [r["n_tokens"] for r in token_counts.token_counts(df).collect()] == [2, 2, 2]
    assert token_counts.token_counts(df.where("false")).count() == 0


def test_parts_are_cut_at_white_space_only():
    text = b"ab cd  efgh\nij" * 50
    parts = list(token_counts.parts_of(text, 10))
    assert len(parts) > 20
    assert b"".join(b"".join(p.split()) for p in parts) == b"".join(text.split())
    assert [w for p in parts for w in p.split()] == text.split()


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    counter = token_counts.Counter(bpe_tree.tokenizer_file(token_counts.TOKENIZER)[0])
    assert counter.counts([f"w{i} x" for i in range(100)]) == [counter.counts([f"w{i} x"])[0] for i in range(100)]
    assert len(counter.known) <= 12
