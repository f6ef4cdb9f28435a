"""SimHash near-duplicates against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from deskpulse.llm import simhash
from deskpulse.llm.bit_trie import forest_of
from deskpulse.llm.components import components


def plain_hash(text, width=4):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "")) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, budget=4):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    array = np.array(codes, dtype=np.uint64)
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= budget):
            a, b = sorted((find(i), find(int(j) + i + 1)))
            root[b] = a
    return [find(i) for i in range(len(codes))]


def near_codes(seed, bases, copies, flips):
    rng = random.Random(seed)
    codes = []
    for _ in range(bases):
        code = rng.getrandbits(64)
        codes.append(code)
        for _ in range(copies):
            code = codes[-1] if rng.random() < 0.5 else code
            for bit in rng.sample(range(64), rng.randint(1, flips)):
                code ^= 1 << bit
            codes.append(code)
    return sorted(set(codes))


@pytest.mark.parametrize("seed,bases,copies", [(1, 60, 8), (2, 1, 700), (3, 400, 0)])
def test_trie_walk_equals_all_pairs(seed, bases, copies):
    codes = near_codes(seed, bases, copies, 3)
    root = forest_of(
        np.array(codes, dtype=np.uint64), np.array([0]), list(range(63, -1, -1)), simhash.MAX_BITS
    )
    assert root.tolist() == plain_components(codes)


@pytest.mark.parametrize("n,blocks", [(10, 5), (10**6, 6), (10**9, 7)])
def test_masks_leave_no_near_pair_out(n, blocks):
    masks = simhash.key_masks(n)
    rng = random.Random(n)
    for _ in range(3000):
        apart = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(apart & m == 0 for m in masks)


@pytest.mark.parametrize("group", [8, 4096])
def test_links_connect_what_all_pairs_connect(spark, group):
    codes = near_codes(5, 120, 6, 3) + near_codes(6, 1, 300, 2)
    codes = sorted(set(codes))
    df = spark.createDataFrame([(simhash._signed(c),) for c in codes], "code long")
    found = {r["node"]: r["root"] for r in components(simhash.links(df, group=group)).collect()}
    want = plain_components(codes)
    by_root = {}
    for code, root in zip(codes, want):
        by_root.setdefault(root, []).append(simhash._signed(code))
    want = {c: min(cs) for cs in by_root.values() if len(cs) > 1 for c in cs}
    assert found == want


def test_whole_table_equals_all_pairs(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = documents.select("doc_id", "text").collect()
    codes = [plain_hash(r["text"]) for r in rows]
    roots = plain_components(codes)
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min(least.get(root, r["doc_id"]), r["doc_id"])
    want = {r["doc_id"]: (f"{c:016x}", least[root]) for r, c, root in zip(rows, codes, roots)}
    got = {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(documents).collect()}
    assert got == want
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))


LONG = "lorem ipsum dolor " * 20_000


def test_edges(spark):
    rows = [
        (1, "Ab cd\tef", "k"), (2, "aB  CD\nEF", "k"), (3, None, None), (4, "", "k"), (5, " \n", "k"),
        (None, "ab cd ef", "z"), (7, LONG, "k"), (8, LONG, "k"), (8, LONG, "k"), (None, "only without id", "q"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    zero = "0" * 16
    by_id = {}
    for i, code, component in got:
        assert code == f"{plain_hash(dict((r[0], r[1]) for r in rows if r[0])[i]):016x}" if i else True
        by_id.setdefault(i, []).append(component)
    assert by_id[1] == by_id[2] == [1]
    assert by_id[3] == by_id[4] == by_id[5] == [3]
    assert sum(code == zero for _, code, _ in got) == 3
    assert by_id[7] == [7] and by_id[8] == [7, 7]
    assert sorted(by_id[None], key=str) == [1, None]
    kept = sorted(((r["doc_id"], r["kept"]) for r in simhash.keep_one(df).collect()), key=str)
    assert kept == sorted([(1, "k"), (3, None), (7, "k"), (None, "q")], key=str)


def test_least_id_repeated_keeps_one_row(spark):
    df = spark.createDataFrame([(1, "b c d e", 1), (1, "b c d e", 2), (2, "b c d e", 3)], "doc_id long, text string, root int")
    kept = simhash.keep_one(df).collect()
    assert [r["doc_id"] for r in kept] == [1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.keep_one(df).collect() == []
