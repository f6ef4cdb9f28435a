"""Spelling variants against pairwise comparison."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from deskpulse.llm import spelling
from deskpulse.llm.acceptor import Acceptor


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def counted(docs, noise=31):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def plain(docs, least_length=7, ratio=10):
    """Words that share a deletion or are one are compared letter by letter."""
    n = {w: c for w, c in counted(docs).items() if len(w) >= least_length and c >= 2}
    met = {}
    for w in n:
        for key in deletions(w) | {w}:
            met.setdefault(key, []).append(w)
    near = {w: set() for w in n}
    for group in met.values():
        for a, b in itertools.combinations(group, 2):
            if is_near(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_acceptor_finds_all_pairs_once():
    r = random.Random(1)
    for _ in range(300):
        letters = "abç"[: r.randint(1, 3)]
        words = sorted({"".join(r.choices(letters, k=r.randint(0, 6))) for _ in range(r.randint(0, 60))})
        got = sorted(tuple(sorted((int(i), int(j)))) for a, b in Acceptor(words).pairs() for i, j in zip(a, b))
        assert got == [p for p in itertools.combinations(range(len(words)), 2) if is_near(words[p[0]], words[p[1]])]


def test_acceptor_is_minimal():
    a = Acceptor(["bake", "baked", "bakes", "cake", "caked", "cakes", "lake"])
    assert a.count[a.start] == 7
    endings = set()

    def language(state):
        words = {""} if a.final[state] else set()
        for letter, (target, _) in a.arcs[state].items():
            words |= {letter + w for w in language(target)}
        return words

    for state in range(len(a.final)):
        endings.add(frozenset(language(state)))
    assert len(endings) == len(a.final)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sum(w[1] is not None for w in want) > 5
    assert found(spelling.variants(docs)) == want


@pytest.mark.parametrize("most", [40, 300, 10**6])
def test_crowded_states(spark, most):
    """Words of one beginning and one end, so that states are lengthened until they overlap."""
    r = random.Random(most)
    words = {"pre" + "".join(r.choices("abé", k=r.randint(1, 6))) + "ing" for _ in range(250)}
    words |= {"".join(r.choices("ab", k=r.randint(7, 9))) for _ in range(250)}
    words |= {"longword" * 40 + x for x in ("", "a", "b", "ab")} | {"x" + "longword" * 40}
    text = " ".join(w for w in words for _ in range(r.choice((2, 3, 25, 300))))
    docs = [(1, text.upper()), (2, text)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = plain(docs)
    assert any(root != form and form for _, form, root, *_ in want)
    assert found(spelling.variants(df, most=most)) == want


def test_edges(spark):
    long = "abcdefghij " * 50_000
    docs = [
        (1, None), (2, ""), (3, "no w0rds of any l3ngth!"), (None, "Nullidword nullidword ÀÉÎÕÜÝÞ àéîõüýþ ÀÉÎÕÜÝÞ"),
        (4, long), (5, "abcdefghix abcdefghix"), (6, "tiefirst tiefirsta tiefirstb " * 2), (6, "tiefirst tiefirsta tiefirstb " * 2),
        (7, "×÷sevenup× ×÷sevenup× 日本語日本語日本語 straße-weg-lang straßenweg straßenweg"),
    ]
    df = spark.createDataFrame([(*d, 9, "x") for d in docs], "doc_id long, text string, n long, WORD string")
    got = found(spelling.variants(df))
    assert got == plain(docs)
    assert ("abcdefghix", "abcdefghij", "abcdefghij", 2, 1, 50_000) in got
    assert spelling.variants(df.where("false")).collect() == []
    assert spelling.variants(df.where("doc_id < 4")).collect() == []
