"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on a text. Expectation-maximisation finds
how accurate each is from the counts of all vote patterns, without any true label. The
posterior labels of a bounded sample train a linear scorer on hashed word shapes.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskpulse.llm.common import checkpointed, column, kept

GOOD, BAD, NOTHING = "1", "0", "-"
# (share, limit of good, limit of bad): bad from the second limit on, good below the first.
# They overlap: every kind of defect is in the eye of two or more.
LABELLERS = (
    ("symbols", 0.05, 0.3),  # symbols per word
    ("decorated", 0.05, 0.3),  # words that hold a symbol
    ("clutter", 0.1, 0.2),  # characters that are neither letters nor white space
    ("capitals", 0.2, 0.5),  # letters that are capitals
    ("exclamations", 0.05, 0.2),  # exclamation marks per word
    ("echoes", 0.05, 0.3),  # words equal to the one before
    ("dominated", 0.15, 0.3),  # words that are the most frequent one
    ("repeats", 0.1, 0.4),  # three-word windows seen more than once
    ("bare", 0.05, 0.25),  # words without letters or digits
    ("endless", 0.5, 0.95),  # lack of sentence ends
)
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 5
DOMINATED_WORDS = 20
# Documents the scorer is trained on, about.
SAMPLE = 20_000
SLOTS = 1 << 14
STEPS = 300
RATE = 0.1
PENALTY = 1e-5
EM_STEPS = 50
THRESHOLD = 0.5


class _Shapes(dict):
    """Character classes for str.translate, learnt as characters come."""

    def __missing__(self, code):
        c = chr(code)
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        self[code] = kind
        return kind


RUNS = re.compile(r"a{2,}|A{2,}|0{2,}")
SAME = re.compile(r"([^\saA0])\1+")
WITHOUT_WORD = re.compile(r"[^aA0]+")


def measure(text, shapes):
    """(shares, counts): what the labellers look at, and the hashed shapes of a text."""
    words = text.split()
    n = len(words)
    if n == 0:
        return None, {}
    pattern = text.translate(shapes)
    capitals = pattern.count("A")
    letters = capitals + pattern.count("a")
    pattern = SAME.sub(r"\1", RUNS.sub(lambda m: m[0][0], pattern))
    forms = Counter(pattern.split())
    echoes = sum(a == b for a, b in zip(words, words[1:]))
    windows = Counter(zip(words, words[1:], words[2:]))
    again = sum(c for c in windows.values() if c > 1)
    bare = sum(c for form, c in forms.items() if WITHOUT_WORD.fullmatch(form))
    ends = sum(text.count(c) for c in ".!?。")
    decorated = sum(c for form, c in forms.items() if any(x in form for x in SYMBOLS))
    shares = {
        "symbols": sum(text.count(c) for c in SYMBOLS) / n,
        "decorated": decorated / n,
        "clutter": 1.0 - letters / sum(map(len, words)),
        "capitals": capitals / max(1, letters),
        "exclamations": text.count("!") / n,
        "echoes": echoes / n,
        "dominated": max(Counter(words).values()) / n if n >= DOMINATED_WORDS else 0.0,
        "repeats": again / n,
        "bare": bare / n,
        "endless": 1.0 - min(1.0, 20.0 * ends / n),
    }
    counts = {}
    for form, c in forms.items():
        slot = zlib.crc32(form.encode()) % SLOTS
        counts[slot] = counts.get(slot, 0) + c
    for name, c in (("same word", echoes), ("same window", again)):
        slot = zlib.crc32(name.encode()) % SLOTS
        counts[slot] = counts.get(slot, 0) + c
    return shares, {slot: (c / n) ** 0.5 for slot, c in counts.items() if c}


def votes(shares, n_words):
    """One character per labeller."""
    if shares is None or n_words < LEAST_WORDS:
        return NOTHING * len(LABELLERS)
    return "".join(
        GOOD if shares[name] < good else BAD if shares[name] >= bad else NOTHING
        for name, good, bad in LABELLERS
    )


def estimate(patterns):
    """(prior, accuracy): share of good texts, and P(vote | class) of each labeller.

    ``patterns`` maps vote patterns to counts. Two classes, votes independent given the
    class; abstentions say nothing. Starts from the share of bad votes.
    """
    names = sorted(patterns)
    counts = np.array([patterns[p] for p in names], dtype=float)
    cast = np.array([[{GOOD: 1, BAD: 0, NOTHING: -1}[v] for v in p] for p in names])
    good, bad = cast == 1, cast == 0
    # One clear objection outweighs the labellers that look at something else.
    posterior = np.where(bad.any(axis=1), 0.1, 0.9)
    prior, right = 0.5, None
    for _ in range(EM_STEPS):
        of_good, of_bad = counts * posterior, counts * (1.0 - posterior)
        prior = (of_good.sum() + 1.0) / (counts.sum() + 2.0)
        said = [
            ((w @ good) + 1.0) / ((w @ good) + (w @ bad) + 2.0) for w in (of_good, of_bad)
        ]
        right = np.stack(said)  # P(vote good | class)
        logs = [
            np.log(p) + good @ np.log(r) + bad @ np.log(1.0 - r)
            for p, r in ((prior, right[0]), (1.0 - prior, right[1]))
        ]
        posterior = 1.0 / (1.0 + np.exp(logs[1] - logs[0]))
    return dict(zip(names, posterior)), prior, right


def train(rows, targets):
    """(weights, bias) of a logistic scorer; rows are (slots, values), targets P(good)."""
    lengths = np.array([len(s) for s, _ in rows])
    where = np.repeat(np.arange(len(rows)), lengths)
    slots = np.concatenate([s for s, _ in rows]) if len(rows) else np.zeros(0, int)
    values = np.concatenate([v for _, v in rows]) if len(rows) else np.zeros(0)
    y = np.asarray(targets, dtype=float)
    w, b = np.zeros(SLOTS), 0.0
    m, v = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(where, weights=values * w[slots], minlength=len(y)) + b
        error = 1.0 / (1.0 + np.exp(-z)) - y
        g = np.bincount(slots, weights=values * error[where], minlength=SLOTS) / max(1, len(y))
        g = np.append(g + PENALTY * w, error.mean() if len(y) else 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def measured(documents, id_col="doc_id", text_col="text"):
    """(id, votes, slots, weights) of every whole text; one pass over the texts."""
    source = documents.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            *T._parse_datatype_string("votes string, slots array<int>, weights array<float>"),
        ]
    )

    def run(batches):
        shapes = kept("shapes", _Shapes)
        for batch in batches:
            said, slots, weights = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                shares, counts = measure(text, shapes)
                said.append(votes(shares, len(text.split())))
                slots.append(list(counts))
                weights.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(said, type=pa.string()),
                    pa.array(slots, type=pa.list_(pa.int32())),
                    pa.array(weights, type=pa.list_(pa.float32())),
                ],
                names=["id", "votes", "slots", "weights"],
            )

    return source.mapInArrow(run, schema)


def fit(table, sample=SAMPLE):
    """(weights, bias, posterior by pattern) from the rows of ``measured``.

    All rows count for the labellers' accuracies: there are at most three votes to the
    power of the labellers patterns. About ``sample`` rows, chosen by a hash of what they
    hold, train the scorer.
    """
    patterns = {r["votes"]: r["count"] for r in table.groupBy("votes").count().collect()}
    if not patterns:
        return np.zeros(SLOTS), 0.0, {}
    posterior, _, _ = estimate(patterns)
    every = max(1, sum(patterns.values()) // sample)
    chosen = table.where(F.size("slots") > 0).where(
        F.pmod(F.xxhash64("id", "slots", "weights"), F.lit(every)) == 0
    )
    # dealt rows come back in any order; training must not depend on it
    rows = sorted(
        (r["votes"], tuple(r["slots"]), tuple(r["weights"]))
        for r in chosen.select("votes", "slots", "weights").toLocalIterator()
    )
    weights, bias = train(
        [(np.array(s), np.array(v)) for _, s, v in rows], [posterior[p] for p, _, _ in rows]
    )
    return weights, bias, posterior


def _good(slots, values, weights, bias):
    z = bias + sum(weights[s] * v for s, v in zip(slots, values))
    return 1.0 / (1.0 + np.exp(-z))


def classify(documents, id_col="doc_id", text_col="text", sample=SAMPLE, threshold=THRESHOLD):
    """One row per document: ``votes``, ``posterior``, ``score`` (P(good)), ``kept``.

    A document is kept if its score reaches ``threshold``. Null and blank texts have score
    zero and are not kept. Repeated rows are judged alike, each on its own; an empty table
    gives no rows.
    """
    table = checkpointed(measured(documents, id_col, text_col))
    weights, bias, posterior = fit(table, sample)
    schema = T.StructType(
        [
            table.schema["id"],
            *T._parse_datatype_string("votes string, posterior double, score double"),
        ]
    )

    def run(batches):
        for batch in batches:
            slots, values = batch.column("slots").to_pylist(), batch.column("weights").to_pylist()
            said = batch.column("votes").to_pylist()
            score = [_good(s, v, weights, bias) if s else 0.0 for s, v in zip(slots, values)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("votes"),
                    pa.array([float(posterior[p]) for p in said], type=pa.float64()),
                    pa.array(score, type=pa.float64()),
                ],
                names=["id", "votes", "posterior", "score"],
            )

    scored = table.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return scored.withColumn("kept", F.col("score") >= threshold)


def keep_good(documents, id_col="doc_id", text_col="text", sample=SAMPLE, threshold=THRESHOLD):
    """The documents ``classify`` keeps, with all their columns. Needs no join."""
    weights, bias, _ = fit(checkpointed(measured(documents, id_col, text_col)), sample)
    at = documents.columns.index(text_col)

    def run(batches):
        shapes = kept("shapes", _Shapes)
        for batch in batches:
            good = []
            for text in batch.column(at):
                _, counts = measure(text.as_py() or "", shapes)
                # the stored weights of a shape are single precision
                values = np.fromiter(counts.values(), dtype=np.float32, count=len(counts))
                good.append(
                    bool(counts) and bool(_good(counts, values.tolist(), weights, bias) >= threshold)
                )
            yield batch.filter(pa.array(good, type=pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
