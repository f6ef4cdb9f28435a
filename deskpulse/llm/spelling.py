"""Spelling variants: words one edit apart, grouped under their frequent form.

Words are counted over whole texts. The vocabulary is dealt out by the state in which
a word starts the search: the one that its first letters lead to. Each partition builds
the minimised acceptor of its words and composes it with a one-edit transducer and
itself (``acceptor``), which yields the pairs that differ after those letters. The same
over reversed words yields the pairs that agree in their last letters.

An oversized starting state is replaced by the states some letters further on. Words
whose beginning and end were both lengthened so far that they overlap could differ
where neither side looks; only those meet by what remains without one letter, of which
there are few per word.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from deskpulse.llm.acceptor import Acceptor
from deskpulse.llm.common import checkpointed, column

LEAST_LENGTH, LEAST_COUNT = 7, 2
# A form is at least so many times as frequent as its variant.
RATIO = 10
# One occurrence in so many loses a letter; 0 leaves texts as they are.
NOISE = 31
# First letters that decide the partition; must leave a letter for the edit in the
# shortest words, seen from both ends.
LETTERS = 3
# An oversized state has more code points of words than this; then more letters decide.
MOST_IN_STATE = 100_000
# Code points of words a worker counts before it passes the counts on.
COUNTED_AT_ONCE = 16_000_000

COUNTS = "word string, n long"
FOUND = "word string, near long, best_n long, best string"


def _counting(least, noise):
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def count(batches):
        counts, size = Counter(), 0

        def passed_on():
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            ids, texts = batch.columns
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                if not text:
                    continue
                # bytes.lower() touches A-Z alone
                words = Counter(run.findall(text.encode().lower().decode()))
                if noise:
                    started = zlib.crc32(b"%s:" % (ids[i].as_py() or "").encode())
                    for word in list(words):
                        h = zlib.crc32(word.encode(), started)
                        if h % noise == 0:
                            times, at = words.pop(word), h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) >= least:
                                counts[word] += times
                for word, times in words.items():
                    if word not in counts:
                        size += len(word) + 50
                    counts[word] += times
                if size > COUNTED_AT_ONCE:
                    yield passed_on()
                    counts, size = Counter(), 0
        if counts:
            yield passed_on()

    return count


def word_counts(docs, least_length=LEAST_LENGTH, noise=NOISE):
    """(word, n) of the letter runs of whole texts, A-Z lower-cased, of a least length."""
    rows = docs.select(column("doc_id").cast("string"), column("text"))
    counted = rows.mapInArrow(_counting(least_length, noise), COUNTS)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def starting_states(words, spelling, name, letters=LETTERS, most=MOST_IN_STATE):
    """Adds the first letters that decide a word's partition, more where many share them."""
    words = words.withColumn(name, F.substring(spelling, F.lit(1), F.lit(letters)))
    while True:
        crowded = (
            words.groupBy(name)
            .agg(F.sum(F.length("word")).alias("size"), F.count("*").alias("words"))
            .where((F.col("size") > most) & (F.col("words") > 1) & (F.length(name) == letters))
            .select(name)
        )
        if crowded.isEmpty():
            return words
        further = letters + max(1, letters // 2)
        crowded = crowded.withColumn("crowded", F.lit(True))
        longer = F.substring(spelling, F.lit(1), F.lit(further))
        words = words.join(crowded, name, "left").withColumn(name, F.when(F.col("crowded"), longer).otherwise(F.col(name)))
        words = checkpointed(words.drop("crowded"))
        letters = further


def neighbours(words, counts, left, right):
    """Per word its number of near words and the place of the best of them.

    The best one is the most frequent, in case of ties the first in code-point order.
    """
    size = len(words)
    near = np.bincount(left, minlength=size) + np.bincount(right, minlength=size)
    order = np.lexsort((np.arange(size), -counts))
    rank = np.empty(size, dtype=np.int64)
    rank[order] = np.arange(size)
    best = np.full(size, size, dtype=np.int64)
    np.minimum.at(best, left, rank[right])
    np.minimum.at(best, right, rank[left])
    return near, best, order


def _composing(backwards):
    """Near words of the words of a partition that start in the same state."""

    def compose(table):
        words = np.array(table["word"].to_pylist(), dtype=object)
        counts = table["n"].to_numpy()
        own = np.array(table["tail" if backwards else "head"].to_pylist(), dtype=object)
        _, head = np.unique(np.array(table["head"].to_pylist(), dtype=object), return_inverse=True)
        out = {"word": [], "near": [], "best_n": [], "best": []}
        by_state = {}
        for i, state in enumerate(own):
            by_state.setdefault(state, []).append(i)
        for state, rows in by_state.items():
            if len(rows) < 2:
                continue
            skip = len(state)
            spelled = [(words[i][::-1] if backwards else words[i])[skip:] for i in rows]
            order = sorted(range(len(rows)), key=spelled.__getitem__)
            rows = np.array(rows)[order]
            lefts, rights = [], []
            for left, right in Acceptor([spelled[i] for i in order]).pairs():
                left, right = rows[left], rows[right]
                if backwards:  # pairs of one first state were found from there
                    apart = head[left] != head[right]
                    left, right = left[apart], right[apart]
                lefts.append(left)
                rights.append(right)
            if not lefts:
                continue
            inside = np.array(sorted(rows, key=words.__getitem__))
            place = np.empty(len(words), dtype=np.int64)
            place[inside] = np.arange(len(inside))
            left, right = place[np.concatenate(lefts)], place[np.concatenate(rights)]
            if not len(left):
                continue
            near, best, by_rank = neighbours(inside, counts[inside], left, right)
            for i in np.flatnonzero(near):
                form = inside[by_rank[best[i]]]
                out["word"].append(words[inside[i]])
                out["near"].append(int(near[i]))
                out["best_n"].append(int(counts[form]))
                out["best"].append(words[form])
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})

    return compose


def composed(words, backwards, partitions):
    """Near words of each word, seen from its beginning or from its end."""
    state = "tail" if backwards else "head"
    dealt = words.withColumn("part", F.pmod(F.xxhash64(state), F.lit(partitions)))
    return dealt.select("part", "word", "n", "head", "tail").groupBy("part").applyInArrow(_composing(backwards), FOUND)


def hidden(words):
    """Near words that share neither a first nor a last starting state.

    Such an edit lies inside both. The longer word, or either of equally long ones,
    drops each letter there; the shorter word stays as it is.
    """
    size, head, tail = F.length("word"), F.length("head"), F.length("tail")
    overlapping = words.where(head + tail >= size)
    first, last = F.greatest(F.lit(0), size - tail), head - 1
    dropped = overlapping.where(first <= last).withColumn("at", F.explode(F.sequence(first, last)))
    dropped = dropped.select(
        F.concat(F.substring("word", F.lit(1), F.col("at")), F.substring("word", F.col("at") + 2, F.length("word"))).alias("rest"),
        "at",
        F.coalesce(
            F.substring("word", F.col("at") + 1, F.lit(1)) != F.substring("word", F.col("at") + 2, F.lit(1)), F.lit(True)
        ).alias("ends_run"),
        "word", "n", "head", "tail",
    )
    kept = overlapping.select(F.col("word").alias("rest"), F.col("word"), "n", "head", "tail")
    names = ("word", "n", "head", "tail")

    def renamed(df):
        return df.withColumnsRenamed({c: f"other_{c}" for c in names})

    apart = "head <> other_head AND tail <> other_tail"
    changed = dropped.join(renamed(dropped.drop("ends_run")), ["rest", "at"]).where("word < other_word")
    added = dropped.where("ends_run").join(renamed(kept), "rest").where("word <> other_word")
    pairs = changed.select(*names, *(f"other_{c}" for c in names)).union(
        added.select(*names, *(f"other_{c}" for c in names))
    ).where(apart)
    links = pairs.select("word", "other_word", "other_n").union(pairs.select("other_word", "word", "n"))
    return links.select("word", F.lit(1).cast("long").alias("near"), F.col("other_n").alias("best_n"), F.col("other_word").alias("best"))


def near_words(words, letters=LETTERS, most=MOST_IN_STATE):
    """(word, near, best_n, best) of every word of (word, n) that has a near word."""
    words = starting_states(words, F.col("word"), "head", letters, most)
    words = checkpointed(starting_states(words, F.reverse("word"), "tail", letters, most))
    size = words.agg(F.coalesce(F.sum(F.length("word")), F.lit(0))).first()[0]
    shuffled = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(shuffled, 2 * size // most + 1)
    found = composed(words, False, partitions).union(composed(words, True, partitions)).union(hidden(words))
    best = found.groupBy("word").agg(
        F.sum("near").alias("near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("it")
    )
    return best.select("word", "near", (-F.col("it.n")).alias("best_n"), "it.best")


def roots(links):
    """(word, root) of links (word, form) without cycles: the last form that is reached.

    Every round doubles the length of the way that is taken, until nobody moves.
    """
    up = checkpointed(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = checkpointed(up.join(ahead, "root", "left"))
        if moved.where(F.col("further").isNotNull()).isEmpty():
            return up
        up = moved.select("word", F.coalesce("further", "root").alias("root"))


def variants(docs, least_length=LEAST_LENGTH, least_count=LEAST_COUNT, ratio=RATIO, noise=NOISE, letters=LETTERS, most=MOST_IN_STATE):
    """(word, form, root, n, n_near, form_n) of every word of the documents.

    ``docs`` has doc_id and text. Words are runs of letters (a-z, À-ÿ), A-Z lower-cased,
    of at least ``least_length`` code points and ``least_count`` occurrences. Two words are
    near if one inserted, dropped or changed code point turns one into the other. A word's
    form is its near word with the most occurrences, ties to the first in code-point order,
    if that has ``ratio`` times its own; its root the last form reached from it, or itself.

    Noise: where crc32 of ``<doc_id>:<run>`` is divisible by ``noise``, the run loses one
    letter in that document. A null id counts as an empty one, a null text has no words.
    A row that comes twice counts twice; an empty table gives no rows; columns beside
    doc_id and text are ignored.
    """
    if not 0 < letters <= (least_length - 1) // 2:
        raise ValueError("letters must leave one letter free in the shortest words")
    words = checkpointed(word_counts(docs, least_length, noise).where(F.col("n") >= least_count))
    near = words.join(near_words(words, letters, most), "word", "left")
    enough = F.col("best_n") >= F.col("n") * ratio
    known = checkpointed(
        near.select(
            "word",
            F.when(enough, F.col("best")).alias("form"),
            "n",
            F.coalesce("near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best_n")).alias("form_n"),
        )
    )
    last = roots(known.where(F.col("form").isNotNull()))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
