"""Phrases whose words meet more often than their counts let expect, mined by sample.

Toivonen's way: a sample proposes the frequent words and phrases. A pass over all texts
counts these exactly, together with their negative border: the phrases that the sample
does not propose although it proposes all their parts. Single words are all counted; a
pair is, if both its words are proposed; three words are, if both their pairs are. Where
a phrase of the border turns out to be frequent it is proposed too, which moves the
border, and one more pass counts what is new inside. When no border phrase fails any
more, every frequent phrase has been counted, because its parts are frequent as well.
So the sample decides how many passes there are (four at most), not what is found.

Texts are read once. They are written to the shared folder as numbers: 64-bit hashes
of words, zero between pieces. Hashes that two words share would be noticed when the
words are counted, and texts are then hashed anew with another seed. The passes run
over these numbers. What is proposed travels as a bit table of fixed size, in which a
phrase may look proposed that is not; then it is counted in vain and its exact count
decides.
"""

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from deskpulse.llm.common import checkpoint_folder, checkpointed, column
from deskpulse.sources.tables import delete

LEAST = 10  # occurrences of a candidate
MOST_WORDS = 3
TOP = 2000
SHARE = 50  # percent of a phrase's occurrences inside a longer candidate that drop it
SCALE = 1_000_000
UNKNOWN = "und"
# One document in so many is sampled, and the least count there for a proposal.
SAMPLED, LEAST_SAMPLED = 16, 2
# Bits of a table of proposals, as a power of two: eight for each word of the vocabulary,
# but never more than 16 MB.
FEWEST_BITS, BITS = 16, 27
# Words whose numbers a worker remembers, and the longest of them in bytes.
REMEMBERED, LONGEST = 1 << 17, 64
# Words passed on, spelled, and counted, at once, and rows of counts.
ENCODED_AT_ONCE, SPELLED_AT_ONCE, COUNTED_AT_ONCE, ROWS_AT_ONCE = 200_000, 1 << 15, 300_000, 1 << 15
# Words of a row of numbers, about: a longer text is continued in further rows.
ROW = 128

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
MARK = b"\xff"  # no byte of UTF-8
ENCODED = "kind string, lang string, sampled boolean, ids array<long>, n long, id long, word string"
PHRASES = "lang string, a long, b long, c long, n long"
# Spark's setting for removing the shuffle files of an action when it ends.
REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df):
    """checkpointed, and the shuffle files behind it removed at once.

    Without the setting they stay until the driver happens to collect garbage, and those
    of several passes lie on disk together. A plan takes the setting when it is made.
    """
    conf = df.sparkSession.conf
    before = conf.get(REMOVED, "false")
    conf.set(REMOVED, "true")
    try:
        return checkpointed(df.select("*"))
    finally:
        conf.set(REMOVED, before)


def words_of(text):
    """Words of a text as bytes, MARK between pieces; A-Z lower-cased."""
    table = bytes.maketrans(PIECE_ENDS + b"\t", MARK * len(PIECE_ENDS) + b" ")
    marked = text.encode().lower().translate(table).replace(MARK, b" " + MARK + b" ")
    return [w for w in marked.split(b" ") if w]


def _rows(numbers):
    """A text's numbers, cut between pieces into rows of ROW words or a little more."""
    start = 0
    while len(numbers) - start > ROW:
        try:
            end = numbers.index(0, start + ROW)
        except ValueError:
            break
        yield numbers[start:end]
        start = end + 1
    yield numbers[start:]


def _hash(word, seed):
    return xxhash.xxh64_intdigest(word, seed)


def _encoding(seed):
    """Texts as numbers, with the spelling of each number a worker meets."""

    class Numbers(dict):
        """Number of a word; words that are not remembered are hashed again."""

        def __init__(self):
            super().__init__({MARK: 0})
            self.spelled, self.clashing = {}, []

        def __missing__(self, word):
            number = _hash(word, seed) or 1
            number -= (number >> 63) << 64
            if self.spelled.setdefault(number, word) != word:
                self.clashing.append((number, word))
            if len(word) <= LONGEST and len(self) < REMEMBERED:
                self[word] = number
            return number

    schema = pa.schema([
        ("kind", pa.string()), ("lang", pa.string()), ("sampled", pa.bool_()), ("ids", pa.list_(pa.int64())),
        ("n", pa.int64()), ("id", pa.int64()), ("word", pa.string()),
    ])

    def batch_of(kind, size, **columns):
        columns["kind"] = pa.array([kind] * size)
        return pa.RecordBatch.from_arrays(
            [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema
        )

    def spellings(numbers):
        spelled = [*numbers.spelled.items(), *numbers.clashing]
        numbers.spelled, numbers.clashing = {}, []
        return batch_of(
            "word", len(spelled), id=pa.array([i for i, _ in spelled], pa.int64()),
            word=pa.array([w.decode() for _, w in spelled], pa.string()),
        )

    def encode(batches):
        numbers = Numbers()
        for batch in batches:
            langs, texts, drawn = batch.columns
            lists, sizes, rows, size = [], [], [], 0
            for i in range(batch.num_rows):
                found = [numbers[w] for w in words_of(texts[i].as_py() or "")]
                for piece in _rows(found):
                    lists.append(piece)
                    sizes.append(len(piece) - piece.count(0))
                    rows.append(i)
                size += len(found)
                if len(numbers.spelled) > SPELLED_AT_ONCE:
                    yield spellings(numbers)
                if size > ENCODED_AT_ONCE or i + 1 == batch.num_rows:
                    picked = pa.array(rows, pa.int64())
                    yield batch_of(
                        "text", len(lists), lang=langs.take(picked), sampled=drawn.take(picked),
                        ids=pa.array(lists, pa.list_(pa.int64())), n=pa.array(sizes, pa.int64()),
                    )
                    lists, sizes, rows, size = [], [], [], 0
            yield spellings(numbers)
        pa.default_memory_pool().release_unused()

    return encode


def encoded(docs, seed=0):
    """Texts as numbers and the words behind the numbers, written to the shared folder.

    Returns (texts, words, folder); ``words`` is None if two words have one number.
    """
    spark = docs.sparkSession
    text = column("text")
    sampled = F.pmod(F.xxhash64(column("doc_id"), text), F.lit(SAMPLED)) == 0
    lang = F.coalesce(column("lang").cast("string"), F.lit(UNKNOWN))
    rows = docs.select(lang.alias("lang"), text.alias("text"), sampled.alias("sampled"))
    folder = f"{checkpoint_folder(spark)}/phrases-{uuid.uuid4().hex}"
    rows.mapInArrow(_encoding(seed), ENCODED).write.parquet(folder)
    read = spark.read.schema(ENCODED).parquet(folder)
    texts = read.where("kind = 'text'").select("lang", "sampled", "ids", "n")
    spelled = read.where("kind = 'word'").groupBy("id").agg(F.min("word").alias("word"), F.max("word").alias("other"))
    words = settled(spelled)
    if not words.where("word <> other").isEmpty():
        return texts, None, folder
    return texts, words.select("id", "word"), folder


# --- bit tables of proposals -----------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(*numbers):
    """One well-spread 64-bit number for a few, elementwise."""
    out = np.zeros_like(numbers[0], dtype=np.uint64)
    for number in numbers:
        out = (out ^ number.astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out * _MIX


def _lang_number(lang):
    return mixed(np.array([xxhash.xxh64_intdigest(lang.encode())], dtype=np.uint64))


def _slots(lang, numbers, bits):
    return (mixed(*numbers) ^ _lang_number(lang)) >> np.uint64(64 - bits)


def _marking(width, bits):
    """The 64-bit pieces of a bit table that phrases set."""

    def mark(batches):
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            codes = langs.indices.to_numpy()
            numbers = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("a", "b")[:width]]
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                here = codes == code
                slots = np.sort(_slots(lang, [x[here] for x in numbers], bits))
                at = slots >> np.uint64(6)
                starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                pieces = np.bitwise_or.reduceat(np.uint64(1) << (slots & np.uint64(63)), starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[starts].astype(np.int64)), pa.array(pieces.view(np.int64))], ["at", "bits"]
                )

    return mark


def proposals(frequent, width, bits):
    """The bit table of words or pairs: 2**bits bits, however many they are."""
    parts = ["a", "b"][:width]
    marked = frequent.select("lang", *[F.col(p).cast("long") for p in parts]).mapInArrow(_marking(width, bits), "at long, bits long")
    merged = marked.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[merged["at"].to_numpy()] = merged["bits"].to_numpy().view(np.uint64)
    return table


def _has(table, lang, numbers):
    slots = _slots(lang, numbers, 5 + len(table).bit_length())
    return (table[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


# --- counting --------------------------------------------------------------------------


def _counted(columns):
    """Distinct rows of some columns of numbers, and how often each comes."""
    key = mixed(*columns) if len(columns) > 1 else columns[0]
    order = np.argsort(key)
    key, columns = key[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(starts, len(key)))
    if any((c != np.repeat(c[starts], size)).any() for c in columns):  # two phrases have one key
        order = np.lexsort(columns)
        columns = [c[order] for c in columns]
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        starts = np.flatnonzero(np.append(True, new))
        size = np.diff(np.append(starts, len(order)))
    return [c[starts] for c in columns], size


def _passing(known, proposed, widths):
    """Counts, in one pass, of the phrases inside ``proposed`` that were not inside ``known``.

    Both hold, as broadcast values, bit tables of words and pairs or None. Pairs are
    counted where both words are proposed, three words where both pairs are.
    """

    def tables(of):
        return [x.value if x is not None else None for x in of]

    def inside(of, lang, ids, width):
        """Whether both parts, one word shorter, of every phrase are in a table."""
        table = of[width - 2]
        if table is None:
            return np.zeros(len(ids) - width + 1, dtype=bool)
        parts = _has(table, lang, [ids] if width == 2 else [ids[:-1], ids[1:]])
        return parts[:-1] & parts[1:]

    def count(batches):
        before, now = tables(known), tables(proposed)
        waiting, size = {}, 0

        def passed_on():
            while waiting:
                lang, lists = waiting.popitem()
                ids = np.concatenate(lists)
                if len(ids) < max(widths):
                    continue
                whole = ids != 0
                for width in widths:
                    columns = [ids[i : len(ids) - width + 1 + i] for i in range(width)]
                    good = np.logical_and.reduce([whole[i : len(ids) - width + 1 + i] for i in range(width)])
                    if width > 1:
                        good &= inside(now, lang, ids, width)
                        good &= ~inside(before, lang, ids, width)
                    picked = [c[good] for c in columns]
                    if not len(picked[0]):
                        continue
                    found, times = _counted(picked)
                    for start in range(0, len(times), ROWS_AT_ONCE):
                        some = slice(start, start + ROWS_AT_ONCE)
                        size = len(times[some])
                        none = pa.nulls(size, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang]).take(pa.array(np.zeros(size, dtype=np.int32)))]
                            + [pa.array(found[i][some]) if i < width else none for i in range(3)]
                            + [pa.array(times[some].astype(np.int64))],
                            ["lang", "a", "b", "c", "n"],
                        )

        gap = np.zeros(1, dtype=np.int64)
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            codes = langs.indices.to_numpy()
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy()
            numbers = lists.values.to_numpy()
            names = langs.dictionary.to_pylist()
            for i in range(batch.num_rows):
                ids = numbers[offsets[i] : offsets[i + 1]]
                if len(ids):
                    waiting.setdefault(names[codes[i]], [gap]).extend((ids, gap))
                    size += len(ids)
                    if size > COUNTED_AT_ONCE:
                        yield from passed_on()
                        waiting, size = {}, 0
        yield from passed_on()
        pa.default_memory_pool().release_unused()

    return count


def counts(texts, widths, least, proposed=(None, None), known=(None, None)):
    """(lang, a, b, c, n): exact counts of phrases, ``least`` and more; see ``_passing``."""
    context = texts.sparkSession.sparkContext
    shipped = {id(t): context.broadcast(t) for t in (*proposed, *known) if t is not None}
    counting = _passing([shipped.get(id(t)) for t in known], [shipped.get(id(t)) for t in proposed], widths)
    key = ["lang", "a", "b", "c"]
    parts = texts.select("lang", "ids").mapInArrow(counting, PHRASES)
    if min(widths) > 1:
        # workers have counted COUNTED_AT_ONCE words together, and few phrases of more words
        # meet again in a task: they are shuffled first and summed once
        parts = parts.repartition(*key)
    found = parts.groupBy(*key).agg(F.sum("n").alias("n"))
    found = settled(found.where(F.col("n") >= least))
    for table in shipped.values():
        table.destroy()
    return found


def frequent_phrases(texts, vocabulary, least=LEAST):
    """(lang, a, b, c, n) of all phrases of up to three words with ``least`` occurrences.

    ``vocabulary``: the number of words, for the size of the bit tables.
    """
    bits = min(BITS, max(FEWEST_BITS, (8 * vocabulary).bit_length()))
    sample = texts.where("sampled")
    bar = max(LEAST_SAMPLED, least // SAMPLED)
    words = proposals(counts(sample, (1,), bar), 1, bits)
    pairs = proposals(counts(sample, (2,), bar, (words, None)), 2, bits)
    known, found, counted, widths = (None, None), None, {}, (1, 2, 3)
    while widths:
        # one width at a time, so that only its counts are being shuffled
        for width in widths:
            fresh = counts(texts, (width,), least, (words, pairs), known)
            found = fresh if found is None else found.union(fresh)
            counted[width] = fresh
        known = (words, pairs)
        # border phrases that are frequent become proposals
        if 1 in widths:
            words = words | proposals(counted[1], 1, bits)
        if 2 in widths:
            pairs = pairs | proposals(counted[2], 2, bits)
        more_words, more_pairs = not np.array_equal(words, known[0]), not np.array_equal(pairs, known[1])
        widths = (2,) * more_words + (3,) * (more_words or more_pairs)
    return found


# --- scores ----------------------------------------------------------------------------


def _score(a, left, right):
    """floor(SCALE * a * a / (left * right)) in whole numbers."""
    def exact(x):
        return x.cast("decimal(18,0)")

    whole = exact(a) * exact(a) * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", whole.cast("decimal(38,0)"), (exact(left) * exact(right)).cast("decimal(38,0)"))


def scored(found, share=SHARE):
    """Candidates of two and three words with their lowest-scoring cut, inner ones dropped."""
    words = found.where("b IS NULL").select("lang", "a", "n")
    pairs = found.where("b IS NOT NULL AND c IS NULL").select("lang", "a", "b", "n")
    threes = found.where("c IS NOT NULL")

    def count_of(df, first, second, name):
        """Adds the count of the word, or of the pair, in the named columns."""
        if second is None:
            table = words.select("lang", F.col("a").alias(first), F.col("n").alias(name))
            return df.join(table, ["lang", first])
        table = pairs.select("lang", F.col("a").alias(first), F.col("b").alias(second), F.col("n").alias(name))
        return df.join(table, ["lang", first, second])

    inside = threes.select("lang", "a", "b", "n").union(threes.select("lang", "b", "c", "n")).toDF("lang", "a", "b", "n")
    longer = inside.groupBy("lang", "a", "b").agg(F.max("n").alias("longer"))
    alone = pairs.join(longer, ["lang", "a", "b"], "left").where(
        "longer IS NULL OR 100 * CAST(longer AS DECIMAL(38,0)) < %d * CAST(n AS DECIMAL(38,0))" % share
    )
    two = count_of(count_of(alone, "a", None, "l"), "b", None, "r")
    two = two.select("lang", "a", "b", F.lit(None).cast("long").alias("c"), "n", "l", "r", _score(F.col("n"), F.col("l"), F.col("r")).alias("score"))
    three = count_of(count_of(threes, "a", None, "l1"), "b", "c", "r1")
    three = count_of(count_of(three, "a", "b", "l2"), "c", None, "r2")
    three = three.withColumn("s1", _score(F.col("n"), F.col("l1"), F.col("r1"))).withColumn("s2", _score(F.col("n"), F.col("l2"), F.col("r2")))
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", "a", "b", "c", "n",
        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    return two.union(three)


def collocations(docs, least=LEAST, top=TOP, share=SHARE, seed=0):
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    ``docs`` has doc_id, lang and text. Texts are cut into pieces at . , ; : ! ? and line
    ends, pieces at blanks and tabs into words; A-Z are lower-cased. A candidate has two
    or three words and comes ``least`` times (a) in pieces of its language; l and r count
    the two parts of its lowest-scoring cut, n all words of the language. It is dropped
    if a longer candidate around it has ``share`` percent of its occurrences. Order: score,
    then a, both falling, then the phrase by bytes.

    A null language is 'und', a null text empty. A row that comes twice counts twice; an
    empty table gives no rows; other columns are ignored. Products are exact for counts
    below 10**15.
    """
    spark = docs.sparkSession
    while True:
        texts, words, folder = encoded(docs, seed)
        if words is not None:
            break
        delete(spark, folder)
        seed += 1
    found = frequent_phrases(texts, words.count(), least)
    candidates = settled(scored(found, share))
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"))
    # ties stay together here, the spelling decides below
    near_top = candidates.withColumn("place", F.rank().over(best_first)).where(F.col("place") <= top).drop("place")
    spelled = near_top
    for name in ("a", "b", "c"):
        table = words.select(F.col("id").alias(name), F.col("word").alias(f"word_{name}"))
        spelled = spelled.join(table, name, "left")
    spelled = spelled.withColumn("phrase", F.concat_ws(" ", "word_a", "word_b", "word_c"))
    totals = texts.groupBy("lang").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"), "phrase")
    result = (
        spelled.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score")
    )
    result = settled(result)
    delete(spark, folder)
    return result
