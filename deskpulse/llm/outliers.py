"""Quality rules: robust multivariate outliers of text statistics, in Spark expressions.

Statistics of a text become a vector of logarithms. For each language and source the
minimum-covariance-determinant estimate of mean and covariance is searched: from several
starts, concentration steps estimate from the closest half of the rows, measure all rows
and take the closest half again, until the determinant stops falling; the lowest one wins.
Its rows within the 97.5 % bound give the final estimate. A row is rejected by its
Mahalanobis distance. All sums are of whole numbers and the starts are not random, so
results do not depend on the order of rows.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from deskpulse.llm.common import checkpoint_folder, checkpointed, column, let, small, word_list
from deskpulse.sources.tables import stage, unstage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
# Share of the rows an estimate rests on: up to half of a group may be outliers.
CORE = 0.5
# All starts take SCREENING steps; the FINALISTS of a group with the lowest determinants
# go on until theirs falls by less than SETTLED (in logarithms).
SCREENING = 2
FINALISTS = 2
SETTLED = 1e-6
# Tables of at most so many estimates are broadcast.
FEW = 100_000
# Vectors are whole multiples of 1/UNIT.
UNIT = 1000
# The statistics, and the spread of each, given those before it, that counts at least:
# shares that are zero in nearly every text would have none.
STATISTICS = {
    "length": 0.1,
    "word_length": 0.1,
    "symbols": 0.6,
    "dup_lines": 0.6,
    "repeats": 0.6,
    "capitals": 0.3,
}
FLOORS = [UNIT * spread for spread in STATISTICS.values()]
SIZE = len(STATISTICS)
# Languages and sources with fewer rows are pooled by language, then altogether: an
# estimate takes about five rows for each statistic.
MIN_ROWS = 5 * SIZE
# Points of the chi-square law with as many degrees of freedom as there are statistics (6).
MEDIAN = 5.348
POINT_975 = 14.449
# Squared distance from which a row is an outlier. Text statistics have longer tails than
# the normal law, under which three rows in a million lie so far off.
CUTOFF = 36.0


def _chi_square(x, freedom):
    """Share of the chi-square law below x, for an even number of degrees of freedom."""
    terms = [(x / 2) ** k / math.factorial(k) for k in range(freedom // 2)]
    return 1 - math.exp(-x / 2) * sum(terms)


# The closest rows of a normal sample spread less than all; covariances grow by these.
CORE_FACTOR = CORE / _chi_square(MEDIAN, SIZE + 2)
FINAL_FACTOR = 0.975 / _chi_square(POINT_975, SIZE + 2)


def _repeated_words(words):
    """Words in windows of three that occur twice or more, by 64-bit window hashes."""

    def covered(hashes):
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_sorted(s):
            again = F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(
                        (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return let(
                F.sort_array(again),
                lambda r: F.aggregate(
                    F.transform(r, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(r, k + 1) - x, F.lit(3)))),
                    F.lit(0),
                    lambda a, b: a + b,
                ),
            )

        return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), 0).otherwise(
            let(placed, of_sorted)
        )

    hashes = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.lit(0), F.size(words) - 2)),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return let(hashes, covered)


def statistics(text):
    """Struct of the counts of a text; see ``judge``."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.rlike(s, F.lit(r"[^\x20\x09-\x0D]")))
    without = F.translate(text, SYMBOLS, "")
    small_letters = F.regexp_replace(text, r"\p{Lu}+", "")
    counts = let(
        word_list(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
        ),
    )
    return F.struct(
        counts["n_words"].alias("n_words"),
        counts["word_chars"].alias("word_chars"),
        (F.char_length(text) - F.char_length(without)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        counts["n_repeat_words"].alias("n_repeat_words"),
        (F.char_length(text) - F.char_length(small_letters)).cast("long").alias("n_capitals"),
    )


def _vector():
    """The transformed statistics as whole numbers x0, x1, ..."""

    def share(name, of):
        return F.log1p(100 * F.col(name) / F.col(of))

    values = (
        F.log("n_words"),
        F.log(F.col("word_chars") / F.col("n_words")),
        share("n_symbols", "n_words"),
        share("n_dup_lines", "n_words"),
        share("n_repeat_words", "n_words"),
        share("n_capitals", "word_chars"),
    )
    return {f"x{i}": F.round(v * UNIT).cast("long") for i, v in enumerate(values)}


def _grouped(rows):
    """Rows with ``group``: language and source, pooled where rows are few; null if too few."""
    counts = rows.groupBy("lang", "source").count()
    few = F.when(F.col("count") < MIN_ROWS, F.col("count")).otherwise(0)
    by_lang = Window.partitionBy("lang")
    counts = counts.withColumn("few", few).withColumn("in_lang", F.sum("few").over(by_lang))
    rest = F.when(F.col("in_lang") < MIN_ROWS, F.col("few")).otherwise(0)
    total = counts.agg(F.sum(rest)).first()[0] or 0
    name = F.when(F.col("few") == 0, F.to_json(F.struct(F.lit(1), "lang", "source"))).when(
        F.col("in_lang") >= MIN_ROWS, F.to_json(F.struct(F.lit(2), "lang"))
    )
    if total >= MIN_ROWS:
        name = F.coalesce(name, F.lit("all"))
    names = checkpointed(
        counts.select(F.col("lang").alias("l"), F.col("source").alias("s"), name.alias("group"))
    )
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    return rows.join(small(names), same, "left").drop("l", "s")


def _starts(rows):
    """Estimates without covariances, by group, that concentration steps begin from.

    Start 0 has the median and quartiles of each statistic, start 1 the middle and width
    of its shortest half, and each further start measures one statistic alone, so that
    outliers in it are left out at once. Shortest halves are found to 5 % of the rows.
    """
    grid = UNIT // 100
    marks = [k / 20 for k in range(21)]
    found = rows.groupBy("group").agg(
        *[
            F.percentile(F.round(F.col(f"x{i}") / grid).cast("int"), F.array(*map(F.lit, marks))).alias(f"q{i}")
            for i in range(SIZE)
        ]
    )

    def mark(i, k):
        return F.get(F.col(f"q{i}"), F.lit(k)) * grid

    halves = {
        f"half{i}": F.array_min(
            F.array(
                *[
                    F.struct(
                        (mark(i, k + 10) - mark(i, k)).alias("width"),
                        ((mark(i, k + 10) + mark(i, k)) / 2).alias("middle"),
                    )
                    for k in range(11)
                ]
            )
        )
        for i in range(SIZE)
    }
    found = checkpointed(found.withColumns(halves))

    def start(number, middle, weight):
        columns = [middle(i).cast("double").alias(f"m{i}") for i in range(SIZE)]
        columns += [weight(i).cast("double").alias(f"w{i}_{i}") for i in range(SIZE)]
        return F.struct(F.lit(number).alias("start"), *columns)

    def middle(i):
        return F.col(f"half{i}")["middle"]

    def weight(i):
        return 1 / F.greatest(F.col(f"half{i}")["width"], F.lit(FLOORS[i]))

    every = [
        start(0, lambda i: mark(i, 10), lambda i: 1 / F.greatest(mark(i, 15) - mark(i, 5), F.lit(FLOORS[i]))),
        start(1, middle, weight),
        *[
            start(2 + only, middle, lambda i, only=only: weight(i) if i == only else F.lit(0.0))
            for only in range(SIZE)
        ],
    ]
    begun = found.select(F.col("group").alias("of"), F.explode(F.array(*every)).alias("s")).select("of", "s.*")
    return begun.withColumns({f"w{i}_{j}": F.lit(0.0) for i in range(SIZE) for j in range(i)})


def _distance():
    """Squared distance of a row from its group's estimate."""
    total = F.lit(0.0)
    for i in range(SIZE):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"w{i}_{j}") * (F.col(f"x{j}") - F.col(f"m{j}"))
        total = total + part * part
    return total


def _grid(distance):
    """A distance on a logarithmic grid, so that exact percentiles stay small."""
    return F.floor(F.log1p(distance) * 100).cast("int")


def _measured(rows, estimate):
    joined = rows.join(estimate, F.col("group") == F.col("of"))
    return joined.withColumn("distance", _distance()).select(*rows.columns, "start", "distance")


def _estimate(rows):
    """Mean, inverse Cholesky factor and determinant (its logarithm) of the covariance.

    Of the rows of each group and start. A pivot of the factor is at least the floor of its
    statistic, so statistics without spread, or that follow from others, do no harm.
    """
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(SIZE)]
    sums += [
        F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}")
        for i in range(SIZE)
        for j in range(i + 1)
    ]
    table = rows.groupBy("group", "start").agg(F.count("*").alias("n"), *sums)
    table = table.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(SIZE)})
    table = table.withColumns(
        {
            f"c{i}_{j}": F.col(f"p{i}_{j}") / F.col("n")
            - F.col(f"m{i}") * F.col(f"m{j}")
            for i in range(SIZE)
            for j in range(i + 1)
        }
    )
    # the factor column by column, then its inverse column by column
    for j in range(SIZE):
        done = [F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") for k in range(j)]
        pivot = F.greatest(F.col(f"c{j}_{j}") - sum(done, F.lit(0.0)), F.lit(float(FLOORS[j] ** 2)))
        table = table.withColumn(f"l{j}_{j}", F.sqrt(pivot))
        below = {}
        for i in range(j + 1, SIZE):
            dot = sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            below[f"l{i}_{j}"] = (F.col(f"c{i}_{j}") - dot) / F.col(f"l{j}_{j}")
        table = table.withColumns(below) if below else table
    for d in range(SIZE):
        diagonal = {}
        for j in range(SIZE - d):
            i = j + d
            if d == 0:
                diagonal[f"w{i}_{j}"] = 1 / F.col(f"l{i}_{i}")
            else:
                dot = sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0))
                diagonal[f"w{i}_{j}"] = -dot / F.col(f"l{i}_{i}")
        table = table.withColumns(diagonal)
    return table.select(
        F.col("group").alias("of"),
        "start",
        sum((2 * F.log(f"l{i}_{i}") for i in range(SIZE)), F.lit(0.0)).alias("determinant"),
        *[f"m{i}" for i in range(SIZE)],
        *[f"w{i}_{j}" for i in range(SIZE) for j in range(i + 1)],
    )


def _closest(measured, hint):
    """The rows of each group and start within its CORE quantile of distances."""
    limits = measured.groupBy(F.col("group").alias("of"), F.col("start").alias("begun")).agg(
        F.percentile(_grid(F.col("distance")), CORE).alias("limit")
    )
    same = (F.col("group") == F.col("of")) & (F.col("start") == F.col("begun"))
    joined = measured.join(hint(limits), same)
    return joined.where(_grid(F.col("distance")) <= F.col("limit"))


def _lowest(estimates, count):
    place = F.row_number().over(Window.partitionBy("of").orderBy("determinant", "start"))
    return estimates.withColumn("place", place).where(F.col("place") <= count).drop("place")


def _hint(count):
    """Marks tables of so many rows as ``small`` does, without counting each."""
    return F.broadcast if count <= FEW else lambda df: df


def _concentrated(rows, tried, hint):
    """What each estimate becomes by one step."""
    return _estimate(_closest(_measured(rows, hint(tried)), hint))


def _stepped(rows, tried, hint):
    """The estimates after one more step of the ``open`` ones, which stay so if theirs falls."""
    on = tried.where("open").drop("open")
    values = F.struct([c for c in on.columns if c not in ("of", "start")])
    after = _concentrated(rows, on, hint).select("of", "start", values.alias("after"))
    before = on.select("of", "start", values.alias("before"))
    falls = F.col("after.determinant") < F.col("before.determinant") - SETTLED
    compared = after.join(hint(before), ["of", "start"]).select(
        "of", "start", F.when(falls, F.col("after")).otherwise(F.col("before")).alias("e"), falls.alias("open")
    )
    return tried.where("not open").unionByName(compared.select("of", "start", "e.*", "open"))


def least_determinant(rows):
    """The estimate of the lowest determinant found for each ``group`` of vectors x0, x1, ...

    A step measures only the groups whose determinant still falls. Estimates go from step to
    step in files, as one table: a checkpoint hands on the size its plan was thought to have,
    which is a product over joins, so its digits would double with every step until they
    filled the driver.
    """
    spark = rows.sparkSession
    checkpoint_folder(spark)
    folders = []

    def staged(df):
        table, folder = stage(df, "estimates")
        folders.append(folder)
        while len(folders) > 1:
            unstage(spark, folders.pop(0))
        return table

    try:
        tried = staged(_starts(rows))
        hint = _hint(tried.count())
        for _ in range(SCREENING):
            tried = staged(_concentrated(rows, tried, hint))
        tried = staged(_lowest(tried, FINALISTS).withColumn("open", F.lit(True)))
        while count := tried.where("open").count():
            tried = staged(_stepped(rows, tried, _hint(count)))
        return checkpointed(_lowest(tried.drop("open"), 1))
    finally:
        for folder in folders:
            unstage(spark, folder)


def judge(
    documents, id_col="doc_id", text_col="text", lang_col="lang", source_col="source",
    cutoff=CUTOFF,
):
    """One row per document with its counts, ``base_failed``, ``distance`` and ``kept``.

    Counts: n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines
    with a word that equal an earlier line), n_repeat_words. Too short or repetitive
    texts fail the base rules; the others are judged by their distance from the robust
    estimate of their language and source (null counts as a value). Without MIN_ROWS rows
    even in the common pool ``distance`` is null and the base rules alone decide. Null and
    blank texts have no words. Repeated rows are judged alike, each on its own.
    """
    base = checkpointed(
        documents.select(
            column(id_col).alias("id"),
            column(lang_col).cast("string").alias("lang"),
            column(source_col).cast("string").alias("source"),
            statistics(column(text_col)).alias("s"),
        ).select("id", "lang", "source", "s.*")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    base = base.withColumn("base_failed", failed)
    passed = base.where("not base_failed").withColumns(_vector())
    rows = checkpointed(_grouped(passed))
    judged = rows.where("group is not null")
    raw = _measured(judged, small(least_determinant(judged)))
    final = checkpointed(_estimate(raw.where(F.col("distance") <= POINT_975 * CORE_FACTOR)))
    scaled = _measured(judged, small(final)).withColumn("distance", F.col("distance") / FINAL_FACTOR)
    counts = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    nothing = F.lit(None).cast("double").alias("distance")
    every = (
        scaled.select(*counts, "distance")
        .unionByName(rows.where("group is null").select(*counts, nothing))
        .unionByName(base.where("base_failed").select(*counts, nothing))
    )
    near = F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return every.withColumn("kept", ~F.col("base_failed") & near).withColumnRenamed("id", id_col)
