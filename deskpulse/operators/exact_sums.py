"""Sums of doubles that are exact until one rounding at the end, whatever the partitions.

A double is a whole number times a power of two. It is cut into pieces of BITS bits, each a
whole number in a bin of fixed weight, so that pieces of one bin add up as longs without
rounding. Sums travel as rows (keys, _measure, _bin, _part), at most 90 bins to a sum; they
can be summed further, over fewer keys, as often as wanted. ``combined`` then carries the
bins over and rounds once to the nearest double, ties to even.

A bin holds 2**39 numbers of any size before its long overflows, which fails the job.
Infinities have bins of their own: one kind gives that infinity, both give NaN. Null and NaN
add nothing; a sum of nothing is null.
"""

from pyspark.sql import functions as F

BITS = 24
BASE = float(1 << BITS)
# Below 2**-500 numbers are moved up by 25 bins, so that their powers of two are no subnormals.
LOW, MOVED = 2.0**-500, 25
# A number of 53 bits lies in 4 bins; one more, because the logarithm may be just too high.
PIECES = 5
INFINITE = 1000
ROW = ["_measure", "_bin", "_part"]


def _let(value, body):
    """body(value) with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _power(bins):
    return F.pow(F.lit(2.0), (bins * BITS).cast("double"))


def spread(df, keys, numbers):
    """Rows (keys, _measure, _bin, _part) of some numbers, {measure: column}.

    A missing number gives one row of nulls, so that keys without numbers stay. All steps
    are plain columns, which Spark compiles; array functions with lambdas it does not.
    Measures are plain names, without quotes.
    """
    places = range(len(numbers))
    rows = df.select(*keys, *[x.cast("double").alias(f"_x{i}") for i, x in enumerate(numbers.values())])
    small = [F.abs(F.col(f"_x{i}")) < LOW for i in places]
    ends = [F.abs(F.col(f"_x{i}")) == float("inf") for i in places]
    present = [F.col(f"_x{i}").isNotNull() & ~F.isnan(f"_x{i}") for i in places]
    # _y: the number without small powers of two, _top: its highest bin
    rows = rows.withColumns(
        {
            f"_y{i}": F.when(ends[i], 0.0).when(small[i], F.col(f"_x{i}") * BASE**MOVED).when(present[i], F.col(f"_x{i}"))
            for i in places
        }
    )
    rows = rows.withColumns(
        {
            f"_top{i}": F.when(F.col(f"_y{i}") == 0, 0)
            .otherwise(F.floor(F.log2(F.abs(f"_y{i}")) / BITS))
            .cast("int")
            for i in places
        }
    )
    rows = rows.withColumns(
        {
            name: column
            for i in places
            for name, column in (
                (f"_z{i}", F.col(f"_y{i}") * _power(-F.col(f"_top{i}"))),
                (f"_moved{i}", F.when(small[i] & (F.col(f"_y{i}") != 0), MOVED).otherwise(0)),
                (f"_end{i}", ends[i]),
            )
        }
    )

    def piece(measure, i, n):
        # as text: as columns these would be hundreds of calls to the JVM
        if n:
            bin, part = f"_top{i} - {n} - _moved{i}", f"CAST(_z{i} * {BASE ** (n - 1):.1f}D % 1D * {BASE}D AS BIGINT)"
        else:
            bin = f"CASE WHEN NOT _end{i} THEN _top{i} - _moved{i} WHEN _x{i} > 0 THEN {INFINITE} ELSE {INFINITE + 1} END"
            part = f"IF(_end{i}, 1L, CAST(_z{i} AS BIGINT))"
        named = f"IF(_z{i} IS NULL, NULL, '{measure}')"
        return f"named_struct('m', {named}, 'bin', {bin}, 'part', {part}, 'first', {str(n == 0).lower()})"

    pieces = [piece(measure, i, n) for i, measure in enumerate(numbers) for n in range(PIECES)]
    rows = rows.select(*keys, F.expr(f"explode(array({', '.join(pieces)}))").alias("_piece"))
    rows = rows.filter(F.col("_piece.first") | (F.col("_piece.part") != 0))
    return rows.select(
        *keys,
        F.col("_piece.m").alias("_measure"),
        F.when(F.col("_piece.m").isNotNull(), F.col("_piece.bin")).alias("_bin"),
        F.col("_piece.part").alias("_part"),
    )


def summed(rows, keys):
    """The same over fewer keys, one row per keys, measure and bin."""
    return rows.groupBy(*keys, "_measure", "_bin").agg(F.sum("_part").alias("_part"))


def _carried(totals):
    """Digits of the bins, lowest first, and what is carried beyond: 0, or -1 if negative."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(state, total):
        return _let(
            state["carry"] + total,
            lambda t: F.struct(
                F.shiftright(t, BITS).alias("carry"),
                F.concat(state["digits"], F.array(t.bitwiseAND(F.lit((1 << BITS) - 1).cast("long")))).alias("digits"),
            ),
        )

    return F.aggregate(totals, start, step)


def _rounded(digits, low):
    """The nearest double of digits that are not negative; ``low`` is the lowest bin."""

    def at(place):
        return F.when(place >= 1, F.get(digits, place - 1)).otherwise(0)

    def from_places(places):
        top = F.element_at(places, -1)
        # what lies below four digits only tells whether there is more: an odd last bit
        more = F.element_at(places, 1) < top - 3
        last = F.when(more, at(top - 3).bitwiseOR(F.lit(1).cast("long"))).otherwise(at(top - 3))
        upper = (at(top) * (1 << BITS) + at(top - 1)).cast("double")
        lower = (at(top - 2) * (1 << BITS) + last).cast("double")
        exponent = (low + top - 4) * BITS
        half = F.floor(exponent / 2)
        # one rounding, in the addition; powers of two in two steps, which no range cuts
        value = upper * F.lit(BASE * BASE) + lower
        return value * F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (exponent - half).cast("double"))

    places = F.filter(F.sequence(F.lit(1), F.size(digits)), lambda i: F.get(digits, i - 1) != 0)
    return _let(places, lambda p: F.when(F.size(p) == 0, 0.0).otherwise(from_places(p)))


def _nearest(bins):
    """The double of an array of (bin, total), one per bin; null if it is empty."""
    finite = F.filter(bins, lambda b: b["bin"] < INFINITE)
    ends = F.transform(F.filter(bins, lambda b: b["bin"] >= INFINITE), lambda b: b["bin"])

    def from_map(by_bin):
        low = F.array_min(F.map_keys(by_bin))
        # a carry of 39 bits fits two more bins, the third shows the sign
        every = F.sequence(low, F.array_max(F.map_keys(by_bin)) + 3)
        totals = F.transform(every, lambda b: F.coalesce(F.try_element_at(by_bin, b), F.lit(0).cast("long")))

        def signed(state):
            turned = F.when(state["carry"] < 0, _carried(F.transform(totals, lambda t: -t))["digits"])
            size = _let(F.coalesce(turned, state["digits"]), lambda digits: _rounded(digits, low))
            return F.when(state["carry"] < 0, -size).otherwise(size)

        return _let(_carried(totals), signed)

    return (
        F.when(F.size(bins) == 0, None)
        .when(F.size(ends) == 2, float("nan"))
        .when(F.array_contains(ends, INFINITE), float("inf"))
        .when(F.array_contains(ends, INFINITE + 1), float("-inf"))
        .otherwise(_let(F.map_from_entries(finite), from_map))
    )


def combined(rows, keys, measures):
    """One row per keys with the sum of every measure as a double.

    At most 90 bins of a measure meet in a row, however many numbers went in.
    """
    entry = F.struct(F.col("_bin"), F.col("_part"))
    collected = summed(rows, keys).groupBy(*keys).agg(
        *[F.collect_list(F.when(F.col("_measure") == m, entry)).alias(m) for m in measures]
    )
    kind = "array<struct<bin:int,part:bigint>>"
    # the same function for all, so that it is built once
    sums = F.transform(F.array(*[F.col(m).cast(kind) for m in measures]), _nearest)
    return collected.select(*keys, sums.alias("_sums")).select(
        *keys, *[F.col("_sums")[i].alias(m) for i, m in enumerate(measures)]
    )
