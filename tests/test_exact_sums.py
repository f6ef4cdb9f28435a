"""Exact sums against math.fsum."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from deskpulse.operators.exact_sums import combined, spread, summed

PLANTED = [
    [0.1, 0.1, 0.1],
    [1e16, 1.0, -1e16],
    [1.2345678901234567e-07, 1e-25, 2e16],
    [5e-324, 5e-324, 5e-324],
    [2.2250738585072014e-308, -5e-324],
    [1e308, -1e308, 1e308],
    [2.0**24, 2.0**48, -(2.0**24)],
    [1.0, -1.0],
    [0.0],
    [-0.1, -0.2],
    # just above, at and just below the middle of two doubles
    [2.0**53, 1.0, 2.0**-1000],
    [2.0**53, 1.0],
    [2.0**53, 1.0, -(2.0**-1000)],
]


def _any_bits(rng):
    while True:
        (x,) = struct.unpack("<d", rng.randbytes(8))
        if math.isfinite(x) and abs(x) < 1e305:
            return x


def _groups(count):
    rng = random.Random(5)
    for i in range(count):
        n = rng.randint(1, 12)
        if i % 4 == 0:
            yield [_any_bits(rng) for _ in range(n)]
        elif i % 4 == 1:
            yield [round(rng.uniform(-100, 100), 2) for _ in range(n)]
        elif i % 4 == 2:
            yield [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(n)]
        else:  # large numbers cancel, a small one stays
            big = [_any_bits(rng) for _ in range(n)]
            yield [*big, *[-x for x in big], _any_bits(rng) * 2.0**-300]


def _sums(spark, groups, parts):
    rows = [(g, x) for g, numbers in groups.items() for x in numbers]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(parts)
    totals = combined(spread(df, ["g"], {"total": F.col("x")}), ["g"], ["total"])
    return {r.g: r.total for r in totals.collect()}


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_equal_fsum(spark, parts):
    groups = dict(enumerate([*PLANTED, *_groups(800)]))
    got = _sums(spark, groups, parts)
    different = {g: (v, got[g], math.fsum(v)) for g, v in groups.items() if got[g] != math.fsum(v)}
    assert not different


def test_missing_and_infinite_numbers(spark):
    inf, nan = math.inf, math.nan
    groups = {0: [None, nan], 1: [inf, 1.0, None], 2: [-inf, 1e308], 3: [inf, -inf], 4: [nan, 2.5], 5: [1e308, 1e308]}
    got = _sums(spark, groups, 2)
    assert math.isnan(got.pop(3))
    assert got == {0: None, 1: inf, 2: -inf, 4: 2.5, 5: inf}


def test_sums_of_sums(spark):
    """Summing in two steps, over fewer keys, rounds no more than summing at once."""
    rng = random.Random(9)
    numbers = [(i % 5, i % 3, rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30)) for i in range(600)]
    df = spark.createDataFrame(numbers, "a int, b int, x double")
    rows = summed(summed(spread(df, ["a", "b"], {"x": F.col("x"), "y": -F.col("x")}), ["a", "b"]), ["a"])
    for r in combined(rows, ["a"], ["x", "y"]).collect():
        assert r.x == math.fsum(x for a, _, x in numbers if a == r.a)
        assert r.y == -r.x


def test_empty_table(spark):
    df = spark.createDataFrame([], "g int, x double")
    assert combined(spread(df, ["g"], {"x": F.col("x")}), ["g"], ["x"]).collect() == []
