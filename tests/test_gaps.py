"""Gaps of sparse numbers and within bounds, against sets."""

import random

import pytest
from pyspark.sql import functions as F

from chainmart.operators import scalar_key, to_fetch
from chainmart.operators.gaps import missing_numbers, number_gaps


def brute(numbers, first=None, last=None):
    if first is not None:
        numbers = {n for n in numbers if first <= n <= last} | ({first - 1, last + 1} if first <= last else set())
    line = sorted(numbers)
    return [(a + 1, b - 1) for a, b in zip(line, line[1:]) if b > a + 1]


def table(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n long")


@pytest.mark.parametrize("width", [3, 1 << 20])
def test_sparse_numbers(spark, width):
    rng = random.Random(1)
    numbers = {rng.randrange(-(1 << 62), 1 << 62) for _ in range(60)} | {5, 6, 7, 9, -1, -2, 1 << 61, (1 << 61) + 1}
    df = table(spark, [*numbers, *list(numbers)[:5], None])
    assert sorted(map(tuple, number_gaps(df, "n", width).collect())) == brute(numbers)


def test_bounds(spark):
    numbers = {3, 4, 8, 11, 20}
    df = table(spark, [*numbers, None])
    for first, last in ((1, 13), (4, 4), (5, 7), (3, 20), (21, 25), (9, 3)):
        assert sorted(map(tuple, number_gaps(df, "n", 4, first, last).collect())) == brute(numbers, first, last)
        want = [n for n in range(first, last + 1) if n not in numbers]
        assert sorted(r.n for r in missing_numbers(df, "n", 4, first, last).collect()) == want
    assert missing_numbers(df.limit(0), "n", first=1, last=3).count() == 3
    assert number_gaps(df.limit(0), "n", 4).count() == 0


@pytest.mark.parametrize("cursor, head, want", [(7, 10, (8, 10)), (None, 10, (6, 10)), (None, 2, (0, 2)), (10, 10, (11, 10))])
def test_what_to_fetch(spark, cursor, head, want):
    first, last = to_fetch(F.lit(cursor).cast("bigint"), F.lit(head), 5)
    assert tuple(spark.range(1).select(first, last).first()) == want


def test_a_member_that_has_to_be_there(spark):
    dim = spark.createDataFrame([(1, "a")], "k long, name string")
    key = lambda name, **more: spark.range(1).select(scalar_key(dim, F.col("name") == name, "k", **more)).first()[0]
    assert key("a", required=True) == 1 and key("b") is None
    with pytest.raises(Exception, match="no member"):
        key("b", required=True)
