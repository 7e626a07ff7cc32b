import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainmart import operators as op
from chainmart.operators.gaps import number_gaps

T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- as-of join


def naive_asof(points, quotes):
    out = []
    for key, t in points:
        best = None
        for k, q, ident, price in quotes:
            if key is not None and k == key and q <= t and (best is None or (q, ident) > best[:2]):
                best = (q, ident, price)
        out.append((key, t, *(best[1:] if best else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("slot", ["hour", "day", "minute"])
def test_asof_equals_nested_loop(spark, slot, unique):
    rnd = random.Random(len(slot) * 2 + unique)
    at = lambda: T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 50))
    # one key holds most of the rows, one has no quotes, one quote in four has no price
    key = lambda: rnd.choice(["hot", "hot", "hot", "a", "b", None])
    points = [(key(), at()) for _ in range(150)] + [("bare", T0)]
    points = sorted(set(points), key=str) if unique else points + points[:20]
    quotes = [(rnd.choice(["hot", "hot", "a", "b", None]), at(), i, rnd.choice([None, 1.0 * i, 2.0 * i, 3.0 * i])) for i in range(120)]
    quotes += [("a", quotes[0][1], 1000 + i, float(i)) for i in range(3)]  # ties at one instant
    left = spark.createDataFrame(points, "k string, t timestamp_ntz").repartition(5)
    right = spark.createDataFrame(quotes, "k string, q timestamp_ntz, ident int, price double").repartition(5)
    got = op.asof_join(left, right, "t", "q", ["ident", "price"], by=["k"], tie="ident", slot=slot, left_is_unique=unique)
    assert rows(got) == naive_asof(points, quotes)


def test_asof_keeps_other_columns_and_includes_equal_times(spark):
    left = spark.createDataFrame([(T0, "x", 1), (T0 - dt.timedelta(seconds=1), "y", 2)], "t timestamp_ntz, name string, n int")
    right = spark.createDataFrame([(T0, None), (T0 - dt.timedelta(days=9), 4.0)], "q timestamp_ntz, price double")
    got = op.asof_join(left, right, "t", "q", ["price"], left_is_unique=True)
    assert got.columns == ["t", "name", "n", "price"]
    assert rows(got) == [(T0 - dt.timedelta(seconds=1), "y", 2, 4.0), (T0, "x", 1, None)]


# ---- gaps


@pytest.mark.parametrize("width", [3, 10, 1000])
def test_missing_numbers(spark, width):
    rnd = random.Random(width)
    present = [n for n in range(-40, 300) if rnd.random() < 0.5 and not 100 <= n < 180] + [5000]
    df = spark.createDataFrame([(n,) for n in present * 2 + [None]], "n bigint")
    got = [r[0] for r in op.missing_numbers(df, "n", width).orderBy("n").collect()]
    assert got == sorted(set(range(min(present), max(present))) - set(present))


def test_one_huge_gap_is_expanded_in_pieces(spark):
    df = spark.createDataFrame([(0,), (1_000_001,)], "n bigint")
    assert op.missing_numbers(df, "n").agg(F.count("n"), F.min("n"), F.max("n")).first() == (1_000_000, 1, 1_000_000)
    assert number_gaps(df, "n", 10).collect() == [(1, 1_000_000)]


def test_no_gap_no_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "n bigint")
    assert op.missing_numbers(df, "n", 2).count() == 0


def test_missing_minutes(spark):
    seen = [T0 + dt.timedelta(minutes=m, seconds=30) for m in (0, 1, 3, 70)]
    df = spark.createDataFrame([(t,) for t in seen], "ts timestamp_ntz")
    end = T0 + dt.timedelta(minutes=75)
    got = [r[0] for r in op.missing_minutes(df, "ts", T0, end).orderBy("minute_ts").collect()]
    assert got == [T0 + dt.timedelta(minutes=m) for m in range(76) if m not in (0, 1, 3, 70)]
    capped = [r[0] for r in op.missing_minutes(df, "ts", T0, end, max_minutes=5).orderBy("minute_ts").collect()]
    assert capped == [T0 + dt.timedelta(minutes=m) for m in (2, 4)]
    assert op.missing_minutes(df, "ts", end, T0).count() == 0


# ---- statistics


def spread(kind, n):
    rnd = random.Random(n)
    if kind == "uniform":
        return [rnd.uniform(-5, 5) for _ in range(n)]
    if kind == "hot":  # one value holds most of the rows
        return [rnd.choice([1.0, 1.0, 1.0, 2.0, rnd.random()]) for _ in range(n)]
    return [rnd.lognormvariate(0, 6) for _ in range(n)]


PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def quantiles_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    return {r["p"]: r["value"] for r in op.exact_quantiles(df, ["v"], PROBS).collect()}


@pytest.mark.parametrize("kind", ["uniform", "hot", "heavy"])
@pytest.mark.parametrize("n", [1, 2, 7, 1000, 20000])
def test_exact_quantiles(spark, kind, n):
    values = spread(kind, n)
    got = quantiles_of(spark, values)
    for p in PROBS:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-9), p


@pytest.mark.parametrize("buckets", [2, 3])
def test_exact_quantiles_through_many_passes(spark, monkeypatch, buckets):
    monkeypatch.setattr("chainmart.operators.stats.BUCKETS", buckets)
    values = spread("uniform", 60) + [0.25] * 200
    got = quantiles_of(spark, values)
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in PROBS}, rel=1e-9)


def test_exact_quantiles_of_extreme_values(spark):
    tiny, huge = 5e-324, 1.7e308
    got = quantiles_of(spark, [-huge, huge, tiny, 0.0, 2 * tiny])
    assert (got[0.0], got[0.25], got[0.5], got[0.75], got[1.0]) == (-huge, 0.0, tiny, 2 * tiny, huge)
    inf, nan = float("inf"), float("nan")
    got = quantiles_of(spark, [-inf, 1.0, 2.0, inf, nan])
    assert (got[0.0], got[0.25], got[0.5], got[0.75]) == (-inf, 1.0, 2.0, inf) and np.isnan(got[1.0])
    assert quantiles_of(spark, []) == {}


def test_describe(spark):
    values = spread("uniform", 500)
    df = spark.createDataFrame([(v, 3.0) for v in values], "a double, b double")
    a, b = op.describe(df, ["a", "b"]).orderBy("measure").collect()
    assert (a["count"], a["min"], a["max"]) == (500, min(values), max(values))
    assert a["mean"] == pytest.approx(statistics.mean(values))
    assert a["std"] == pytest.approx(statistics.stdev(values))
    assert (b["std"], b["p25"], b["p50"], b["p75"]) == (0.0, 3.0, 3.0, 3.0)


def test_regression_line(spark):
    pairs = [(float(x), 2.0 * x + 1) for x in range(10)] + [(None, 1.0), (3.0, None), (float("nan"), 1.0), (1.0, float("inf"))]
    line = op.regression_line(spark.createDataFrame(pairs, "x double, y double"), "x", "y").orderBy("point").collect()
    assert len(line) == 100 and line[0]["n"] == 10
    assert (line[0]["x"], line[-1]["x"]) == (0.0, 9.0)
    assert line[0]["slope"] == pytest.approx(2.0) and line[-1]["y"] == pytest.approx(19.0)
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert op.regression_line(one, "x", "y").count() == 0
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert {r["slope"] for r in op.regression_line(flat, "x", "y").collect()} == {None}


# ---- quality, marks, joins, coercion


def test_rules_report_the_first_failure_and_lose_no_row(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (None, -1), (2, None), (3, -1)], "a int, b int")
    rules = [op.Rule("a", F.col("a").isNotNull()), op.Rule("b", F.col("b") > 0)]
    valid, rejects = op.split_valid(df, rules)
    assert rows(valid) == [(1, 5)]
    assert rows(rejects) == sorted([(None, 5, "a"), (None, -1, "a"), (2, None, "b"), (3, -1, "b")], key=str)
    assert rows(op.quality_counters(df, rules)) == [("a", 2), ("b", 2), ("valid", 1)]


def test_constraint_violations(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, None), (None, 99), (None, 99)], "id int, ref int")
    parent = spark.createDataFrame([(10,)], "pk int")
    got = op.constraint_violations(
        unique=[("child", child, ["id"])],
        not_null=[("child", child, ["id", "ref"])],
        foreign=[("child", child, "ref", parent, "pk")],
    )
    assert rows(got) == sorted(
        [("unique", "child", "1", 2), ("not_null", "child", "id", 2), ("not_null", "child", "ref", 1), ("foreign_key", "child", "99", 2)],
        key=str,
    )


def test_incremental_scan(spark):
    df = spark.createDataFrame([(1, 5), (2, 1), (3, None)], "a int, b int")
    assert rows(op.incremental_scan(df, {"a": 1})) == [(2, 1), (3, None)]
    assert rows(op.incremental_scan(df, {"a": 2, "b": 4}, any_of=True)) == [(1, 5), (3, None)]
    assert op.incremental_scan(df, {"a": None}).count() == 3
    assert op.incremental_scan(df, {"a": 2, "b": None}, any_of=True).count() == 3


def test_high_water_mark(spark):
    df = spark.createDataFrame([(1, True), (5, False), (3, True)], "m int, ok boolean")
    assert op.high_water_mark(df, "m").first() == (5, 3)
    assert op.high_water_mark(df, "m", F.col("ok")).first() == (3, 2)
    assert op.high_water_mark(df.limit(0), "m", previous=7).first() == (7, 0)


def test_lookup_and_scalar_key(spark):
    fact = spark.createDataFrame([("a", 1), ("zz", 2), (None, 3)], "name string, n int")
    dim = spark.createDataFrame([("a", 10), ("b", 11)], "name string, key int")
    assert rows(op.lookup_keys(fact, [(dim, "name", "key")])) == [("a", 1, 10)]
    assert op.lookup_keys(fact, [(dim, "name", "key")], how="left").count() == 3
    same = spark.createDataFrame([("x", 7), ("x", 4)], "name string, key int")
    one = spark.range(1)
    assert one.select(op.scalar_key(same, F.col("name") == "x", "key")).first()[0] == 4
    assert one.select(op.scalar_key(same, F.col("name") == "y", "key")).first()[0] is None
    dup = spark.createDataFrame([("a",), ("a",)], "name string")
    assert rows(op.known_keys(fact, dup, "name")) == [("a", 1)]


def test_candle_cursors(spark):
    df = spark.createDataFrame([("ETH/USDT", "1m", 100), ("ETH/USDT", "1m", 200)], "symbol string, interval string, close_time_ms bigint")
    assert rows(op.candle_cursors(df)) == [("ETH_USDT__1m", "ETH/USDT", "1m", 200, 201)]
    assert rows(op.candle_cursors(df, F.lit(150)))[0][3:] == (100, 101)


def test_coerce_datetime_columns(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00", "x", "2024"), ("junk", "y", None)], "run_ts string, note_at string, other string")
    out = op.coerce_datetime_columns(df)
    assert [f.dataType.typeName() for f in out.schema] == ["timestamp_ntz", "string", "string"]
    assert rows(out) == [(None, "y", None), (T0, "x", "2024")] or rows(out) == [(T0, "x", "2024"), (None, "y", None)]
