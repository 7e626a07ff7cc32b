import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chainmart.operators import merge_upsert
from chainmart.plans.keyed import KeyedTable

POLICIES = {"kept": "keep_if_null", "born": "set_on_insert"}
SCHEMA = "k int, s string, ord int, plain int, kept int, born int"


def batch(spark, rnd, start, n=120):
    maybe = lambda: rnd.choice([None, rnd.randint(0, 9)])
    # one key holds a third of the updates
    key = lambda: 0 if rnd.random() < 0.33 else rnd.randint(0, 40)
    rows = [(k := key(), f"s{k % 3}", start + at, maybe(), maybe(), maybe()) for at in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, tmp_path, buckets=4):
    return KeyedTable(spark, f"file://{tmp_path}/{uuid.uuid4().hex}", ["k", "s"], buckets)


def above(plan, leaf):
    """Names of the nodes above the line that holds ``leaf``."""
    depth, found = None, []
    for line in reversed(plan.splitlines()):
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is None:
            depth = at if leaf in line else None
        elif at < depth:
            found.append(line[at:])
            depth = at
    return found


@pytest.mark.parametrize("seed, buckets", [(1, 4), (2, 3), (3, 16)])
def test_batches_equal_grouped_merge(spark, tmp_path, seed, buckets):
    rnd, stored, state = random.Random(seed), table(spark, tmp_path, buckets), None
    for n in range(4):
        updates = batch(spark, rnd, 1000 * n)
        stored.merge(updates, ["ord"], POLICIES)
        merged = merge_upsert(state, updates, ["k", "s"], ["ord"], POLICIES)
        state = spark.createDataFrame(merged.collect(), stored.read().schema)
        assert rows(stored.read()) == rows(state)
    before = rows(stored.read())
    stored.merge(updates, ["ord"], POLICIES)
    assert rows(stored.read()) == before


@pytest.mark.parametrize("buckets", [4, 8])
def test_table_is_not_shuffled(spark, tmp_path, buckets):
    stored = table(spark, tmp_path, buckets)
    stored.merge(batch(spark, random.Random(5), 0), ["ord"], POLICIES)
    merged = stored.merged(batch(spark, random.Random(6), 1000), ["ord"], POLICIES)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    over = above(plan, "FileScan parquet")
    assert any("SortMergeJoin" in line for line in over) and "Bucketed: true" in plan
    assert not any("Exchange" in line for line in over), plan


def test_unfinished_merge_is_not_seen(spark, tmp_path, monkeypatch):
    stored = table(spark, tmp_path)
    first, second = batch(spark, random.Random(7), 0), batch(spark, random.Random(8), 1000)
    stored.merge(first, ["ord"], POLICIES)
    before = rows(stored.read())

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("chainmart.plans.keyed.append_rows", lost)
        with pytest.raises(RuntimeError):
            stored.merge(second, ["ord"], POLICIES)
    assert rows(stored.read()) == before
    stored.merge(second, ["ord"], POLICIES)
    assert rows(stored.read()) == rows(merge_upsert(
        spark.createDataFrame(before, stored.read().schema), second, ["k", "s"], ["ord"], POLICIES
    ))


def test_edges(spark, tmp_path):
    stored = table(spark, tmp_path)
    assert stored.read() is None
    empty = spark.createDataFrame([], SCHEMA)
    stored.merge(empty, ["ord"], POLICIES)
    assert stored.read().count() == 0 and stored.read().columns == ["k", "s", "plain", "kept", "born"]
    one = spark.createDataFrame([(1, "a", 0, None, 5, 5), (1, "a", 1, 7, None, 6)], SCHEMA)
    stored.merge(one, ["ord"], POLICIES)
    stored.merge(empty, ["ord"], POLICIES)
    assert rows(stored.read()) == [(1, "a", 7, 5, 5)]
    # a replaced column takes a null, a kept one does not
    stored.merge(one.withColumns({"plain": F.lit(None).cast("int"), "kept": F.lit(None).cast("int")}), ["ord"], POLICIES)
    assert rows(stored.read()) == [(1, "a", None, 5, 5)]
    with pytest.raises(PySparkException, match="null merge key"):
        stored.merge(spark.createDataFrame([(None, "a", 0, 1, 1, 1)], SCHEMA), ["ord"], POLICIES)
    with pytest.raises(ValueError):
        KeyedTable(spark, stored.path, ["k", "s"], 5).read()
