import random

import pytest
from pyspark.sql import functions as F

from chainmart.operators import dedupe, insert_if_absent, merge_documents, merge_upsert

POLICIES = {"kept": "keep_if_null", "born": "set_on_insert"}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def simulate(target, updates):
    """Apply updates one by one, as separate statements would."""
    state = {k: [r, c, b] for k, r, c, b in target}
    for k, _, r, c, b in sorted(updates, key=lambda u: u[1]):
        if k in state:
            old = state[k]
            state[k] = [r, c if c is not None else old[1], old[2]]
        else:
            state[k] = [r, c, b]
    return sorted(((k, *v) for k, v in state.items()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixed_policies_equal_sequential_statements(spark, seed):
    rnd = random.Random(seed)
    maybe = lambda: rnd.choice([None, rnd.randint(0, 9)])
    target = [(k, maybe(), maybe(), maybe()) for k in range(6)]
    # key 0 receives a third of everything
    updates = [(rnd.choice([0, *range(10)]) if rnd.random() < 0.7 else 0, o, maybe(), maybe(), maybe()) for o in range(90)]
    rnd.shuffle(updates)
    t = spark.createDataFrame(target, "k int, plain int, kept int, born int")
    u = spark.createDataFrame(updates, "k int, ord int, plain int, kept int, born int").repartition(7)
    merged = merge_upsert(t, u, ["k"], ["ord"], POLICIES)
    assert merged.columns == t.columns
    assert rows(merged) == simulate(target, updates)
    # replaying the same batch changes nothing
    again = merge_upsert(merged, u, ["k"], ["ord"], {**POLICIES})
    assert rows(again.select("k", "plain", "born")) == rows(merged.select("k", "plain", "born"))


def test_merge_in_two_batches_equals_one(spark):
    rnd = random.Random(7)
    updates = [(rnd.randint(0, 4), o, rnd.choice([None, o]), rnd.choice([None, o]), o) for o in range(40)]
    schema = "k int, ord int, plain int, kept int, born int"
    first, second = [u for u in updates if u[1] < 20], [u for u in updates if u[1] >= 20]
    once = merge_upsert(None, spark.createDataFrame(updates, schema), ["k"], ["ord"], POLICIES)
    step = merge_upsert(None, spark.createDataFrame(first, schema), ["k"], ["ord"], POLICIES)
    step = merge_upsert(step, spark.createDataFrame(second, schema), ["k"], ["ord"], POLICIES)
    assert rows(once) == rows(step)


def test_replace_takes_null(spark):
    t = spark.createDataFrame([(1, 5)], "k int, v int")
    u = spark.createDataFrame([(1, 0, None)], "k int, ord int, v int")
    assert rows(merge_upsert(t, u, ["k"], ["ord"])) == [(1, None)]


def test_unknown_policy_is_refused(spark):
    t = spark.createDataFrame([(1, 5)], "k int, v int")
    with pytest.raises(ValueError):
        merge_upsert(t, t.withColumn("ord", F.lit(1)), ["k"], ["ord"], {"v": "sometimes"})


def test_insert_if_absent(spark):
    t = spark.createDataFrame([(1, "old")], "k int, v string")
    u = spark.createDataFrame([(1, 0, "new"), (2, 2, "second"), (2, 1, "first")], "k int, ord int, v string")
    assert rows(insert_if_absent(t, u, ["k"], ["ord"])) == [(1, "old"), (2, "first")]


def test_dedupe_first_and_last(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "k int, ord int, v string")
    assert rows(dedupe(df, ["k"], ["ord"])) == [(1, 3, "c"), (2, 1, None)]
    assert rows(dedupe(df, ["k"], ["ord"], keep="first")) == [(1, 1, "a"), (2, 1, None)]


def test_document_merge_tells_missing_from_null(spark):
    schema = "k int, ord int, a int, b int, stamp string, fields_present array<string>"
    docs = spark.createDataFrame(
        [
            (1, 1, 10, 20, "first", ["a", "b"]),
            (1, 2, None, None, "second", ["a"]),  # a: null overwrites, b: absent, stays
            (2, 1, 5, None, "only", ["a"]),
        ],
        schema,
    )
    merged = merge_documents(None, docs, ["k"], ["ord"], ["a", "b"], ["stamp"])
    assert rows(merged) == [(1, None, 20, "first", ["a", "b"]), (2, 5, None, "only", ["a"])]
    late = spark.createDataFrame([(1, 3, 7, None, "third", ["a", "b"]), (2, 3, None, 8, "x", ["b"])], schema)
    again = merge_documents(merged, late, ["k"], ["ord"], ["a", "b"], ["stamp"])
    assert rows(again) == [(1, 7, None, "first", ["a", "b"]), (2, 5, 8, "only", ["a", "b"])]
