import random

import pytest

from chainmart.streaming import dedupe_into, run_once

SCHEMA = "k int, s string, at int, v int"


def rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).drop("source", "batch").collect()), key=str)


def first_of_each(batches):
    seen = {}
    for batch in batches:
        for row in sorted(batch, key=lambda r: r[2]):
            seen.setdefault(row[:2], row)
    return sorted(seen.values(), key=str)


def make(seed, n=5, size=60):
    rnd = random.Random(seed)
    key = lambda: (0, "hot") if rnd.random() < 0.33 else (rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b"]))
    return [[(*key(), i, rnd.randint(0, 9)) for i in rnd.sample(range(1000), size)] for _ in range(n)]


@pytest.mark.parametrize("small_batches", [True, False])
def test_batches_against_brute_force(spark, tmp_path, small_batches):
    batches, out = make(1), str(tmp_path / "out")
    append = dedupe_into(out, ["k", "s"], ["at"], "one")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20) if small_batches else "-1")
    try:
        for n, batch in enumerate(batches):
            append(spark.createDataFrame(batch, SCHEMA).repartition(3), n)
            assert rows(spark, out) == first_of_each(batches[: n + 1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a batch that is repeated, the last or the first, leaves the table as it was
    before = rows(spark, out)
    for n in (len(batches) - 1, 0):
        append(spark.createDataFrame(batches[n], SCHEMA), n)
        assert rows(spark, out) == before
    # another stream under its own name begins at 0 again
    dedupe_into(out, ["k", "s"], ["at"], "two")(spark.createDataFrame([(-1, "n", 1, 1), *batches[0]], SCHEMA), 0)
    assert rows(spark, out) == sorted([*before, (-1, "n", 1, 1)], key=str)


def test_edges(spark, tmp_path):
    out = str(tmp_path / "out")
    append = dedupe_into(out, ["k", "s"], ["at"], "one")
    append(spark.createDataFrame([], SCHEMA), 0)
    append(spark.createDataFrame([(None, None, 2, 1), (None, None, 1, 2)], SCHEMA), 1)
    append(spark.createDataFrame([(None, None, 0, 3)], SCHEMA), 2)
    assert rows(spark, out) == [(None, None, 1, 2)]
    with pytest.raises(ValueError):
        append(spark.createDataFrame([(1, 1)], "k int, batch int"), 3)


def test_stream_keeps_no_state(spark, tmp_path):
    batches = make(2, n=3)
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = run_once(stream.writeStream.foreachBatch(dedupe_into(out, ["k", "s"], ["at"], "one")), str(tmp_path / "marks"))
    assert all(not p["stateOperators"] for p in query.recentProgress)
    assert {r[:2] for r in rows(spark, out)} == {r[:2] for batch in batches for r in batch}
    assert len(rows(spark, out)) == len({r[:2] for batch in batches for r in batch})
