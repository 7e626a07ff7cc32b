"""Cases that only size or odd column names bring about."""

from collections import Counter

import pytest

import corpus_pipeline
from chainmart.llm import decontaminate, sharding, simhash

SF = "/root/testdata/sf0.001"
#: names that operators use or return themselves
NAMES = ("kept", "base_failed", "_q", "row", "own", "_row", "_score", "score", "_stratum", "stratum", "_symbol_share",
         "key", "fp", "n_words", "n_hit", "component_id")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_shard_of_a_short_last_row(spark):
    """Sizes far apart: the middle of the last row lies just below the end of the line."""
    for last, first in ((16, 9_999_999_984), (250, 10**11), (1, 10**15)):
        df = spark.createDataFrame([(1, first, "a"), (2, last, "b")], "k long, size long, _start string")
        got = {r.k: (r.shard, r.slot, r._start) for r in sharding.balanced_shards(df, "k", "size", 40).collect()}
        assert got == {1: (19, 0, "a"), 2: (39, 0, "b")}


def test_shards_stay_in_range(spark):
    df = spark.range(1, 400).selectExpr("id", "id * id * 1000003 % 99991 + 1 as size", "1 as shard_of", "id as _nth")
    out = sharding.balanced_shards(df, "id", "size", 40)
    assert out.columns == [*df.columns, "shard", "slot"]
    rows = sorted(map(tuple, out.collect()))
    total, at = sum(r[1] for r in rows), 0
    slots = Counter()
    for n, size, _, nth, shard, slot in rows:
        assert nth == n and shard == (2 * at + size) * 40 // (2 * total) and slot == slots[shard]
        slots[shard] += 1
        at += size


def test_decontamination_in_parts_drops_the_same(spark):
    """A benchmark that goes in several parts, over many partitions, names the same rows as one that goes at once."""
    docs, bench = table(spark, "documents").repartition(7), table(spark, "benchmark")
    bad = {r.doc_id for r in decontaminate.contamination(docs, bench).where("n_hit > 0").collect()}
    assert bad
    for key in ("doc_id", "_row", "row"):
        rows = docs.withColumnRenamed("doc_id", key)
        out = decontaminate.contamination(rows, bench, key, max_sent=4000)
        assert out.columns[0] == key and {r[0] for r in out.where("n_hit > 0").collect()} == bad
    sent, decontaminate.contamination.__defaults__ = decontaminate.contamination.__defaults__, (
        *decontaminate.contamination.__defaults__[:-1], 4000)
    try:
        left = decontaminate.drop_contaminated(docs.withColumnRenamed("lang", "row"), bench).collect()
    finally:
        decontaminate.contamination.__defaults__ = sent
    assert {r.doc_id for r in left} == {r.doc_id for r in docs.collect()} - bad


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_stages_carry_columns_of_any_name(spark, name, stage):
    docs = table(spark, "documents")
    extra = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in NAMES])
    plain, out = stage(spark, docs, SF), stage(spark, extra, SF)
    assert out.columns == extra.columns
    rows = out.collect()
    assert Counter(tuple(r)[: len(docs.columns)] for r in rows) == Counter(map(tuple, plain.collect()))
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)


def test_simhash_blocks_are_the_same_at_every_size():
    """Whatever bits differ, up to the distance, two fingerprints agree on as many blocks as a key has."""
    n, distance = 4 + simhash.MATCHED, 4
    cut = [simhash.BITS * i // n for i in range(n + 1)]
    for start in range(64):
        bits = {(start + 16 * i) % 64 for i in range(distance)}
        assert sum(not any(a <= b < c for b in bits) for a, c in zip(cut, cut[1:])) >= simhash.MATCHED
