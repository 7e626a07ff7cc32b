"""Batches of the merged stream: each rewrites its own parts of the table."""

import datetime as dt

import pyarrow.parquet as pq

from chainmart.operators import dedupe, merge_upsert
from chainmart.registry import QUERIES, streams
from chainmart.registry.base import SCHEMAS
from chainmart.registry.merging import CUT, KEYS, ORDER
from chainmart.streaming import upsert, upsert_into


def test_a_batch_rewrites_the_parts_of_its_file(spark, tmp_path, monkeypatch):
    cut = dt.datetime.fromisoformat(CUT)
    lines = [
        # keys come early and late, twice on one side or both, one of them null
        (i % 900 or None, i, 1, i % 3, float(i % 11), 2.0, 0.0, 0.0, "A", "O", cut + dt.timedelta(days=i % 20 - 10))
        for i in range(4000)
    ]
    spark.createDataFrame(lines, SCHEMAS["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    touched, into = [], streams.upsert_into

    def recorded(path, keys, order, partition_by):
        merge = into(path, keys, order, partition_by)

        def batch(rows, batch_id):
            touched.append({r[0] for r in rows.select(partition_by).distinct().collect()})
            merge(rows, batch_id)

        return batch

    monkeypatch.setattr(streams, "upsert_into", recorded)
    monkeypatch.setattr(streams, "PART_ROWS", 1000)
    monkeypatch.setattr(streams, "LEAST_PARTS", 1)
    got = QUERIES["stream_upsert"](spark, str(tmp_path))
    assert len(set().union(*touched)) == 4 and max(map(len, touched)) < 4
    # early and late rows: each part is rewritten once for either
    assert sum(map(len, touched)) <= 8
    rows = spark.read.parquet(str(tmp_path / "lineitem.parquet")).select(got.columns)
    early, late = rows.where(rows.l_shipdate < cut), rows.where(rows.l_shipdate >= cut)
    late = late.selectExpr("*", *[f"{c} AS _by_{c}" for c in ORDER])
    want = merge_upsert(dedupe(early, KEYS, ORDER), late, KEYS, [f"_by_{c}" for c in ORDER])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_a_file_is_one_part_and_has_row_groups_to_read_side_by_side(spark, tmp_path, monkeypatch):
    cut = dt.datetime.fromisoformat(CUT)
    lines = [
        (i, i % 7, 1, i % 3, float(i % 1009), i / 7, i / 11, i / 13, "A", "O", cut + dt.timedelta(days=i % 20 - 10))
        for i in range(12000)
    ]
    spark.createDataFrame(lines, SCHEMAS["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    made, touched, straight, into = [], [], [], streams.upsert_into

    def shared(session, label):
        made.append(str(tmp_path / label))
        return made[-1]

    def recorded(path, keys, order, partition_by):
        merge = into(path, keys, order, partition_by)

        def batch(rows, batch_id):
            touched.append([r[0] for r in rows.select(partition_by).distinct().collect()])
            straight.append(upsert._out_of_files(rows))
            merge(rows, batch_id)

        return batch

    monkeypatch.setattr(streams, "shared_dir", shared)
    monkeypatch.setattr(streams, "upsert_into", recorded)
    monkeypatch.setattr(streams, "PART_ROWS", 2000)
    monkeypatch.setattr(streams, "LEAST_PARTS", 1)
    monkeypatch.setattr(streams, "GROUP_BYTES", 16 << 10)
    got = QUERIES["stream_upsert"](spark, str(tmp_path))
    # six parts, each with one file of early rows and one of late rows
    assert sorted(touched) == sorted([[p] for p in range(6)] * 2) and all(straight)
    files = list((tmp_path / "stream-lines").glob("*.parquet"))
    assert len(files) == 12 and all(pq.ParquetFile(f).metadata.num_row_groups > 1 for f in files)
    assert got.count() == 12000


def part_rows(spark, *rows):
    return spark.createDataFrame(rows, "k int, ord int, v string, part string")


def table(spark, out):
    return sorted(tuple(r) for r in spark.read.parquet(out).select("k", "ord", "v").collect())


def test_merged_files_are_moved_and_other_partitions_not_listed(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "table")
    merge = upsert_into(out, ["k"], ["ord"], "part")
    merge(part_rows(spark, (1, 0, "a", "x/1"), (2, 0, "b", "y=[2]"), (3, 0, "c", "z")), 0)
    written = []
    monkeypatch.setattr(upsert, "write_merged", lambda *a: written.append(a))
    # no table is listed: a partition that is there, one with it that is not, and one alone that is not
    monkeypatch.setattr(upsert, "read_or_none", lambda spark, path: written.append(path))
    merge(part_rows(spark, (1, 1, "A", "x/1"), (1, 0, "no", "x/1")), 1)
    merge(part_rows(spark, (2, 1, "B", "y=[2]"), (4, 0, "d", "new 4")), 2)
    merge(part_rows(spark, (5, 0, "e", "5 %")), 3)
    assert not written
    assert table(spark, out) == [(1, 1, "A"), (2, 1, "B"), (3, 0, "c"), (4, 0, "d"), (5, 0, "e")]


def test_partitions_whose_type_their_folders_do_not_tell(spark, tmp_path):
    out = str(tmp_path / "table")
    merge = upsert_into(out, ["k"], ["ord"], "part")
    merge(part_rows(spark, (1, 0, "a", "1"), (2, 0, "b", "one")), 0)
    # a folder of digits looks like a number by itself
    merge(part_rows(spark, (1, 1, "A", "1")), 1)
    merge(part_rows(spark, (3, 1, "C", "3")), 2)
    assert table(spark, out) == [(1, 1, "A"), (2, 0, "b"), (3, 1, "C")]


def test_a_move_that_was_interrupted_is_taken_up_where_it_stopped(spark, tmp_path):
    out, aside = tmp_path / "table", tmp_path / "table_staged"
    merge = upsert_into(str(out), ["k"], ["ord"], "part")
    first = part_rows(spark, *[(k, 0, "old", p) for k, p in enumerate("aabbcc")])
    merge(first, 0)
    again = part_rows(spark, *[(k, 1, "new", p) for k, p in enumerate("aabbcc")]).repartition(6)
    again.write.partitionBy("part").parquet(str(aside / "rows"))
    (aside / "complete").touch()
    # of a all old files and one new file have moved, of b one old file is gone, c is as it was
    for f in (out / "part=a").iterdir():
        f.unlink()
    moved = sorted((aside / "rows/part=a").glob("part-*.parquet"))
    assert len(moved) > 1
    moved[0].rename(out / "part=a" / moved[0].name)
    sorted((out / "part=b").glob("part-*.parquet"))[0].unlink()
    merge(part_rows(spark, (9, 0, "more", "d")), 1)
    assert table(spark, str(out)) == [(k, 1, "new") for k in range(6)] + [(9, 0, "more")]
    assert not aside.exists()


def test_rows_left_by_an_unfinished_merge_are_not_published(spark, tmp_path):
    out, aside = str(tmp_path / "table"), tmp_path / "table_staged"
    merge = upsert_into(out, ["k"], ["ord"], "part")
    merge(part_rows(spark, (1, 0, "a", "p"), (2, 0, "b", "q")), 0)
    part_rows(spark, (2, 5, "unfinished", "q")).write.partitionBy("part").parquet(str(aside / "rows"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        merge(part_rows(spark, (1, 1, "A", "p")), 1)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert table(spark, out) == [(1, 1, "A"), (2, 0, "b")]


def test_a_merge_by_all_columns_carries_each_row_once(spark):
    rows = lambda *r: spark.createDataFrame(r, "k int, o double, a string, b string")
    target = rows((1, 9.0, "t", "t"), (2, 9.0, "t", None), (None, 9.0, "t", "t"))
    updates = rows((1, 1.0, "x", "x"), (1, 2.0, None, "y"), (1, 2.0, None, None), (3, None, "z", None), (None, 0.0, "u", None))
    want = [(1, 2.0, None, "y"), (2, 9.0, "t", None), (3, None, "z", None), (None, 0.0, "u", None)]
    merge = lambda by: merge_upsert(target, updates, ["k"], by)
    assert sorted(map(tuple, merge(["o", "a", "b"]).collect()), key=str) == sorted(want, key=str)
    plan = lambda by: merge(by)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan(["o", "a", "b"]) and plan(["o", "a", "b"]).count("Exchange hashpartitioning") == 1
    # ties that columns outside the order would tell apart are left to the aggregate, as they were
    assert "SortAggregate" in plan(["o"])
