"""Whole documents, one to a file or many."""

import datetime as dt

from chainmart.registry import QUERIES
from chainmart.sources import RECORD_SEPARATOR, parse_listings, scan_documents


def test_documents_of_one_file_are_rows_of_their_own(spark, tmp_path):
    texts = ['{"page":1,\n "data":[\n1,\n2\n]}', '{"page":2,\n "data":[1', "", '{"page":3,"data":[]}', "[1]"]
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "a.json").write_text("".join(t + RECORD_SEPARATOR for t in texts))
    (tmp_path / "single").mkdir()
    for i, t in enumerate(texts):
        (tmp_path / "single" / f"{i}.json").write_text(t + "\n")
    found = lambda docs: sorted(tuple(r) for r in parse_listings(docs).select("parsed", "n_assets").fillna(-1).collect())
    many = scan_documents(spark, str(tmp_path / "many"), separator=RECORD_SEPARATOR)
    assert [r.value for r in many.collect()] == texts
    assert found(many) == found(scan_documents(spark, str(tmp_path / "single")))
    assert found(many) == [(False, -1), (False, -1), (True, -1), (True, 0), (True, 2)]


def test_files_of_listings_do_not_follow_the_documents(spark, tmp_path):
    start = dt.datetime(2024, 1, 8)
    events = [(i, start + dt.timedelta(minutes=i), i % 7, "purchase", 1.5, '{"k": 3}') for i in range(300)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(str(tmp_path / "events.parquet"))
    listed = QUERIES["scan_listing_documents"](spark, str(tmp_path))
    assert listed.count() == 300
    assert listed.where("parsed AND n_assets = 1").count() == sum((start + dt.timedelta(minutes=i)).minute % 7 != 0 for i in range(300))
    assert len(listed.inputFiles()) < 30
