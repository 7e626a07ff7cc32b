import os

from pyspark.sql import functions as F

from chainmart.plans import cleanup
from chainmart.plans.cleanup import FileManifest


def read(spark, path):
    return spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("file_path"))


def outcome(df):
    row = df.first()
    return row["attempted"], row["deleted"]


def test_files_are_deleted_once_recorded(spark, tmp_path, write_lines, monkeypatch):
    monkeypatch.setattr(cleanup, "AT_ONCE", 2)
    paths = [write_lines(f"in/{name}", *lines) for name, lines in
             {"a.txt": "xy", "b c%d.txt": "x", "é.txt": "xyz", "d.txt": "x", "gone.txt": "x"}.items()]
    manifest = FileManifest(spark, str(tmp_path / "manifest"))
    assert outcome(manifest.clean_up(0, delete=True)) == (0, 0)
    manifest.record(read(spark, str(tmp_path / "in")), 1)
    late = write_lines("in/late.txt", "x")
    os.remove(paths[-1])
    assert outcome(manifest.clean_up(1)) == (5, 0) and os.path.exists(paths[0])
    # a file that is gone counts as deleted, one that was never recorded stays
    assert outcome(manifest.clean_up(2, delete=True)) == (5, 5)
    assert [os.path.exists(p) for p in paths] == [False] * 5 and os.path.exists(late)
    assert outcome(manifest.clean_up(3, delete=True)) == (0, 0)
    assert manifest.consumed().agg(F.sum("n_rows")).first()[0] == 8


def test_a_file_that_cannot_be_deleted_stays_pending(spark, tmp_path, write_lines, monkeypatch):
    good, bad = write_lines("in/good.txt", "x"), write_lines("in/bad.txt", "x")
    manifest = FileManifest(spark, str(tmp_path / "manifest"))
    manifest.record(read(spark, str(tmp_path / "in")), 1)
    with monkeypatch.context() as m:
        plain = manifest._delete
        m.setattr(manifest, "_delete", lambda f: "bad" not in f and plain(f))
        assert outcome(manifest.clean_up(1, delete=True)) == (2, 1)
    assert (os.path.exists(good), os.path.exists(bad)) == (False, True)
    assert manifest.pending().count() == 1
    assert outcome(manifest.clean_up(2, delete=True)) == (1, 1) and not os.path.exists(bad)
