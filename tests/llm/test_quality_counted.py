"""The pipeline's quality stage: texts are counted once, and labels meet counts and not texts."""

from chainmart.llm import quality


def test_labels_do_not_move_texts(spark, monkeypatch):
    good = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(i % 40 or None, good if i % 3 else "too short", "en") for i in range(60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    seen, counts, cutoffs = [], [], quality.cutoffs
    with_counts = quality.with_counts
    monkeypatch.setattr(quality, "with_counts", lambda *a: (counts.append(a), with_counts(*a))[1])
    monkeypatch.setattr(quality, "cutoffs", lambda counted, *a: (seen.append(counted), cutoffs(counted, *a))[1])
    kept = quality.keep_good(docs, labels)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("text <> 'too short'").collect()))
    assert len(counts) == 1 and "text" not in seen[0].columns
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
