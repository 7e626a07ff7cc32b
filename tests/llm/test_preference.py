"""Registered preference pairs against DuckDB on odd rows, and prompts that are not empty."""

import duckdb
import pandas as pd

from chainmart.llm import preference

SF = "/root/testdata/sf0.001"
ROWS = [
    *[(c, t, r, f"{r} {c} {t}") for c in (0, 1, 19) for t, r in enumerate(("system", "user", "assistant", "user", "assistant"))],
    (20, 0, "user", "nobody answers"),
    (21, 0, "user", "the only answer of these twenty"), (21, 1, "assistant", "yes"),
    (40, 0, "user", "same"), (40, 1, "assistant", "same answer"), (41, 0, "user", "other"), (41, 1, "assistant", "same answer"),
    (60, 0, "assistant", None), (61, 0, "assistant", ""), (61, None, "user", "no number"),
    (62, 1, None, "no role"), (62, 2, "assistant", "b"), (62, 2, "assistant", "a"), (62, 2, None, "smaller"), (62, 3, "assistant", "z"),
    (62, 3, "assistant", "z"), (62, 4, "user", None), (-3, 0, "assistant", "below"), (-1, 0, "assistant", "zero"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "x"), (80, 0, "assistant", ""),
]


def test_odd_rows_against_sql(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = preference.op7_preference_pairs(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(preference.ORACLE).df()[list(got.columns)]
    order = lambda x: x.astype({"pair": "float64", "n_prompt": "int64"}).sort_values("pair").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want))
    by_pair = {None if pd.isna(r.pair) else int(r.pair): r for r in got.itertuples()}
    assert set(by_pair) == {r[0] for r in ROWS}
    assert by_pair[0].n_prompt == 4 and by_pair[0].rejected == preference.OPEN + "assistant|>\nassistant 1 4\n"
    assert by_pair[19].rejected.endswith("assistant 0 4\n") and by_pair[0].chosen_mask == "1"
    assert by_pair[21].rejected == "<|assistant|>\n\n" and by_pair[40].chosen == by_pair[20].rejected == ""


def test_prompts_are_shared(spark):
    rows = preference.op7_preference_pairs(spark, SF).collect()
    ids = spark.read.parquet(f"{SF}/conversations.parquet").where("turn IS NOT NULL").select("conv_id").distinct().count()
    assert len(rows) == ids and sum(r.n_prompt > 0 for r in rows) > 0.9 * ids
    assert sum(r.chosen != r.rejected for r in rows) > 0.5 * ids  # the rest has no answer, or the same
    nothing = preference.with_other_answers(spark.read.parquet(f"{SF}/conversations.parquet").limit(0))
    assert preference.preference_pairs(nothing).count() == 0
