"""Every registered query: same answer as its SQL, and a plan that can grow."""

import contextlib
import io
import re

import pytest
from oracle import DATA, compare, connect

from __spark_entry__ import entry
from chainmart.registry import ORACLES, QUERIES

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def explain(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    seen = []

    def run(session, sf_dir):
        df = QUERIES[name](session, sf_dir)
        seen.append(df)
        return df

    ok, note = compare(spark, con, name, run, ORACLES[name], SF)
    assert ok, note
    plan = explain(seen[0])
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{node} in the plan of {name}"


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "bucket_ts" and df.count() > 0


def scans(plan, table):
    """ReadSchema and PushedFilters of each scan of a table."""
    found = re.findall(rf"Location: InMemoryFileIndex \[file:[^\]]*{table}[^\]]*\]\n(.*?)\n\n", plan, re.S)
    assert found, plan
    return found


def test_top_assets_limits_before_it_ranks(spark):
    plan = explain(QUERIES["top_assets"](spark, SF), "simple")
    assert "TakeOrderedAndProject" in plan
    assert plan.index("Window") < plan.index("TakeOrderedAndProject")


def test_flagship_reads_narrowly_and_filters_in_the_scan(spark):
    plan = explain(QUERIES["integrated_buckets"](spark, SF))
    found = scans(plan, "events")
    assert all("EqualTo(event_type" in scan for scan in found)
    # blocks need three of the six columns
    assert any("ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in scan for scan in found)


def test_asof_reads_its_inputs_once(spark):
    df = QUERIES["integrated_buckets"](spark, SF)
    df.collect()
    final = explain(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_dedupe_prunes_before_the_shuffle(spark):
    plan = explain(QUERIES["dedupe_last_wins"](spark, SF), "simple")
    assert plan.count("WindowGroupLimit") == 2


def test_incremental_scan_reaches_the_parquet_scan(spark):
    plan = explain(QUERIES["incremental_scan_by_mark"](spark, SF))
    assert "GreaterThan(l_shipdate" in plan


def test_merge_shuffles_the_stacked_rows_once(spark):
    from chainmart.operators import merge_upsert
    from chainmart.registry import base as b

    lines = b.table(spark, SF, "lineitem").select("l_orderkey", "l_linenumber", "l_tax")
    updates = lines.withColumnRenamed("l_tax", "l_tax").selectExpr("*", "l_tax as ord")
    plan = explain(merge_upsert(lines, updates, ["l_orderkey", "l_linenumber"], ["ord"]), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan
