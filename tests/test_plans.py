"""Properties the plans must keep whatever the size of the data."""

import pytest

from rollbook.plans.queries import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))
PARSING = {
    "page_rows", "page_attr", "page_cells", "page_atomic", "page_profile", "page_envelope",
    "page_error_log", "listing_profile", "raw_page_rows", "raw_page_errors", "lateral_rows",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_python_only_for_parsing(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("EvalPython" in text) == (name in PARSING)
    assert text.count("ArrowEvalPython") <= 1


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["outcome_classify"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text
    text = plan(QUERIES["admit_big"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>" in text


def test_sweep_and_scalars_do_not_shuffle(spark, sf_dir):
    for name in ("status_sweep", "eligible_filter", "scheme_url", "probe_route", "kind_lookup", "seed_frontier"):
        assert "Exchange" not in plan(QUERIES[name](spark, sf_dir))


def test_dispatch_order_can_cut_through_a_level(spark, sf_dir):
    assert "rangepartitioning(status" in plan(QUERIES["dispatch_list"](spark, sf_dir))
    assert "_id" in plan(QUERIES["dispatch_list"](spark, sf_dir)).split("rangepartitioning(")[1].split(")")[0]


def test_eligibility_reaches_the_scan(spark, sf_dir, tmp_path):
    from rollbook.operators.ingest import scan_eligible
    from rollbook.plans import standins

    standins.pool(spark, sf_dir).write.parquet(f"{tmp_path}/pool")
    text = plan(scan_eligible(spark.read.parquet(f"{tmp_path}/pool")).select("_id"))
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(anonymous,A)" in pushed and "StringStartsWith(anonymous,W)" in pushed


def test_pages_are_parsed_in_the_scans_own_splits(spark, sf_dir):
    assert "Exchange" not in plan(QUERIES["page_rows"](spark, sf_dir))
