"""Plan-shape guards for scale: no cross products, partial aggregation before
shuffles, pushdown and pruning into the Parquet scans."""

import pytest

from voxtide.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


#: Jobs of many steps: their last plan only reads what the steps wrote.
STEPWISE = {"corpus_summary", "summary_report", "search_indexed", "bodies_joined", "summary_chunks", "timeline_create", "sentiment_pct_merged", "annotate_failures"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STEPWISE))
def test_no_cross_products(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_n_limits_before_shuffle(spark):
    p = _plan(spark, "top_n_per_channel")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_shares_aggregate_partially_and_prune_text(spark):
    p = _plan(spark, "sentiment_pct_by_channel")
    assert "partial_count" in p
    scan = [line for line in p.split("\n") if "FileScan parquet" in line and "documents" in line][0]
    assert "text" not in scan.split("ReadSchema")[1]


def test_latest_entry_combines_map_side(spark):
    assert "partial_max_by" in _plan(spark, "timeline_latest")


def test_ticket_scan_pushes_type(spark):
    p = _plan(spark, "ticket_scan")
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,ticket)]" in p


def test_rules_need_no_shuffle_and_one_scan(spark):
    p = _plan(spark, "annotate_rules")
    assert "Exchange" not in p and p.count("FileScan parquet") == 1 and p.count("MapInArrow") == 1


def test_dimension_joins_are_broadcast(spark):
    p = _plan(spark, "tickets")
    # four tag lookups + channel config: all broadcast from exact-size local relations
    assert p.count("LocalTableScan") >= 4 and p.count("BroadcastHashJoin") >= 5
