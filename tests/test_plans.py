"""Physical plans: what is read, and how often rows move."""

from ledgerlake.plans.catalogue import QUERIES
from ledgerlake.plans.feed_queries import prices
from ledgerlake.plans.registry import Bank

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_used_columns(spark):
    scan = prices(Bank(spark, FOLDER))._jdf.queryExecution().sparkPlan().collectLeaves().apply(0)
    assert set(scan.requiredSchema().fieldNames()) == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"}


def test_filter_reaches_the_scan(spark):
    text = plan(Bank(spark, FOLDER).lineitem.where("l_linenumber <= 3").select("l_orderkey"))
    assert "LessThanOrEqual(l_linenumber,3)" in text


def test_posting_walks_rows_once(spark):
    text = plan(QUERIES["post_loan_txn"](spark, FOLDER))
    assert text.count("MapInArrow") == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_amortisation_does_not_shuffle(spark):
    assert "Exchange hash" not in plan(QUERIES["loan_amortization"](spark, FOLDER))
