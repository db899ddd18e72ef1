"""Steps that several queries share: each is made once, and large rows are dealt once."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ledgerlake.operators import holdings, lending
from ledgerlake.plans.feed_queries import payloads
from ledgerlake.plans.posting_queries import posted_funds
from ledgerlake.plans.registry import Bank
from ledgerlake.sources import responses

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_posted_funds_read_written_requests_and_are_dealt_by_folio(spark, no_broadcast):
    text = plan(posted_funds(Bank(spark, SMALL)))
    assert "lineitem" not in text and "Window" in text
    assert not [line for line in text.splitlines() if "hashpartitioning(folio_id" in line and "scheme_code" in line.split("hashpartitioning")[1]]


def test_prices_are_made_once(spark):
    bank = Bank(spark, SMALL)
    posted_funds(bank)
    made = []
    assert bank.once("prices", lambda: made.append(1)) is bank.once("prices", lambda: made.append(1)) and not made


def test_only_asked_month_ends(spark):
    rows = [(1, "2", dt.date(2024, 1, 5), 1, D(3), D(30)), (1, "2", dt.date(2024, 4, 20), 2, D(5), D(50)), (2, "2", dt.date(2024, 2, 1), 3, D(1), D(10))]
    posted = spark.createDataFrame(rows, "folio_id long, scheme_code string, txn_date date, id long, units_held decimal(18,5), invested_amount decimal(18,2)")
    nav = spark.createDataFrame([("2", dt.date(2024, 1, 2), D(7))], "scheme_code string, nav_date date, nav_value decimal(14,5)")
    every = holdings.monthly_holdings(posted, nav, ["txn_date", "id"], dt.date(2024, 4, 25))
    dates = [dt.date(2024, 2, 29), dt.date(2024, 4, 25)]
    some = holdings.monthly_holdings(posted, nav, ["txn_date", "id"], dt.date(2024, 4, 25), dates=dates)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.where(every.snapshot_date.isin(*dates)).collect())) and some.count() == 3 < every.count()


def test_lines_are_dealt_once_for_payloads(spark, no_broadcast):
    text = plan(payloads(Bank(spark, SMALL)))
    # One exchange of lines and one of orders.
    assert text.count("Exchange hashpartitioning(l_orderkey") == 2 and "hashpartitioning(scheme_code" not in text


def test_responses_are_parsed_once(spark):
    bronze = spark.createDataFrame([("r", "mf_scheme", "2", dt.datetime(2024, 1, 1), '{"data":[{"date":"01-01-2024","nav":"1"}]}')], "raw_id string, endpoint string, scheme_code string, fetched_at timestamp, payload string")
    for found in (responses.outcomes(bronze), responses.quarantined_responses(bronze)):
        assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1
    assert responses.price_rows(bronze).select("date", "nav", "pos").collect() == [("01-01-2024", "1", 0)]


def test_instalments_are_not_shuffled(spark, no_broadcast):
    loans = spark.createDataFrame([(1, dt.date(2024, 1, 1), 4, D(10), "active"), (2, dt.date(2024, 1, 1), 2, D(5), "active"), (None, dt.date(2024, 3, 1), 9, D(5), "active")],
                                  "loan_id long, disbursal_date date, tenure_months int, emi_amount decimal(18,2), status string")
    receipts = spark.createDataFrame([(1, dt.date(2024, 1, 31), D(10)), (1, dt.date(2024, 2, 1), D(3)), (1, dt.date(2024, 3, 1), None), (1, dt.date(2024, 3, 31), D(17)), (None, dt.date(2024, 1, 1), D(1))],
                                     "loan_id long, txn_date date, amount decimal(18,2)")
    schedule = lending.due_against_paid(loans, receipts, dt.date(2024, 4, 15))
    assert sorted((r.loan_id or 0, r.instalment_no, r.due_to_date, r.paid_to_date, r.missed, r.is_last) for r in schedule.collect()) == [
        (0, 1, D(5), D(0), True, True), (1, 1, D(10), D(10), False, False), (1, 2, D(20), D(13), True, False), (1, 3, D(30), D(30), False, True),
        (2, 1, D(5), D(0), True, False), (2, 2, D(10), D(0), True, True)]
    lines = plan(lending.delinquency(schedule)).splitlines()
    generate = next(i for i, line in enumerate(lines) if "Generate" in line)
    assert not [line for line in lines[:generate] if "Exchange" in line]
