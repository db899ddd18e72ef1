"""Control totals, change log, one-pass references, proof of rules, and finalised statuses on hand-made rows."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.money import cents
from ledgerlake.operators import changes, merge, posting, quality
from ledgerlake.operators.proof import proof, with_faults
from ledgerlake.operators.reconcile import control_totals
from ledgerlake.operators.rules import REFERENCES, RULES
from ledgerlake.plans.catalogue import QUERIES
from ledgerlake.session import new_folder
from ledgerlake.sources.tables import Lake
from test_posting_skew import frames, make


def totals(requests, posted, accounts):
    amount = cents(F.col("amount"))
    return control_totals(
        "deposit", requests, posted, [F.col("account_id"), F.col("request_id"), amount], accounts.select("account_id", cents(F.col("current_balance")).alias("value")),
        ["account_id"], ["txn_datetime", "request_id"], F.when(F.col("dr_cr") == "debit", -amount).otherwise(amount), cents(F.col("running_balance"))).first()


def test_control_totals_tie_and_catch(spark):
    requests, accounts = frames(spark, *make(51, 200, 0.3))
    posted = posting.post_deposit_txn(requests, accounts)
    whole = totals(requests, posted, accounts)
    assert whole.requests_tie and whole.balances_tie and whole.n_requests == 200 and whole.n_keys_off == 0
    lost = totals(requests, posted.where("request_id <> 17"), accounts)
    assert not lost.requests_tie
    # One row in place of another: the number is right, the checksum is not.
    swapped = posted.withColumn("amount", F.when(F.col("request_id") == 3, F.col("amount") + 1).otherwise(F.col("amount")))
    assert not totals(requests, swapped, accounts).requests_tie
    off = posted.withColumn("running_balance", F.col("running_balance") + F.when(F.col("account_id") == 2, 1).otherwise(0))
    assert totals(requests, off, accounts).n_keys_off == 1 and not totals(requests, off, accounts).balances_tie
    empty = totals(requests.limit(0), posted.limit(0), accounts)
    assert empty.requests_tie and empty.balances_tie and empty.checksum_requests == "0"


def test_change_log_in_any_order(spark):
    keys, values = ["scheme_code", "nav_date"], ["nav_value"]
    rng = random.Random(8)
    day = dt.date(2024, 1, 1)

    def version():
        return {("s", day + dt.timedelta(days=40 * rng.randint(0, 5))): D(rng.randint(1, 4)) for _ in range(rng.randint(0, 6))}

    states = [{}] + [version() for _ in range(5)]
    table = lambda state: spark.createDataFrame([(*k, v) for k, v in state.items()], "scheme_code string, nav_date date, nav_value decimal(14,5)")
    logs = [changes.capture(table(a), table(b), keys, values, n + 1) for n, (a, b) in enumerate(zip(states, states[1:]))]
    for log, a, b in zip(logs, states, states[1:]):
        found = {(r.scheme_code, r.nav_date): (r.op, r.before and r.before.nav_value, r.after and r.after.nav_value) for r in log.collect()}
        assert found == {k: ("insert" if k not in a else "delete" if k not in b else "update", a.get(k), b.get(k)) for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 1, 3], [0, 0, 3, 1, 4, 2, 2]):
        copy = changes.Copy(Lake(spark, new_folder(spark, "test-copy")), "mf_nav_copy", keys, values)
        for at in order:
            copy.apply(logs[at])
        assert {(r.scheme_code, r.nav_date): r.nav_value for r in copy.rows().collect()} == states[-1]


def test_references_in_one_grouping(spark):
    folder = "/root/testdata/sf0.001"
    report = QUERIES["dq_orphans"](spark, folder)
    text = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert report.count() == len(REFERENCES) == 15
    assert text.count("Exchange hashpartitioning") <= 3  # (reference, value), reference, and the list of names
    cards = spark.createDataFrame([("a", "c1"), ("x", "c1"), (None, "c2"), ("x", None)], "account_id string, customer_id string")
    accounts = spark.createDataFrame([("a", "c1"), ("a", "c9")], "account_id string, customer_id string")
    rows = {r.reference.split(" ")[0]: (r.n_rows, r.n_orphans) for r in quality.orphan_report({"card_master": cards, "dim_account": accounts, "dim_customer": accounts}).collect()}
    assert rows == {"dim_account(customer_id)": (2, 0), "card_master(account_id)": (3, 2), "card_master(customer_id)": (3, 1)}


def test_proof_matches_by_key(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("_key"), F.col("id").alias("_pick"), (F.col("id") + 400).cast("int").alias("score"))
    faulty = with_faults(rows, "credit_bureau_score", {"score": {"score": "901"}})
    assert [tuple(r)[1:] for r in proof({"credit_bureau_score": faulty}).collect()] == [("score", 7, 7, 0, 0)]
    # As many caught as injected, but others: a count would not tell.
    moved = faulty.withColumn("score", F.when(F.col("_pick") % 31 == 0, 400).when(F.col("_pick") % 31 == 1, 901).otherwise(F.col("score")))
    assert [tuple(r)[1:] for r in proof({"credit_bureau_score": moved}).collect()] == [("score", 7, 0, 7, 7)]


def test_all_rules_are_proved(spark):
    report = QUERIES["rule_proof_report"](spark, "/root/testdata/sf0.001").collect()
    assert len(report) == sum(len(r) for r in RULES.values()) == 51
    assert all(r.n_missed == 0 and r.n_caught == r.n_injected for r in report) and sum(r.n_injected > 0 for r in report) > 40
    assert not [r for r in report if r.n_others and r.table_name not in ("loan_account", "card_master", "deposit_account")]


def test_finalize(spark):
    rows = spark.createDataFrame([("a", "active", None), ("b", "active", None)], "account_id string, status string, close_date date")
    new = spark.createDataFrame([("b", "active", None), ("b", "closed", dt.date(2024, 1, 1)), ("c", "closed", None)], "account_id string, status string, close_date date")
    assert sorted(map(tuple, merge.finalize(rows, new, "account_id").collect())) == [("a", "active", None), ("b", "closed", dt.date(2024, 1, 1))]


@pytest.mark.parametrize("name", ["mf_holding_snapshot"])
def test_prices_are_cleaned_once(spark, name):
    text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in text
