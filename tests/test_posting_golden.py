"""Hand-computed cases of the five ledgers."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlake.operators import posting

T0 = dt.datetime(2026, 1, 5, 10)
DAY = dt.date(2026, 1, 5)


def deposits(spark, rows):
    return spark.createDataFrame(
        [(i, a, T0 + dt.timedelta(seconds=i), D(amount), kind, "atm", key) for i, (a, amount, kind, key) in enumerate(rows)],
        "request_id bigint, account_id string, txn_datetime timestamp_ntz, amount decimal(18,2), dr_cr string, channel string, idempotency_key string",
    )


def test_deposits(spark):
    accounts = spark.createDataFrame(
        [("A1", "savings", D(1000), D(0), None, "active"), ("A3", "savings", D(1000), D(0), None, "active"),
         ("OD", "overdraft", D(0), D(0), D(500), "active"), ("CL", "savings", D(10), D(0), None, "closed")],
        "account_id string, deposit_type string, current_balance decimal(18,2), min_balance decimal(18,2), overdraft_limit decimal(18,2), status string",
    )
    requests = deposits(spark, [
        ("A1", 100, "debit", "k1"), ("A1", 10000, "debit", "k2"), ("A1", 100, "debit", "k1"),
        ("A3", 600, "debit", "k3"), ("A3", 600, "debit", "k4"),
        ("OD", 500, "debit", None), ("OD", 1, "debit", None), ("CL", 1, "credit", None), ("NO", 1, "credit", None),
        ("A1", 0, "credit", None), ("A3", 5, "credit", "k1"), ("A1", 500, "credit", "k2"),
    ])
    posted = posting.post_deposit_txn(requests, accounts).collect()
    got = {r.request_id: (r.outcome, r.reason_code, r.running_balance) for r in posted}
    assert got == {
        0: ("accepted", None, D("900.00")), 1: ("rejected", "INSUFFICIENT_BALANCE", None), 2: ("replayed", None, None),
        3: ("accepted", None, D("400.00")), 4: ("rejected", "INSUFFICIENT_BALANCE", None),
        5: ("accepted", None, D("-500.00")), 6: ("rejected", "LIMIT_EXCEEDED", None),
        7: ("rejected", "ACCOUNT_CLOSED", None), 8: ("rejected", "FK_NOT_FOUND", None),
        9: ("quarantined", "INVALID_AMOUNT", None), 10: ("quarantined", "KEY_REUSED", None),
        # The key was refused before, so it is tried again and now taken.
        11: ("accepted", None, D("1400.00")),
    }
    ids = {r.request_id: r.txn_id for r in posted}
    assert ids[0] == ids[2]


def test_cards(spark):
    cards = spark.createDataFrame(
        [("C1", D(1000), D(0), "active"), ("C2", D(1000), D(0), "blocked")],
        "card_id string, credit_limit decimal(18,2), current_statement_balance decimal(18,2), status string",
    )
    rows = [("C1", 1500, "purchase", "a"), ("C1", 900, "purchase", "b"), ("C1", 200, "atm", "c"), ("C1", 300, "refund", "d"),
            ("C1", 200, "purchase", "c"), ("C2", 1, "purchase", "e"), ("C9", 1, "purchase", "f"), ("C1", 1500, "purchase", "a")]
    requests = spark.createDataFrame(
        [(i, c, T0 + dt.timedelta(seconds=i), D(a), t, k) for i, (c, a, t, k) in enumerate(rows)],
        "request_id bigint, card_id string, txn_datetime timestamp_ntz, amount decimal(18,2), txn_type string, idempotency_key string",
    )
    got = {r.request_id: (r.txn_status, r.reason_code, r.statement_balance, r.outcome)
           for r in posting.post_card_txn(requests, cards).collect()}
    assert got[0] == ("declined", "LIMIT_EXCEEDED", None, "rejected")
    assert got[1] == ("approved", None, D("900.00"), "accepted")
    assert got[2] == ("declined", "LIMIT_EXCEEDED", None, "rejected")
    assert got[3] == ("approved", None, D("600.00"), "accepted")
    # A declined card transaction is a fact, so its key is taken even though there is room by now.
    assert got[4][3] == "replayed" and got[7][3] == "replayed"
    assert got[5][:2] == ("declined", "ACCOUNT_CLOSED")
    assert got[6][:2] == (None, "FK_NOT_FOUND")


def test_payments(spark):
    accounts = spark.createDataFrame(
        [("D2", "deposit", "active"), ("OD", "deposit", "active"), ("CA", "card", "active"), ("LN", "loan", "active")],
        "account_id string, account_type string, status string",
    )
    savings = spark.createDataFrame(
        [("D2", D(2000), D(100), None, "savings"), ("OD", D(0), D(0), D(50), "overdraft")],
        "account_id string, current_balance decimal(18,2), min_balance decimal(18,2), overdraft_limit decimal(18,2), deposit_type string",
    )
    cards = spark.createDataFrame([("CA", D(100), D(500))], "account_id string, current_statement_balance decimal(18,2), credit_limit decimal(18,2)")
    rows = [("D2", 5000), ("D2", 1900), ("D2", 1), ("OD", 51), ("OD", 50), ("CA", 401), ("CA", 400), ("LN", 1), ("XX", 1)]
    requests = spark.createDataFrame(
        [(i, a, T0 + dt.timedelta(seconds=i), D(v), "upi") for i, (a, v) in enumerate(rows)],
        "request_id bigint, from_account_id string, payment_datetime timestamp_ntz, amount decimal(18,2), rail string",
    )
    sources = posting.payment_sources(accounts, savings, cards)
    got = {r.request_id: (r.reason_code, r.balance_after) for r in posting.post_payment(requests, sources).collect()}
    assert got == {
        0: ("INSUFFICIENT_BALANCE", None), 1: (None, D("100.00")), 2: ("INSUFFICIENT_BALANCE", None),
        3: ("INSUFFICIENT_BALANCE", None), 4: (None, D("-50.00")), 5: ("LIMIT_EXCEEDED", None), 6: (None, D("500.00")),
        7: ("ACCOUNT_CLOSED", None), 8: ("FK_NOT_FOUND", None),
    }


def test_loans(spark):
    loans = spark.createDataFrame(
        [("L1", D(5000), "active"), ("L2", D(100), "written_off")], "loan_id string, outstanding_principal decimal(18,2), status string"
    )
    rows = [("L1", 6000, "prepayment", 6000), ("L1", 5000, "disbursal", 0), ("L1", 300, "emi", 250), ("L1", 4800, "emi", 4751),
            ("L1", 4750, "prepayment", 4750), ("L2", 1, "emi", 1), ("L3", 1, "emi", 1)]
    requests = spark.createDataFrame(
        [(i, a, DAY, D(v), t, D(p)) for i, (a, v, t, p) in enumerate(rows)],
        "request_id bigint, loan_id string, txn_date date, amount decimal(18,2), txn_type string, principal_paid decimal(18,2)",
    )
    got = {r.request_id: (r.reason_code, r.outstanding_after) for r in posting.post_loan_txn(requests, loans).collect()}
    assert got == {
        0: ("INSUFFICIENT_BALANCE", None), 1: (None, D("5000.00")), 2: (None, D("4750.00")), 3: ("LIMIT_EXCEEDED", None),
        4: (None, D("0.00")), 5: ("ACCOUNT_CLOSED", None), 6: ("FK_NOT_FOUND", None),
    }


def test_funds(spark):
    folios = spark.createDataFrame([("F1", "active"), ("F2", "closed")], "folio_id string, status string")
    nav = spark.createDataFrame([("S", dt.date(2026, 1, 1), D(10)), ("S", dt.date(2026, 1, 2), D(20))],
                                "scheme_code string, nav_date date, nav_value decimal(14,5)")
    one, two, never = dt.date(2026, 1, 1), dt.date(2026, 1, 2), dt.date(2099, 1, 1)
    rows = [("F1", "redemption", one, 100, "a"), ("F1", "purchase", never, 100, "b"), ("F1", "purchase", one, 500, "c"),
            ("F1", "redemption", two, 800, "d"), ("F1", "dividend", two, 20, "e"), ("F1", "switch_out", two, 240, "f"),
            ("F2", "purchase", one, 1, "g"), ("F3", "purchase", one, 1, "h"), ("F1", "purchase", one, 500, "c")]
    requests = spark.createDataFrame(
        [(i, f, "S", t, DAY, d, D(a), k) for i, (f, t, d, a, k) in enumerate(rows)],
        "request_id bigint, folio_id string, scheme_code string, txn_type string, txn_date date, nav_date date, amount decimal(18,2), idempotency_key string",
    )
    posted = posting.post_mf_transaction(requests, folios, nav)
    got = {r.request_id: (r.outcome, r.reason_code, r.units_held, r.invested_amount, r.market_value) for r in posted.collect()}
    assert got[0][:2] == ("rejected", "UNITS_EXCEEDED")
    assert got[1][:2] == ("rejected", "NAV_NOT_FOUND")
    assert got[2] == ("accepted", None, D("50.00000"), D("500.00"), D("500.00"))
    # 40 units for 800: more than was ever invested, so the invested sum stops at zero.
    assert got[3] == ("accepted", None, D("10.00000"), D("0.00"), D("200.00"))
    assert got[4] == ("accepted", None, D("11.00000"), D("20.00"), D("220.00"))
    assert got[5][:2] == ("rejected", "UNITS_EXCEEDED")
    assert got[6][:2] == ("rejected", "ACCOUNT_CLOSED") and got[7][:2] == ("rejected", "FK_NOT_FOUND")
    assert got[8][:2] == ("replayed", None)
    held = posting.current_holdings(posted, ["txn_date", "request_id"]).collect()
    assert [(r.units_held, r.invested_amount) for r in held] == [(D("11.00000"), D("20.00"))]


def test_rejection_log(spark):
    accounts = spark.createDataFrame(
        [("A1", "savings", D(10), D(0), None, "active")],
        "account_id string, deposit_type string, current_balance decimal(18,2), min_balance decimal(18,2), overdraft_limit decimal(18,2), status string",
    )
    posted = posting.post_deposit_txn(deposits(spark, [("A1", 11, "debit", "k1"), ("A1", 5, "debit", "k2"), ("A1", 0, "debit", "k3")]), accounts)
    log = posting.rejection_log(posted, posting.DEPOSIT, "txn_datetime").collect()
    assert [(r.source_table, r.reason_code, r.idempotency_key) for r in log] == [("fact_deposit_txn", "INSUFFICIENT_BALANCE", "k1")]
    counts = posting.rejection_counts(posting.rejection_log(posted, posting.DEPOSIT, "txn_datetime"))
    assert counts.select(F.sum("n_rejected")).first()[0] == 1


def test_two_state_rows_do_not_double_requests(spark):
    accounts = spark.createDataFrame(
        [("A1", "savings", D(10), D(0), None, "active"), ("A1", "savings", D(20), D(0), None, "active")],
        "account_id string, deposit_type string, current_balance decimal(18,2), min_balance decimal(18,2), overdraft_limit decimal(18,2), status string",
    )
    posted = posting.post_deposit_txn(deposits(spark, [("A1", 11, "debit", "k1"), ("A1", 5, "debit", "k2")]), accounts).collect()
    assert sorted(r.running_balance for r in posted) == [D("4.00"), D("9.00")]
