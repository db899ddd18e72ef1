"""Hot keys whose every range falls short: settled in parallel, with the answers of the plain walk."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from brute import post_deposits
from ledgerlake.operators import posting, settlement
from test_posting_skew import answers, frames, make

START = dt.datetime(2024, 1, 1)


def watch(monkeypatch):
    """What settlement did: (rounds, were any keys streamed, ranges)."""
    seen, real = {"rounds": 0}, (settlement._tried, settlement._rooms)

    def tried(group, schema):
        seen["rounds"] += 1
        return real[0](group, schema)

    def rooms(after, walked, keys, order):
        found = real[1](after, walked, keys, order)
        seen.update(ranges=walked.count(), streamed=found[2] is not None, settled=found[0].count())
        return found

    monkeypatch.setattr(settlement, "_tried", tried)
    monkeypatch.setattr(settlement, "_rooms", rooms)
    return seen


@pytest.mark.parametrize("repeats", [0.0, 0.5])
def test_every_range_falls_short(spark, monkeypatch, repeats):
    requests, accounts = make(11, 900, repeats, hot_share=0.9)
    accounts[1] |= {"deposit_type": "savings", "current_balance": D(90), "min_balance": D(0), "overdraft_limit": None}
    seen = watch(monkeypatch)
    got = answers(posting.post_deposit_txn(*frames(spark, requests, accounts), max_rows=80))
    want = post_deposits(requests, accounts)
    assert got == want
    refused = [r["request_id"] for r in requests if r["account_id"] == 1 and want[r["request_id"]][0] == "rejected"]
    assert len(refused) > 80 and seen["ranges"] >= 8
    assert not seen["streamed"] and seen["settled"] == seen["ranges"] and seen["rounds"] <= settlement.ROUNDS


def test_keys_that_do_not_fit_in_time_are_streamed(spark, monkeypatch):
    monkeypatch.setattr(settlement, "ROUNDS", 1)
    requests, accounts = make(12, 300, 0.4, hot_share=0.8)
    accounts[1] |= {"deposit_type": "savings", "current_balance": D(50), "min_balance": D(0), "overdraft_limit": None}
    seen = watch(monkeypatch)
    assert answers(posting.post_deposit_txn(*frames(spark, requests, accounts), max_rows=40)) == post_deposits(requests, accounts)
    assert seen["streamed"]


def test_one_moment_is_cut_too(spark):
    """All requests of a batch at the same time: ranges do not hang on hours or days."""
    requests, accounts = make(13, 300, 0.0, hot_share=1.0)
    for r in requests:
        r["txn_datetime"] = START
    assert answers(posting.post_deposit_txn(*frames(spark, requests, accounts), max_rows=50)) == post_deposits(requests, accounts)


def test_pieces():
    """A walk's piece is exactly the rooms with the same decisions, against every room tried one by one."""
    import numpy as np

    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.randint(1, 9), rng.random() < 0.6) for _ in range(rng.randint(1, 12))]
        need = np.array([a if debit else 0 for a, debit in rows])
        move = np.array([-a if debit else a for a, debit in rows])
        limited = np.array([debit for _, debit in rows])

        def walk(room):
            account = settlement.Account(room)
            codes, rooms = np.zeros(len(rows), int), np.zeros(len(rows), int)
            account.take(np.ones(len(rows), bool), need, limited, move, [None] * len(rows), np.zeros(len(rows), bool), codes, rooms)
            return account, codes.tolist()

        for room in range(0, 70, 7):
            account, codes = walk(room)
            alike = [x for x in range(0, 120) if walk(x)[1] == codes]
            low, high = max(0, room - account.down), min(119, room + account.up)
            assert (low, high) == (min(alike), max(alike)) and len(alike) == high - low + 1
            assert account.room - account.start == walk(low)[0].room - low


def test_other_ledgers(spark):
    rng = random.Random(21)
    at = [START + dt.timedelta(minutes=rng.randint(0, 300)) for _ in range(260)]
    key = [f"k{i if rng.random() < 0.7 else i // 3}" for i in range(260)]
    who = [1 if rng.random() < 0.7 else rng.randint(2, 5) for _ in range(260)]

    def same(run, frame, *tables, **kw):
        plain = {r[0]: tuple(r) for r in run(frame, *tables, **kw).collect()}
        assert {r[0]: tuple(r) for r in run(frame, *tables, **kw, max_rows=40).collect()} == plain
        return plain.values()

    money = "amount decimal(18,2), idempotency_key string"
    cards = spark.createDataFrame([(i, D(300), D(10), "active") for i in range(1, 5)], "card_id long, credit_limit decimal(18,2), current_statement_balance decimal(18,2), status string")
    frame = spark.createDataFrame([(i, who[i], at[i], rng.choice(["purchase", "purchase", "atm", "refund"]), "pos", D(rng.randint(1, 120)), key[i]) for i in range(260)],
                                  f"request_id long, card_id long, txn_datetime timestamp_ntz, txn_type string, entry_mode string, {money}")
    assert any("declined" in r for r in same(posting.post_card_txn, frame, cards))

    sources = spark.createDataFrame([(i, "deposit", D(400), D(5), None, "savings", None, "active") for i in range(1, 4)] + [(4, "card", D(0), None, None, None, D(90), "active")],
                                    "account_id long, account_type string, balance decimal(18,2), min_balance decimal(18,2), overdraft_limit decimal(18,2), "
                                    "deposit_type string, credit_limit decimal(18,2), status string")
    frame = spark.createDataFrame([(i, who[i], at[i], "upi", "upi", D(rng.randint(1, 40)), key[i]) for i in range(260)],
                                  f"request_id long, from_account_id long, payment_datetime timestamp_ntz, rail string, beneficiary_type string, {money}")
    assert any("INSUFFICIENT_BALANCE" in r for r in same(posting.post_payment, frame, sources))

    loans = spark.createDataFrame([(i, D(900), "active") for i in range(1, 5)], "loan_id long, outstanding_principal decimal(18,2), status string")
    frame = spark.createDataFrame([(i, who[i], at[i].date(), rng.choice(["emi", "prepayment"]), D(rng.randint(1, 60)), D(rng.randint(1, 30)), key[i]) for i in range(260)],
                                  f"request_id long, loan_id long, txn_date date, txn_type string, amount decimal(18,2), principal_paid decimal(18,2), idempotency_key string")
    assert any("LIMIT_EXCEEDED" in r or "INSUFFICIENT_BALANCE" in r for r in same(posting.post_loan_txn, frame, loans))
