"""Posting against brute force, with hot keys cut into slots and with repeated idempotency keys."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from brute import post_deposits
from ledgerlake.operators import posting

REQUEST = ("request_id bigint, account_id bigint, txn_datetime timestamp_ntz, amount decimal(18,2), dr_cr string, "
           "channel string, idempotency_key string")
ACCOUNT = ("account_id bigint, deposit_type string, current_balance decimal(18,2), min_balance decimal(18,2), "
           "overdraft_limit decimal(18,2), status string")
START = dt.datetime(2024, 1, 1)


def make(seed: int, n: int, repeats: float, hot_share: float = 0.5):
    rng = random.Random(seed)
    accounts = {}
    for a in range(1, 9):
        kind = rng.choice(["savings", "overdraft", "checking"])
        accounts[a] = {
            "account_id": a, "deposit_type": kind, "current_balance": Decimal(rng.randint(0, 300)),
            "min_balance": Decimal(rng.choice([0, 50])), "overdraft_limit": Decimal(200) if kind == "overdraft" else None,
            "status": "closed" if a == 8 else "active",
        }
    requests = []
    for i in range(n):
        account = 1 if rng.random() < hot_share else rng.randint(1, 10)
        key = f"k{i}"
        if requests and rng.random() < repeats:
            key = rng.choice(requests)["idempotency_key"]
        elif rng.random() < 0.05:
            key = None
        if requests and key is not None and rng.random() < 0.9:
            same = [r for r in requests[-40:] if r["idempotency_key"] == key]
            account = same[0]["account_id"] if same else account
        requests.append({
            "request_id": i, "account_id": None if account == 10 else account, "txn_datetime": START + dt.timedelta(minutes=rng.randint(0, 60 * 12)),
            "amount": Decimal(rng.choice([0, 5, 20, 60, 150, 400])) if rng.random() < 0.02 else Decimal(rng.randint(1, 200)),
            "dr_cr": rng.choice(["debit", "debit", "credit"]), "channel": "upi", "idempotency_key": key,
        })
    return requests, accounts


def frames(spark, requests, accounts):
    return (
        spark.createDataFrame([tuple(r.values()) for r in requests], REQUEST),
        spark.createDataFrame([tuple(a.values()) for a in accounts.values()], ACCOUNT),
    )


def answers(posted):
    return {r.request_id: (r.outcome, r.reason_code, r.running_balance)
            for r in posted.select("request_id", "outcome", "reason_code", "running_balance").collect()}


@pytest.mark.parametrize("seed,repeats", [(1, 0.0), (2, 0.3), (3, 0.6)])
def test_plain_path_equals_brute_force(spark, seed, repeats):
    requests, accounts = make(seed, 400, repeats)
    got = answers(posting.post_deposit_txn(*frames(spark, requests, accounts)))
    assert got == post_deposits(requests, accounts)


@pytest.mark.parametrize("seed,repeats", [(4, 0.0), (5, 0.3)])
def test_hot_keys_in_slots_equal_brute_force(spark, seed, repeats):
    requests, accounts = make(seed, 200, repeats, hot_share=0.6)
    got = answers(posting.post_deposit_txn(*frames(spark, requests, accounts), max_rows=60))
    assert got == post_deposits(requests, accounts)


def test_two_batches_equal_one(spark):
    requests, accounts = make(6, 300, 0.0)
    requests.sort(key=lambda r: (r["txn_datetime"], r["request_id"]))
    for i, r in enumerate(requests):
        r["request_id"] = i
    whole = post_deposits(requests, accounts)
    first, second = requests[:140], requests[140:]
    posted = answers(posting.post_deposit_txn(*frames(spark, first, accounts)))
    later = {a: dict(v) for a, v in accounts.items()}
    for r in first:
        if posted[r["request_id"]][0] == "accepted":
            later[r["account_id"]]["current_balance"] = posted[r["request_id"]][2]
    posted.update(answers(posting.post_deposit_txn(*frames(spark, second, later))))
    assert posted == whole


def test_posting_twice_adds_nothing(spark):
    requests, accounts = make(7, 200, 0.0)
    for r in requests:
        r["idempotency_key"] = f"own{r['request_id']}"
    req, acc = frames(spark, requests, accounts)
    first = posting.post_deposit_txn(req, acc)
    history = posting.accepted(first).select("account_id", "idempotency_key", "txn_id")
    again = posting.post_deposit_txn(req, acc, history=history).select("request_id", "outcome", "txn_id").collect()
    before = {r.request_id: r for r in first.select("request_id", "outcome", "txn_id").collect()}
    for row in again:
        if before[row.request_id].outcome == "accepted":
            assert (row.outcome, row.txn_id) == ("replayed", before[row.request_id].txn_id)


def test_reconciliation_holds(spark):
    requests, accounts = make(8, 300, 0.2)
    req, acc = frames(spark, requests, accounts)
    sums = posting.reconcile_deposits(posting.post_deposit_txn(req, acc), acc)
    assert sums.where("not reconciled").count() == 0
    assert sums.count() == len(accounts)


def test_hot_fund_holdings_equal_plain(spark):
    rng = random.Random(9)
    day = dt.date(2024, 1, 1)
    rows = []
    for i in range(240):
        folio = "F1" if rng.random() < 0.5 else f"F{rng.randint(2, 6)}"
        at = day + dt.timedelta(days=rng.randint(0, 9))
        kind = rng.choice(["purchase", "sip", "redemption", "redemption", "switch_out", "dividend"])
        rows.append((i, folio, rng.choice("ST") if folio != "F1" else "S", kind, at, at, Decimal(rng.randint(1, 900)), f"k{i if rng.random() < 0.8 else i // 2}"))
    requests = spark.createDataFrame(rows, "request_id bigint, folio_id string, scheme_code string, txn_type string, txn_date date, "
                                     "nav_date date, amount decimal(18,2), idempotency_key string")
    folios = spark.createDataFrame([(f"F{i}", "active") for i in range(1, 6)], "folio_id string, status string")
    nav = spark.createDataFrame([(s, day + dt.timedelta(days=d), Decimal(10 + d)) for s in "ST" for d in range(10) if d != 4],
                                "scheme_code string, nav_date date, nav_value decimal(14,5)")
    holdings = spark.createDataFrame([("F1", "S", Decimal(100), Decimal(50))],
                                     "folio_id string, scheme_code string, units_held decimal(18,5), invested_amount decimal(18,2)")

    def run(**kw):
        posted = posting.post_mf_transaction(requests, folios, nav, holdings, **kw)
        return {r.request_id: tuple(r) for r in posted.collect()}

    plain = run()
    held, paid = {("F1", "S"): Decimal(100)}, {("F1", "S"): Decimal(50)}
    by_id = {r[0]: r for r in rows}
    for i in sorted(plain, key=lambda i: (by_id[i][4], i)):
        row = dict(zip(["outcome", "held", "paid"], [plain[i][9], plain[i][13], plain[i][14]]))
        key = by_id[i][1], by_id[i][2]
        if row["outcome"] == "accepted":
            sell = by_id[i][3] in ("redemption", "switch_out")
            sign = -1 if sell else 1
            held[key] = held.get(key, Decimal(0)) + sign * plain[i][12]
            paid[key] = max(Decimal(0), paid.get(key, Decimal(0)) + sign * by_id[i][6])
            assert (row["held"], row["paid"]) == (held[key], paid[key])
    assert run(max_rows=50) == plain
