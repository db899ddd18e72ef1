"""Restart, replay and late rows of the deposit stream; exact idempotency; settling late requests."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from brute import post_deposits
from ledgerlake.operators import late, posting
from ledgerlake.session import new_folder
from ledgerlake.streaming import key_index
from ledgerlake.streaming.account_state import StatefulDepositStream
from ledgerlake.streaming.ledger_stream import REQUESTS
from test_posting_skew import answers, frames, make

T0 = dt.datetime(2026, 1, 5, 10)
ACCOUNTS = "account_id bigint, deposit_type string, current_balance decimal(18,2), min_balance decimal(18,2), overdraft_limit decimal(18,2), status string"


def test_deposit_stream(spark):
    root = new_folder(spark, "test-stream")
    accounts = spark.createDataFrame([(1, "savings", D(100), D(0), None, "active"), (2, "savings", D(5), D(0), None, "closed"), (3, "overdraft", D(5), D(0), D(20), "active")], ACCOUNTS)
    progress = []

    def land(*rows):
        made = [(i, a, T0 + dt.timedelta(minutes=m), None if n is None else D(n), kind, "upi", key) for i, a, m, n, kind, key in rows]
        spark.createDataFrame(made, REQUESTS).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        # A new object each time: only what is stored goes on.
        query = StatefulDepositStream(spark, root, accounts).run(f"{root}/landing")
        query.awaitTermination()
        progress.append(query.lastProgress)

    def outcomes():
        return {r.request_id: (r.outcome, r.reason_code, r.running_balance) for r in StatefulDepositStream(spark, root, accounts).posted().collect()}

    land((1, 1, 0, 60, "debit", "k1"), (2, 1, 10, 60, "debit", "k2"), (7, 3, 0, 30, "debit", "k7"), (8, 2, 0, 1, "credit", "k8"), (9, 9, 0, 1, "credit", "k9"), (10, None, 0, 1, "credit", None))
    first = {1: ("accepted", None, D("40.00")), 2: ("rejected", "INSUFFICIENT_BALANCE", None), 7: ("rejected", "LIMIT_EXCEEDED", None),
             8: ("rejected", "ACCOUNT_CLOSED", None), 9: ("rejected", "FK_NOT_FOUND", None), 10: ("rejected", "FK_NOT_FOUND", None)}
    assert outcomes() == first
    # A replay of k1, a request from before the last posting, the refused k2 again after money came in, k1 on another account.
    land((3, 1, 20, 60, "debit", "k1"), (4, 1, -5, 1, "debit", "k4"), (5, 1, 30, 50, "credit", "k5"), (6, 1, 40, 60, "debit", "k2"),
         (11, 3, 5, 1, "credit", "k1"), (12, 3, 6, 0, "credit", "k12"), (13, 3, 7, 2, "swap", "k13"), (14, 3, 8, None, "credit", None))
    second = {3: ("replayed", None, None), 4: ("late", None, None), 5: ("accepted", None, D("90.00")), 6: ("accepted", None, D("30.00")),
              11: ("quarantined", "KEY_REUSED", None), 12: ("quarantined", "INVALID_AMOUNT", None), 13: ("quarantined", "INVALID_VALUE", None), 14: ("quarantined", "INVALID_AMOUNT", None)}
    assert outcomes() == {**first, **second}
    land((15, 1, 50, 30, "debit", "k2"), (16, 1, 51, 30, "debit", "k16"))
    assert outcomes() == {**first, **second, 15: ("replayed", None, None), 16: ("accepted", None, D("0.00"))}
    # A batch reads what has landed since the one before and nothing else: one source, its own rows.
    assert [p["numInputRows"] for p in progress] == [6, 8, 2] and all(len(p["sources"]) == 1 for p in progress)
    assert {r.request_id for r in StatefulDepositStream(spark, root, accounts).late().collect()} == {4}


def test_stream_of_ordered_landings_equals_one_batch(spark):
    requests, accounts = make(31, 240, 0.3)
    requests.sort(key=lambda r: (r["txn_datetime"], r["request_id"]))
    for i, r in enumerate(requests):
        r["request_id"] = i
    root = new_folder(spark, "test-thirds")
    request_frame, account_frame = frames(spark, requests, accounts)
    stream = StatefulDepositStream(spark, root, account_frame)
    for low in range(0, 240, 80):
        request_frame.where(f"request_id >= {low} and request_id < {low + 80}").write.mode("append").parquet(f"{root}/landing")
        stream.run(f"{root}/landing").awaitTermination()
    assert answers(stream.posted()) == post_deposits(requests, accounts)


def test_runs_cover_all_batches():
    for n in range(1, 200):
        at = 0
        for a, b in key_index.runs(n):
            assert a == at and b > a
            at = b
        assert at == n and len(key_index.runs(n)) <= 3 * 5


def test_unbounded_dedupe_reads_few_buckets(spark):
    rng = random.Random(5)
    root = new_folder(spark, "test-keys")
    schema = spark.createDataFrame([], "id long, at int, k string, v string").schema
    dedupe = key_index.UnboundedDedupe(spark, root, schema, ["k"], ["at", "id"], buckets=16, words=64)
    seen, want, n = {}, set(), 0
    for batch in range(6):
        rows = []
        for _ in range(30):
            n += 1
            key = None if rng.random() < 0.05 else f"new{n}"
            rows.append((n, rng.randint(0, 99), key, "x"))
        if batch == 3:
            rows += [(1000 + i, 5, k, "again") for i, k in enumerate(list(seen)[:2])] * 2
        for row in sorted(rows, key=lambda r: (r[1], r[0])):
            if row[2] is None or row[2] not in seen:
                want.add(row)
                if row[2] is not None:
                    seen[row[2]] = row
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/landing")
        dedupe.run(f"{root}/landing").awaitTermination()
    got = [tuple(r) for r in dedupe.kept().select("id", "at", "k", "v").collect()]
    assert set(got) == want and len(got) == len(want)
    assert max(dedupe.log.values()) <= 4 and dedupe.log[0] == 0
    # A batch that runs again changes nothing.
    again = spark.createDataFrame(rows, schema)
    dedupe.take_in(again, 5)
    assert {tuple(r) for r in dedupe.kept().select("id", "at", "k", "v").collect()} == want


@pytest.mark.parametrize("seed", [41, 42])
def test_late_requests_as_if_in_time(spark, seed):
    requests, accounts = make(seed, 300, 0.3)
    rng = random.Random(seed)
    for r in requests:
        r["txn_datetime"] += dt.timedelta(days=rng.randint(0, 150))
    behind = {r["request_id"] for r in requests if rng.random() < 0.08}
    frame, account_frame = frames(spark, requests, accounts)
    is_late = frame["request_id"].isin(sorted(behind))
    posted = posting.post_deposit_txn(frame.where(~is_late), account_frame)
    redone = late.resettle(posted, frame.where(is_late), account_frame)
    assert answers(late.replaced(posted, redone)) == post_deposits(requests, accounts)
    # Accounts without a late request or a key in common keep their rows.
    assert redone.count() < len(requests)
