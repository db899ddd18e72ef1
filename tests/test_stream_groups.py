"""The deposit stream's state: many keys a call, no look-ups of new keys, long ids, no state for accounts at rest."""

import datetime as dt
from decimal import Decimal as D

import pandas as pd

from ledgerlake.operators import posting
from ledgerlake.session import new_folder
from ledgerlake.streaming import account_state
from ledgerlake.streaming.account_state import StatefulDepositStream
from ledgerlake.streaming.ledger_stream import REQUESTS
from test_streaming import ACCOUNTS, T0

LONG = (1 << 62) + 1


class Entries(dict):
    """A map state that counts its look-ups."""

    asked = 0

    def getValue(self, key):
        self.asked += 1
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value


def test_one_call_settles_many_keys():
    owners = account_state.KeyOwners()
    owners.owner = Entries()

    def call(*rows):
        made = [(i, False, a, T0 + dt.timedelta(minutes=m), D(1), "credit", "upi", k, 100, True, True, 0) for i, a, m, k in rows]
        return next(owners.handleInputRows((0,), iter([pd.DataFrame(made)]), None))

    found = call((LONG, LONG, 2, "a"), (2, 7, 1, "b"), (3, 8, 3, "a"), (4, 9, 0, None))
    assert found["_reused"].tolist() == [False, False, True, False] and not found["_seen"].any()
    assert dict(owners.owner) == {("a",): (LONG,), ("b",): (7,)} and found["request_id"].tolist()[0] == LONG
    found = call((5, 7, 4, "b"), (6, 7, 5, "a"), (7, 7, 6, "c"))
    assert found["_reused"].tolist() == [False, True, False] and found["_seen"].tolist() == [True, True, False]


def test_balances_ask_only_for_keys_seen_before():
    class Value:
        kept = None

        def get(self):
            return self.kept

        def update(self, value):
            self.kept = value

    balances = account_state.Balances()
    balances.account, balances.keys = Value(), Entries()

    def call(*rows):
        made = [(i, False, 1, T0 + dt.timedelta(minutes=i), D(1), "debit", "upi", k, 100, True, False, seen, 300, 0, False, True) for i, k, seen in rows]
        return next(balances.handleInputRows((1,), iter([pd.DataFrame(made)]), None))["outcome"].tolist()

    assert call((1, "a", False), (2, "b", False)) == ["accepted"] * 2 and balances.keys.asked == 0
    assert call((3, "a", True), (4, "c", False), (5, "d", False)) == ["replayed", "accepted", "rejected"] and balances.keys.asked == 1


def test_long_ids_beside_null_ones(spark, monkeypatch):
    monkeypatch.setattr(account_state, "KEY_GROUPS", 1)
    root = new_folder(spark, "test-groups")
    accounts = spark.createDataFrame([(LONG, "savings", D(100), D(0), None, "active"), (5, "savings", D(1), D(0), None, "active"), (6, "savings", None, D(0), None, "active")], ACCOUNTS)
    rows = [(LONG, LONG, T0, D(60), "debit", "upi", "k1"), (None, LONG, T0 + dt.timedelta(1), D(50), "debit", "upi", "k2"), (3, None, T0, D(1), "credit", "upi", "k3"),
            (LONG + 2, LONG, T0 + dt.timedelta(2), None, "credit", "upi", "k4"), (4, 5, T0, D(1), "credit", "upi", "k5"), (6, 6, T0, D(1), "credit", "upi", "k6")]
    spark.createDataFrame(rows, REQUESTS).coalesce(1).write.parquet(f"{root}/landing")
    StatefulDepositStream(spark, root, accounts).run(f"{root}/landing").awaitTermination()
    found = {(r.request_id, r.account_id): (r.outcome, r.reason_code, r.running_balance) for r in StatefulDepositStream(spark, root, accounts).posted().collect()}
    assert found == {
        (LONG, LONG): ("accepted", None, D("40.00")), (None, LONG): ("rejected", "INSUFFICIENT_BALANCE", None), (3, None): ("rejected", "FK_NOT_FOUND", None),
        (LONG + 2, LONG): ("quarantined", "INVALID_AMOUNT", None), (4, 5): ("accepted", None, D("2.00")), (6, 6): ("accepted", None, D("1.00"))}
    batch = posting.post_deposit_txn(spark.createDataFrame(rows, REQUESTS), accounts).collect()
    assert found == {(r.request_id, r.account_id): (r.outcome, r.reason_code, r.running_balance) for r in batch}
