"""The stream settles a landing set by set, as it would row by row, and reads the state of its own keys only."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlake.session import new_folder
from ledgerlake.streaming.account_state import StatefulDepositStream
from ledgerlake.streaming.ledger_stream import REQUESTS
from ledgerlake.streaming.state_table import StateTable
from test_streaming import ACCOUNTS, T0


def test_sets_and_rows_end_alike(spark):
    accounts = spark.createDataFrame([(1, "savings", D(100), D(0), None, "active"), (2, "overdraft", D(5), D(0), D(20), "active"), (3, "savings", D(9), D(0), None, "closed")], ACCOUNTS)
    at = lambda m: None if m is None else T0 + dt.timedelta(minutes=m)
    # Equal rows twice, a key on two accounts, a refused key again, missing ids, times, keys, amounts and accounts; then late ones and replays.
    landings = [
        [(1, 1, 0, 60, "debit", "a"), (1, 1, 0, 60, "debit", "a"), (2, 1, 1, 60, "debit", "b"), (3, 2, 0, 1, "credit", "a"), (4, 1, 2, 30, "credit", "c"), (5, 1, 3, 60, "debit", "b"),
         (None, 1, 3, 1, "debit", None), (6, None, 0, 1, "credit", "d"), (7, 3, 0, 1, "credit", "e"), (8, 2, 5, 0, "credit", "f"), (9, 2, 6, 25, "debit", "g"), (10, 2, 7, 90, "debit", "h")],
        [(11, 1, 4, 60, "debit", "b"), (12, 1, -3, 1, "credit", "i"), (13, 2, 8, 90, "credit", "h"), (14, 1, 9, 1, "credit", "i"), (15, 1, 10, 1, "swap", "k"), (16, 1, None, 2, "credit", "l"),
         (17, 2, 9, 3, "credit", "l"), (18, 1, 11, None, "credit", "m"), (19, 2, 9, 1, "debit", "a")],
    ]
    found = []
    for way in ("run", "run_by_row"):
        root = new_folder(spark, f"test-{way.replace('_', '-')}")
        for landing in landings:
            rows = [(i, a, at(m), None if n is None else D(n), kind, "upi", key) for i, a, m, n, kind, key in landing]
            spark.createDataFrame(rows, REQUESTS).coalesce(1).write.mode("append").parquet(f"{root}/landing")
            getattr(StatefulDepositStream(spark, root, accounts), way)(f"{root}/landing").awaitTermination()
        posted = spark.read.parquet(f"{root}/posted").drop("batch_id")
        found.append(sorted(map(str, posted.select(sorted(posted.columns)).collect())))
    assert found[0] == found[1] and len(found[0]) == 21
    assert sum("outcome='late'" in r for r in found[0]) == 1 and sum("KEY_REUSED" in r for r in found[0]) >= 3


def test_state_reads_the_buckets_of_its_keys(spark):
    state = StateTable(spark, new_folder(spark, "test-state"), "k string, n bigint, top bigint", {"n": F.sum, "top": F.max}, buckets=8)
    for batch in range(5):
        state.put(spark.createDataFrame([(k, 1, batch if k == "a" else None) for k in ("a", "b", f"own{batch}")], "k string, n bigint, top bigint"), batch)
    # A batch that runs again changes nothing.
    state.put(spark.createDataFrame([("a", 1, 4), ("b", 1, None), ("own4", 1, None)], "k string, n bigint, top bigint"), 4)
    keys = spark.createDataFrame([("a",), ("none",)], "k string")
    assert {tuple(r) for r in state.known(keys, 5).where("k = 'a'").collect()} == {("a", 5, 4)} and len(state.read) <= 2
    assert state.known(keys, 3).where("k = 'a'").first().n == 3 and state.known(keys, 0).count() == 0
