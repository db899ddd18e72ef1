"""Running values: plain windows and the slot path for hot keys give what a loop gives."""

import random

from pyspark.sql import functions as F

from ledgerlake.operators import ordered
from ledgerlake.operators.asof import asof_join, asof_times, value_on_dates


def rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, None, None, 2, 3]), rng.randint(0, 30), i, rng.randint(-9, 9), rng.choice([None, rng.randint(1, 99)])) for i in range(n)]


def loops(data):
    """id -> running sum, running last, sum before, floored sum, strict time."""
    out = {}
    for key in {r[0] for r in data}:
        total, last, floored, strict = 0, None, 0, None
        for t, i, v, maybe in sorted((r[1:] for r in data if r[0] == key), key=lambda r: r[:2]):
            before = total if strict is not None else None
            total += v
            last = maybe if maybe is not None else last
            floored = max(0, floored + v)
            strict = t if strict is None else max(t, strict + 1)
            out[i] = (total, last, before, floored, strict)
    return out


def plan(df, hot):
    keys, order, slot = ["k"], ["t", "i"], lambda: F.floor(F.col("t") / 5)
    df = ordered.running(df, keys, order, {
        "total": ordered.Running("sum", "v"), "seen": ordered.Running("last", "maybe"),
        "before": ordered.Running("sum", "v", before=True),
    }, slot, hot)
    df = ordered.floored_sum(df, keys, order, "v", "floored", slot, hot)
    df = ordered.strictly_increasing(df, keys, order, "t", "strict", slot, hot)
    return {r.i: (r.total, r.seen, r.before, r.floored, r.strict) for r in df.collect()}


def test_running_values_with_and_without_hot_keys(spark):
    data = rows(1, 300)
    df = spark.createDataFrame(data, "k bigint, t bigint, i bigint, v bigint, maybe bigint")
    want = loops(data)
    assert ordered.hot_keys(df, ["k"]) is None
    assert plan(df, None) == want
    hot = ordered.hot_keys(df, ["k"], max_rows=100)
    assert [r.k for r in hot.collect()] == [None]
    assert plan(df, hot) == want


def test_asof_joins(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 1, 3), ("b", 9, 4)], "k string, d int, i int")
    series = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 7, 70)], "k string, sd int, v int")
    got = {r.i: (r.sd, r.v) for r in asof_join(left, series, ["k"], "d", "sd", ["v"]).collect()}
    assert got == {1: (5, 50), 2: (5, 50), 3: (None, None), 4: (None, None)}
    for hot in (None, ordered.hot_keys(left, ["k"], max_rows=2)):
        timed = asof_times(left, series, ["k"], ["d", "i"], ["sd"], ["v"], lambda: F.floor(F.col("_at") / 2), hot)
        assert {r.i: r.v for r in timed.collect()} == {1: 50, 2: 50, 3: None, 4: None}


def test_value_on_dates_defaults_to_zero(spark):
    ledger = spark.createDataFrame([(1, 3, 1, 10), (1, 3, 2, 11), (1, 8, 3, 12)], "k int, d int, i int, v int")
    got = {(r.k, r.as_of): r.v for r in value_on_dates(ledger, ["k"], "d", ["d", "i"], "v", [2, 3, 9]).collect()}
    assert got == {(1, 2): 0, (1, 3): 11, (1, 9): 12}


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 4, "y"), (2, 1, "z")], "k int, t int, v string")
    assert sorted(map(tuple, ordered.latest_per_key(df, ["k"], ["t"]).collect())) == [(1, 4, "y"), (2, 1, "z")]
