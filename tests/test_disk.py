"""Queries over whole ledgers leave no copy of them behind, and one pass over the rows says what two joined passes said."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.proof import proof
from ledgerlake.plans.catalogue import QUERIES
from ledgerlake.plans.registry import Bank
from ledgerlake.session import shared_root, swept

SMALL = "/root/testdata/sf0.001"


def kept(spark) -> int:
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(shared_root(spark)) for f in files)


@pytest.mark.parametrize("name", ["rule_proof_report", "ledger_reconciliation", "table_row_counts", "customer_coverage_matrix"])
def test_ledgers_leave_nothing_behind(spark, name):
    before = kept(spark)
    rows = QUERIES[name](spark, SMALL)
    assert kept(spark) - before < 300_000
    assert rows.count() == {"rule_proof_report": 51, "ledger_reconciliation": 5, "table_row_counts": 17, "customer_coverage_matrix": 150}[name]


def test_frames_of_a_query_go_when_they_are_done(spark):
    bank = Bank(spark, SMALL)
    rows = bank.once("test rows", lambda: spark.range(50_000).withColumn("x", F.xxhash64("id")))
    assert rows.count() == 50_000
    before = kept(spark)
    bank.done("test rows", "never made")
    assert before - kept(spark) > 300_000
    assert bank.once("test rows", lambda: spark.range(3)).count() == 3


def test_swept_gives_the_setting_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), swept(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == before


def test_proof_of_keys_that_repeat_or_are_missing(spark):
    # Key, fault, score: a score over 900 is caught. Faults and catches meet by key, each with each.
    rows = [("a", "score", 901), ("a", "score", 901), ("a", None, 901), ("b", "score", 500), ("b", None, 901), ("c", "score", 500),
            (None, "score", 901), (None, None, 902), ("d", None, 903), ("e", None, 500)]
    faulty = spark.createDataFrame(rows, "_key string, _fault string, score int")
    faults = [k for k, f, _ in rows if f]
    caught = [k for k, _, s in rows if s > 900]
    pairs = sum(1 for k in faults for c in caught if k is not None and k == c)
    missed = sum(1 for k in faults if k is None or k not in caught)
    others = sum(1 for c in caught if c is None or c not in faults)
    assert [tuple(r) for r in proof({"credit_bureau_score": faulty}).collect()] == [("credit_bureau_score", "score", pairs + missed, pairs, missed, others)]
