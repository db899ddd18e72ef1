"""Feed parsing, upserts and the few ways a table changes."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import classify, dates, money, text
from ledgerlake.operators import merge
from ledgerlake.schemas import RESETTABLE, TABLES, empty
from ledgerlake.session import new_folder
from ledgerlake.sources import feed
from ledgerlake.sources.tables import Lake


def test_parse_edges(spark):
    rows = [("1-2-2020", "10"), ("31-02-2020", "1"), ("01-02-20", "1"), (None, None), ("01-01-2020", "NaN"), ("01-01-2020", "1e2"),
            ("01-01-2020", "0.000001"), ("01-01-2020", "-3"), ("01-01-2020", " 5.5 "), ("01-01-2020", "Infinity")]
    df = spark.createDataFrame(rows, "date string, nav string")
    got = [(r[0], r[1]) for r in df.select(text.feed_date(F.col("date")), text.positive_nav(F.col("nav"))).collect()]
    day = dt.date(2020, 1, 1)
    assert got == [(dt.date(2020, 2, 1), D("10.00000")), (None, D(1)), (None, D(1)), (None, None), (day, None), (day, D(100)),
                   (day, None), (day, None), (day, D("5.50000")), (day, None)]


def test_payload_to_silver(spark):
    body = {"meta": {"scheme_code": 7, "scheme_name": "X Directory Fund"}, "status": "SUCCESS",
            "data": [{"date": "02-01-2020", "nav": "1.5"}, {"date": "02-01-2020", "nav": "2.5"}, {"date": "bad", "nav": "1"}]}
    raw = spark.createDataFrame([("7", json.dumps(body), dt.datetime(2020, 1, 3)), ("7", json.dumps({**body, "data": []}), dt.datetime(2020, 1, 2))],
                                "scheme_code string, payload string, fetched_at timestamp_ntz")
    bronze = feed.raw_rows(raw, "mf_scheme")
    assert bronze.select("raw_id").distinct().count() == 2
    checked = feed.checked_prices(feed.parse_raw(feed.latest_raw(bronze)))
    clean = feed.clean_prices(checked, ["fetched_at", "pos"]).collect()
    # The last entry of a date wins by its place in the response, not by its value.
    assert [(r.nav_id, r.nav_value) for r in clean] == [("7:2020-01-02", D("2.50000"))]
    bad = feed.quarantined_prices(checked, ["fetched_at", "pos"]).collect()
    assert [(r.raw_payload, r.reason) for r in bad] == [('{"date":"bad","nav":"1"}', "unparseable nav_date 'bad' for scheme 7")]


def test_scheme_rows_and_quarantine(spark):
    meta = spark.createDataFrame(
        [("1", "A Direct GROWTH", "H", "", "I1"), ("2", "B regular-IDCW", "H", "I2", None), ("3", "Directory", "H", None, None),
         ("4", "", "H", None, None), ("5", "E", None, None, None)],
        "scheme_code string, scheme_name string, fund_house string, isin_growth string, isin_div_reinvestment string")
    got = {r.scheme_code: (r.plan, r.option, r.isin) for r in feed.scheme_rows(meta).collect()}
    assert got == {"1": ("Direct", "Growth", "I1"), "2": ("Regular", "Dividend", "I2"), "3": (None, None, None)}
    assert feed.quarantined_schemes(meta).count() == 2


def test_orphans_and_corrections(spark):
    rows = spark.createDataFrame([("1", dt.date(2020, 1, 1), D(1)), ("9", dt.date(2020, 1, 1), D(1))], "scheme_code string, nav_date date, nav_value decimal(14,5)")
    flagged = feed.orphan_flag(rows, spark.createDataFrame([("1",)], "scheme_code string"))
    assert {r.scheme_code: r.is_orphan for r in flagged.collect()} == {"1": False, "9": True}
    assert "scheme_code 9 not present" in feed.quarantined_orphans(flagged.where("is_orphan")).first().reason
    bad = spark.createDataFrame([("q1", "1", "bad", "5"), ("q2", "1", "01-01-2020", "x")], "quarantine_id string, scheme_code string, date string, nav string")
    at = dt.datetime(2021, 1, 1)
    fixes = spark.createDataFrame([("q1", "date", "02-01-2020", at, "me")],
                                  "quarantine_id string, field_corrected string, new_value string, corrected_at timestamp_ntz, corrected_by string")
    mended, log = feed.apply_corrections(bad, fixes)
    assert {r.quarantine_id: r.problem for r in mended.collect()} == {"q1": None, "q2": "bad_nav"}
    assert [(r.old_value, r.new_value) for r in log.collect()] == [("bad", "02-01-2020")]


NAV = "nav_id string, scheme_code string, nav_date date, nav_value decimal(14,5)"


def nav(spark, *rows):
    return spark.createDataFrame([(f"{c}:{d}", c, dt.date.fromisoformat(d), D(v)) for c, d, v in rows], NAV)


def stored(lake):
    return {(r.scheme_code, str(r.nav_date)): float(r.nav_value) for r in lake.read("fact_mf_nav").collect()}


@pytest.mark.parametrize("keep_existing", [True, False])
def test_merge_touches_only_its_months(spark, keep_existing):
    lake, keys = Lake(spark, new_folder(spark, "test")), ["scheme_code", "nav_date"]
    lake.merge("fact_mf_nav", nav(spark, ("1", "2020-01-01", 1), ("1", "2020-02-01", 2)), keys, keep_existing)
    january = {f for f in lake.read("fact_mf_nav").inputFiles() if "2020-01" in f}
    more = nav(spark, ("1", "2020-02-01", 9), ("1", "2020-02-02", 3))
    for _ in range(2):
        lake.merge("fact_mf_nav", more, keys, keep_existing)
    assert stored(lake) == {("1", "2020-01-01"): 1, ("1", "2020-02-01"): 2 if keep_existing else 9, ("1", "2020-02-02"): 3}
    assert january <= set(lake.read("fact_mf_nav").inputFiles())


def test_delete_reset_and_gate(spark):
    lake = Lake(spark, new_folder(spark, "test"))
    lake.overwrite("mf_folio", spark.createDataFrame([("P4_1",), ("F_1",)], "folio_id string"))
    lake.delete_prefix("mf_folio", "folio_id", "P4_")
    assert [r.folio_id for r in lake.read("mf_folio").collect()] == ["F_1"]
    lake.overwrite("mf_nav_ref", nav(spark, ("1", "2020-01-01", 1)).drop("nav_id"))
    lake.require_rows("mf_folio", "mf_nav_ref")
    lake.reset_derived()
    assert lake.read("mf_folio").isEmpty() and not lake.read("mf_nav_ref").isEmpty()
    with pytest.raises(RuntimeError):
        lake.require_rows("mf_folio")
    assert set(RESETTABLE) <= set(TABLES)
    assert empty(spark, "fact_payment").columns[0] == "payment_id"


def test_reset_then_merge_on_a_month_table(spark):
    lake, keys = Lake(spark, new_folder(spark, "test")), ["txn_id"]
    rows = empty(spark, "fact_deposit_txn")
    full = spark.createDataFrame(
        [(t, "a", dt.datetime(2020, 1, 1), dt.date(2020, 1, 1), D(1), "debit", D(b), "upi", None, None) for t, b in (("t1", 1), ("t1", 5), ("t2", 2))],
        rows.schema)
    for keep_existing in (True, False):
        lake.merge("fact_deposit_txn", full, keys, keep_existing)
        lake.reset_derived()
        assert lake.read("fact_deposit_txn").isEmpty()
        for _ in range(2):
            lake.merge("fact_deposit_txn", full, keys, keep_existing)
        assert {(r.txn_id, int(r.running_balance)) for r in lake.read("fact_deposit_txn").collect()} == {("t1", 5), ("t2", 2)}
        assert lake.read("fact_deposit_txn").count() == 2


def test_incremental(spark):
    facts = nav(spark, ("1", "2020-01-02", 1), ("2", "2020-01-09", 1))
    batch = nav(spark, ("1", "2020-01-01", 4), ("1", "2020-01-02", 7), ("1", "2020-01-03", 1), ("3", "2020-01-01", 1), ("2", "2020-01-09", 1))
    fresh = merge.new_rows(batch, facts, "scheme_code", "nav_date")
    assert {(r.scheme_code, str(r.nav_date)) for r in fresh.collect()} == {("1", "2020-01-03"), ("3", "2020-01-01")}
    late = merge.late_rows(batch, facts, "scheme_code", "nav_date", "nav_value").collect()
    assert {(str(r.nav_date), r.late_kind) for r in late} == {("2020-01-01", "backfilled"), ("2020-01-02", "restated")}
    schemes = spark.createDataFrame([("1",), ("2",), ("4",)], "scheme_code string")
    status = merge.refresh_status(schemes, batch, fresh, "scheme_code").collect()
    assert {r.scheme_code: r.status for r in status} == {"1": "OK", "2": "NO_NEW_ROWS", "4": "FAILED"}


def test_formulas(spark):
    df = spark.createDataFrame([(D(120000), D("12.000"), 12, dt.date(2024, 2, 29))], "p decimal(18,2), r decimal(6,3), n int, d date")
    row = df.select(
        money.level_instalment(F.col("p"), F.col("r"), F.col("n")).alias("emi"),
        money.level_instalment(F.col("p"), F.lit(0).cast("decimal(6,3)"), F.col("n")).alias("flat"),
        dates.add_years(F.col("d"), F.lit(3)).alias("later"), classify.past_due_bucket(F.lit(90)).alias("bucket"),
        classify.risk_stage(F.lit(91)).alias("stage"), classify.wealth_tier(F.lit(1_000_000)).alias("tier"),
        dates.recent_month_ends(F.col("d"), 2).alias("ends"),
    ).first()
    assert (row.emi, row.flat, row.later) == (D("10661.85"), D("10000.00"), dt.date(2027, 2, 28))
    assert (row.bucket, row.stage, row.tier) == ("61-90", 3, "hni")
    assert row.ends == [dt.date(2024, 1, 31), dt.date(2024, 2, 29)]
    assert dates.recent_month_end_dates(dt.date(2024, 3, 15), 3) == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 15)]
