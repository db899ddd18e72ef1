"""Responses that are broken, empty or very long; full load and refresh as whole runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.session import new_folder
from ledgerlake.sources import feed, responses
from ledgerlake.sources.load import FundLoad
from ledgerlake.sources.tables import Lake

AT = dt.datetime(2024, 5, 1)
RAW = "scheme_code string, payload string, fetched_at timestamp_ntz"


def body(code, entries, **meta):
    told = {"scheme_code": code, "scheme_name": f"Fund {code} Direct Growth", "fund_house": "House", **meta}
    return json.dumps({"meta": told, "data": [{"date": d, "nav": n} for d, n in entries], "status": "SUCCESS"})


def bronze(spark, *rows):
    return feed.raw_rows(spark.createDataFrame([(c, p, AT) for c, p in rows], RAW), "mf_scheme")


GOOD = body("1", [("01-01-2024", "10.5"), ("02-01-2024", "N.A."), ("xx", "1")])
ODD = {
    "none": None, "blank": "", "cut": GOOD[:-3], "list": "[1, 2]", "text": '"hello"', "number": "17", "null": "null", "no data": '{"meta": {}}',
    "null data": '{"meta": {}, "data": null}', "empty": '{"meta": {"scheme_code": "9"}, "data": []}', "wrong data": '{"meta": {}, "data": "x"}',
    "entries": '{"data": [1, {"date": "01-01-2024"}, null, {"nav": 7, "date": "03-01-2024"}]}',
}


def test_no_response_is_lost(spark):
    raw = bronze(spark, ("1", GOOD), *ODD.items())
    found = {r.scheme_code: (r.outcome, r.n_entries) for r in responses.outcomes(raw).collect()}
    empty = {"no data", "null data", "empty"}
    assert found == {"1": ("parsed", 3), "entries": ("parsed", 4), **{k: ("empty" if k in empty else "malformed", 0) for k in ODD if k != "entries"}}
    lost = responses.quarantined_responses(raw)
    assert {json.loads(r.raw_payload)["scheme_code"] for r in lost.collect()} == set(ODD) - {"entries"}
    assert lost.select("quarantine_id").distinct().count() == len(ODD) - 1
    rows = {(r.scheme_code, r.pos): (r.date, r.nav) for r in responses.price_rows(raw).collect()}
    assert rows["1", 1] == ("02-01-2024", "N.A.") and rows["entries", 0] == (None, None) and rows["entries", 3] == ("03-01-2024", "7")
    assert responses.outcomes(raw.limit(0)).collect() == [] == responses.price_rows(raw.limit(0)).collect()


def test_long_responses_are_cut_without_a_difference(spark):
    entries = [(f"{1 + i % 28:02d}-01-2024", f"{i}.5") for i in range(300)]
    tricky = body("2", [("a},{b", "1"), ("02-01-2024", "},{"), ("x]", "[y"), ("03-01-2024", "3")])
    nested = '{"meta": {"scheme_code": "3"}, "data": [{"date": "01-01-2024", "nav": "1", "more": [{"a": 1}, {"b": 2}]}, {"date": "02-01-2024", "nav": "2"}]}'
    raw = bronze(spark, ("1", body("1", entries)), ("2", tricky), ("3", nested), ("4", GOOD), *ODD.items())
    columns = ["raw_id", "scheme_code", "meta", "pos", "date", "nav"]
    whole = sorted(map(str, responses.price_rows(raw).select(*columns).collect()))
    assert sorted(map(str, responses.price_rows(raw, large=20).select(*columns).collect())) == whole and len(whole) == 300 + 4 + 2 + 3 + 4


def test_repeated_landing_is_one_response(spark):
    raw = bronze(spark, ("1", GOOD), ("1", GOOD), ("2", body("2", [])))
    assert sorted(r.scheme_code for r in feed.latest_raw(raw).collect()) == ["1", "2"]


def values(summary):
    return {r.metric: r.value for r in summary.collect()}


def test_load_refresh_and_rerun(spark):
    load = FundLoad(Lake(spark, new_folder(spark, "test-load")))
    with pytest.raises(RuntimeError):
        load.daily_refresh(bronze(spark, ("1", GOOD)), AT)
    catalogue = spark.createDataFrame([(c, "x") for c in "1234"] + [("5", ""), (None, "x")], "schemeCode string, schemeName string")
    first = bronze(spark, ("1", GOOD), ("2", body("2", [("31-01-2024", "7")], fund_house="")), ("3", "{"), ("9", GOOD))
    got = values(load.full_load(catalogue, first, AT, 42, 100))
    assert got == {"universe_size": 6, "curated_schemes": 4, "schemes_succeeded": 2, "schemes_failed": 2, "dim_rows_upserted": 1, "nav_rows_attempted": 2,
                   "nav_rows_orphaned_anti_join": 1, "nav_rows_upserted": 1, "quarantine_rows_written": 5, "core_mf_nav_ref_synced": 1}
    assert {(r.scheme_code, r.reason) for r in load.failed().collect()} == {("3", "no response could be parsed"), ("4", "no response")}
    kept = load.lake.read("dq_quarantine")
    assert {r.quarantined_at for r in kept.collect()} == {AT} and kept.where("reason like 'scheme without fund_house'").count() == 1

    news = bronze(spark, ("1", body("1", [("01-01-2024", "99"), ("03-02-2024", "11"), ("04-02-2024", "0")])), ("2", GOOD))
    got = values(load.daily_refresh(news, AT + dt.timedelta(1)))
    assert got == {"schemes_checked": 1, "schemes_with_new_rows": 1, "schemes_no_new_rows": 0, "schemes_failed": 0, "nav_rows_upserted": 1,
                   "quarantine_rows_written": 1, "core_mf_nav_ref_synced": 1}
    again = values(load.daily_refresh(news, AT + dt.timedelta(2)))
    assert again["schemes_no_new_rows"] == 1 and again["nav_rows_upserted"] == again["quarantine_rows_written"] == 0
    silent = values(load.daily_refresh(bronze(spark, ("1", "{")), AT + dt.timedelta(3)))
    assert silent["schemes_failed"] == 1 and [tuple(r) for r in load.failed().collect()] == [("1", "no response could be parsed")]
    assert [(r.scheme_code, str(r.watermark)) for r in load.lake.read("nav_marks").collect()] == [("1", "2024-02-03")]
    assert {(str(r.nav_date), float(r.nav_value)) for r in load.lake.read("fact_mf_nav").collect()} == {("2024-01-01", 10.5), ("2024-02-03", 11.0)}


def test_merge_reads_only_touched_months(spark):
    lake = Lake(spark, new_folder(spark, "test-months"))
    rows = spark.range(24).select(F.lit("1").alias("scheme_code"), F.add_months(F.lit("2024-01-15").cast("date"), F.col("id").cast("int")).alias("nav_date"),
                                  F.lit(1).cast("decimal(14,5)").alias("nav_value"))
    lake.merge("mf_nav_ref", rows, ["scheme_code", "nav_date"], False)
    months = lake._months(lake._with_month("fact_mf_nav", rows.where("nav_date < '2024-03-01'")))
    lake.overwrite("fact_mf_nav", rows)
    text = lake.read("fact_mf_nav").where(F.col("month").isin(months))._jdf.queryExecution().executedPlan().toString()
    assert sorted(months) == ["2024-01", "2024-02"] and "PartitionFilters: [month" in text
