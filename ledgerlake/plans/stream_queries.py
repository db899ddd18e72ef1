"""Registered streaming queries: run to the end of what has landed, then read back the finished table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import new_folder
from ..sources import feed
from ..sources.tables import Lake
from ..operators import late
from ..streaming import account_state, feed_stream, key_index, ledger_stream
from .feed_queries import SILVER_SQL, payloads
from .posting_queries import DEPOSIT_SQL, DEPOSIT_VIEWS, deposit_accounts, deposits_with_replays
from .registry import dbl, query, sql_over


def _finish(stream) -> None:
    stream.awaitTermination()


@query("stream_silver_nav", sql_over("fx_raw_nav", SILVER_SQL + "SELECT scheme_code, nav_date, CAST(nav_value AS DOUBLE) AS nav_value FROM silver"))
def _silver_nav(bank):
    """Two landings; the second run goes on where the first stopped."""
    root = new_folder(bank.spark, "feed-stream")
    lake, landing = Lake(bank.spark, f"{root}/lake"), f"{root}/landing"
    for part in ("l_linenumber <= 3", "not coalesce(l_linenumber <= 3, false)"):
        rows = payloads(bank, bank.fx_raw_nav.where(part))
        landed = feed.raw_rows(rows.withColumnRenamed("l_orderkey", "seq"), "mf_scheme", keep=["seq"])
        landed.write.mode("append").option("compression", "gzip").json(landing)
        _finish(feed_stream.silver_stream(bank.spark, landing, lake, f"{root}/checkpoint"))
    return lake.read("fact_mf_nav").select("scheme_code", "nav_date", dbl("nav_value"))


@query("stream_dedupe", sql_over("fx_deposit_request fx_deposit_replay", """
SELECT DISTINCT account_id, idempotency_key, CAST(amount AS DOUBLE) AS amount FROM (SELECT * FROM fx_deposit_request UNION ALL SELECT * FROM fx_deposit_replay)""".strip()))
def _dedupe(bank):
    root = new_folder(bank.spark, "dedupe-stream")
    deposits_with_replays(bank).write.parquet(f"{root}/landing")
    requests = ledger_stream.read_requests(bank.spark, f"{root}/landing")
    kept = ledger_stream.first_of_key(requests, "txn_datetime", ["account_id", "idempotency_key"], "2 hours")
    _finish(ledger_stream.append_stream(kept, f"{root}/kept", f"{root}/checkpoint"))
    return bank.spark.read.parquet(f"{root}/kept").select("account_id", "idempotency_key", dbl("amount"))


@query("stream_dedupe_unbounded", sql_over("fx_deposit_request fx_deposit_replay", """
SELECT DISTINCT account_id, idempotency_key, CAST(amount AS DOUBLE) AS amount FROM (SELECT * FROM fx_deposit_request UNION ALL SELECT * FROM fx_deposit_replay)""".strip()))
def _dedupe_unbounded(bank):
    """The latest third lands first and the repeats last: every first use counts, however old, and no repeat."""
    root = new_folder(bank.spark, "key-stream")
    requests, landing = bank.fx_deposit_request, f"{root}/landing"
    dedupe = key_index.UnboundedDedupe(
        bank.spark, root, requests.schema, ["account_id", "idempotency_key"], ["txn_datetime", "request_id"])
    first, second = requests.agg(F.percentile_approx("txn_datetime", [0.33, 0.67])).first()[0]
    at = F.col("txn_datetime")
    parts = [requests.where(F.coalesce(at > second, F.lit(False))), requests.where((at > first) & (at <= second)),
             requests.where(~F.coalesce(at > first, F.lit(False))), bank.fx_deposit_replay]
    for part in parts:
        part.write.mode("append").parquet(landing)
        _finish(dedupe.run(landing))
    return dedupe.kept().select("account_id", "idempotency_key", dbl("amount"))


DEPOSIT_RESULT = """
SELECT request_id, account_id, CAST(amount AS DOUBLE) AS amount, dr_cr, outcome, reason_code, CAST(running_balance AS DOUBLE) AS running_balance FROM dep_out"""


def landed_in_parts(bank, name: str, parts: list) -> account_state.StatefulDepositStream:
    """A stream of deposits that has taken in ``parts``, one landing after the other."""
    root = new_folder(bank.spark, name)
    stream = account_state.StatefulDepositStream(bank.spark, root, deposit_accounts(bank))
    for part in parts:
        part.write.mode("append").parquet(f"{root}/landing")
        _finish(stream.run(f"{root}/landing"))
    return stream


def _thirds(requests) -> list:
    first, second = requests.agg(F.percentile_approx("txn_datetime", [0.33, 0.67])).first()[0]
    at = F.col("txn_datetime")
    middle = F.coalesce((at > first) & (at <= second), F.lit(False))
    early = F.coalesce(at <= first, F.lit(False))
    return [requests.where(early), requests.where(middle), requests.where(~early & ~middle)]


@query("stream_post_deposit", sql_over(DEPOSIT_VIEWS, DEPOSIT_SQL + DEPOSIT_RESULT))
def _post_deposit(bank):
    """The requests land in three parts of event time; the result is that of one batch."""
    stream = landed_in_parts(bank, "deposit-stream", _thirds(bank.fx_deposit_request))
    return stream.posted().select(
        "request_id", "account_id", dbl("amount"), "dr_cr", "outcome", "reason_code", dbl("running_balance")
    )


@query("late_requests", sql_over(DEPOSIT_VIEWS, DEPOSIT_SQL + """
SELECT request_id, account_id, request_id % 7 = 0 AS back_dated, outcome, reason_code, CAST(running_balance AS DOUBLE) AS running_balance FROM dep_out"""))
def _late_requests(bank):
    """Every seventh request lands after all others. What the stream calls late is settled again: as if all had been in time."""
    requests = bank.fx_deposit_request
    behind = F.col("request_id") % 7 == 0
    stream = landed_in_parts(bank, "late-stream", [*_thirds(requests.where(~behind)), requests.where(behind)])
    posted = stream.posted().where("outcome <> 'late'")
    # It stands in the result and says which rows leave it, so it is settled once.
    redone = bank.once("settled again", lambda: late.resettle(posted, stream.late(), deposit_accounts(bank)).select(
        "request_id", "account_id", "outcome", "reason_code", "running_balance"))
    done = late.replaced(posted, redone)
    return done.select("request_id", "account_id", behind.alias("back_dated"), "outcome", "reason_code", dbl("running_balance"))
