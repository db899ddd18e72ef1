"""Registered control queries: all ledgers tied out, and a copy of the prices kept up from a change log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import cents, unit_ticks
from ..operators import changes, posting
from ..operators.reconcile import control_totals
from ..session import durable, new_folder, swept
from ..sources.tables import Lake
from .feed_queries import SILVER_SQL, first_load, second_load
from .posting_queries import (
    CARD_SQL, CARD_VIEWS, DEPOSIT_SQL, DEPOSIT_VIEWS, FUND_ORDER, FUND_SQL, FUND_VIEWS, LOAN_ORDER, LOAN_SQL, LOAN_VIEWS, PAYMENT_SQL,
    PAYMENT_VIEWS, cards, deposit_accounts, fund_requests, loans, posted_cards, posted_deposits, posted_funds, posted_loans, posted_payments,
)
from .registry import Bank, dbl, query, sql_over

# --- five ledgers ---------------------------------------------------------------------------------


def ledger_totals(bank: Bank) -> DataFrame:
    col = F.col
    amount = cents(col("amount"))
    debit, spend = col("dr_cr") == "debit", col("txn_type").isin("purchase", "atm")
    sell, is_card = col("txn_type").isin("redemption", "switch_out"), col("account_type") == "card"
    sources = posting.payment_sources(bank.fx_account_kind, deposit_accounts(bank), cards(bank))
    parts = [
        ("deposit", bank.fx_deposit_request, posted_deposits(bank), ["account_id", "request_id"], amount,
         deposit_accounts(bank).select("account_id", cents(col("current_balance")).alias("value")), ["account_id"], ["txn_datetime", "request_id"],
         F.when(debit, -amount).otherwise(amount), cents(col("running_balance"))),
        ("card", bank.fx_card_request, posted_cards(bank), ["card_id", "request_id"], amount,
         cards(bank).select("card_id", cents(col("current_statement_balance")).alias("value")), ["card_id"], ["txn_datetime", "request_id"],
         F.when(spend, amount).otherwise(-amount), cents(col("statement_balance"))),
        ("payment", bank.fx_payment_request.drop("account_type"), posted_payments(bank).join(sources.select(col("account_id").alias("from_account_id"), "account_type"), "from_account_id", "left"),
         ["from_account_id", "request_id"], amount,
         sources.select(col("account_id").alias("from_account_id"), F.coalesce(cents(col("balance")), F.lit(0)).alias("value")), ["from_account_id"], ["payment_datetime", "request_id"],
         F.when(is_card, amount).otherwise(-amount), cents(col("balance_after"))),
        ("loan", bank.fx_loan_request, posted_loans(bank), ["loan_id", *LOAN_ORDER[1:]], amount,
         loans(bank).select("loan_id", cents(col("outstanding_principal")).alias("value")), ["loan_id"], LOAN_ORDER,
         -cents(col("principal_paid")), cents(col("outstanding_after"))),
        ("fund", fund_requests(bank), posted_funds(bank), ["folio_id", "scheme_code", *FUND_ORDER[1:]], amount,
         fund_requests(bank).select("folio_id", "scheme_code").distinct().withColumn("value", F.lit(0)), ["folio_id", "scheme_code"], FUND_ORDER,
         F.when(sell, -unit_ticks(col("units"))).otherwise(unit_ticks(col("units"))), unit_ticks(col("units_held"))),
    ]
    # One row each: ledgers are posted one after the other, and none leaves anything else behind.
    rows = [durable(control_totals(name, asked, posted, [*[col(c) for c in identity], worth], opening, keys, order, moved, stored))
            for name, asked, posted, identity, worth, opening, keys, order, moved, stored in parts]
    bank.done("fund requests", "prices")
    return reduce(lambda a, b: a.unionByName(b), rows)


def _check(*identity: str) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in identity)
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS UBIGINT)"


def _totals_sql() -> str:
    cent = "CAST(amount * 100 AS BIGINT)"
    specs = [
        ("deposit", "fx_deposit_request", "dep_out", ["account_id", "request_id", cent], "account_id", "txn_datetime, request_id",
         "SELECT account_id, CAST(opening_balance * 100 AS BIGINT) AS value FROM fx_account",
         f"CASE WHEN dr_cr = 'debit' THEN -{cent} ELSE {cent} END", "CAST(running_balance * 100 AS BIGINT)", "outcome"),
        ("card", "fx_card_request", "card_out", ["card_id", "request_id", cent], "card_id", "txn_datetime, request_id",
         "SELECT card_id, CAST(0 AS BIGINT) AS value FROM fx_card",
         f"CASE WHEN txn_type IN ('purchase','atm') THEN {cent} ELSE -{cent} END", "CAST(statement_balance * 100 AS BIGINT)",
         "CASE WHEN txn_status = 'approved' THEN 'accepted' ELSE 'rejected' END"),
        ("payment", "fx_payment_request", "pay_out", ["from_account_id", "request_id", cent], "from_account_id", "payment_datetime, request_id",
         "SELECT k.account_id AS from_account_id, CASE WHEN k.account_type = 'deposit' THEN CAST(a.opening_balance * 100 AS BIGINT) ELSE 0 END AS value FROM fx_account_kind k JOIN fx_account a ON a.account_id = k.account_id",
         f"CASE WHEN account_type = 'card' THEN {cent} ELSE -{cent} END", "CAST(balance_after * 100 AS BIGINT)", "outcome"),
        ("loan", "fx_loan_request", "loan_out", ["loan_id", *LOAN_ORDER[1:], cent], "loan_id", ", ".join(LOAN_ORDER),
         "SELECT loan_id, CAST(principal * 100 AS BIGINT) AS value FROM fx_loan", "-CAST(principal_paid * 100 AS BIGINT)", "CAST(outstanding_after * 100 AS BIGINT)", "outcome"),
        ("fund", "fx_mf_request", "fund_out", ["folio_id", "scheme_code", *FUND_ORDER[1:], cent], "folio_id, scheme_code", ", ".join(FUND_ORDER),
         "SELECT DISTINCT folio_id, scheme_code, CAST(0 AS BIGINT) AS value FROM fx_mf_request", "CASE WHEN sell THEN -u ELSE u END", "held", "outcome"),
    ]
    parts = []
    for name, asked, out, identity, keys, order, opening, moved, stored, outcome in specs:
        same = " AND ".join(f"m.{k.strip()} = o.{k.strip()}" for k in keys.split(","))
        parts.append(f"""
SELECT '{name}' AS ledger, (SELECT count(*) FROM {asked}) AS n_requests, count(*) FILTER (WHERE k = 'accepted') AS n_accepted, count(*) FILTER (WHERE k = 'rejected') AS n_rejected,
  (SELECT CAST(sum(CAST({_check(*identity)} AS HUGEINT)) AS VARCHAR) FROM {asked}) AS checksum_requests,
  CAST(coalesce(sum(CAST(c AS HUGEINT)) FILTER (WHERE k = 'accepted'), 0) AS VARCHAR) AS checksum_accepted,
  CAST(any_value(b.opening_total) AS VARCHAR) AS opening_total, CAST(any_value(b.net) AS VARCHAR) AS net_accepted, CAST(any_value(b.closing) AS VARCHAR) AS closing_total,
  any_value(b.off) AS n_keys_off,
  (SELECT sum(CAST({_check(*identity)} AS HUGEINT)) FROM {asked}) = sum(CAST(c AS HUGEINT)) AS requests_tie,
  any_value(b.opening_total + b.net = b.closing AND b.off = 0) AS balances_tie
FROM (SELECT {outcome} AS k, {_check(*identity)} AS c FROM {out}),
  (SELECT CAST(sum(value) AS HUGEINT) AS opening_total, CAST(sum(coalesce(net, 0)) AS HUGEINT) AS net, CAST(sum(coalesce(last, value)) AS HUGEINT) AS closing,
     count(*) FILTER (WHERE value + coalesce(net, 0) <> coalesce(last, value)) AS off
   FROM ({opening}) o LEFT JOIN (
     SELECT {keys}, sum({moved}) AS net, arg_max({stored}, ({order})) AS last FROM {out} WHERE {outcome} = 'accepted' GROUP BY {keys}) m ON {same}) b""")
    return "\nUNION ALL ".join(parts)


@query("ledger_reconciliation", sql_over(f"{DEPOSIT_VIEWS} {CARD_VIEWS} {PAYMENT_VIEWS} {LOAN_VIEWS} {FUND_VIEWS}",
                                         ",".join([DEPOSIT_SQL, CARD_SQL, PAYMENT_SQL, LOAN_SQL, FUND_SQL]) + _totals_sql()))
def _reconciliation(bank):
    """Requests, facts, rejections and balances of all five ledgers."""
    with swept(bank.spark):
        return ledger_totals(bank)


# --- change data capture --------------------------------------------------------------------------

KEYS, VALUES = ["scheme_code", "nav_date"], ["nav_value"]


@query("nav_change_apply", sql_over("fx_raw_nav", SILVER_SQL + """
SELECT m.scheme_code, m.nav_date, CAST(m.nav_value AS DOUBLE) AS nav_value,
  CASE WHEN f.scheme_code IS NULL OR (s.scheme_code IS NOT NULL AND f.nav_value <> s.nav_value) THEN 2 ELSE 1 END AS seq
FROM mirror m LEFT JOIN nav_first f ON f.scheme_code = m.scheme_code AND f.nav_date = m.nav_date
  LEFT JOIN nav_second s ON s.scheme_code = m.scheme_code AND s.nav_date = m.nav_date
WHERE NOT (m.scheme_code = '2' AND day(m.nav_date) = 13)"""))
def _change_apply(bank):
    """Inserts, restatements and deletes land as a change log, then the restatements a second time."""
    root = new_folder(bank.spark, "changes")
    lake = Lake(bank.spark, f"{root}/lake")
    one, two = (lake.staged(n, load.select(*KEYS, *VALUES)) for n, load in (("one", first_load(bank)), ("two", second_load(bank))))
    restated = lake.staged("restated", one.join(two, KEYS, "left_anti").unionByName(two))
    ended = restated.where("not (scheme_code = '2' and dayofmonth(nav_date) = 13)")
    logs = [lake.staged(f"log-{n}", changes.capture(a, b, KEYS, VALUES, n)) for n, (a, b) in enumerate(((one.limit(0), one), (one, restated), (restated, ended)), 1)]
    copy = changes.Copy(lake, "mf_nav_copy", KEYS, VALUES)
    for log in (*logs, logs[1]):
        log.write.mode("append").parquet(f"{root}/landing")
        copy.follow(bank.spark, f"{root}/landing", log.schema, f"{root}/checkpoint").awaitTermination()
    return copy.rows().select(*KEYS, dbl("nav_value"), F.col("seq").cast("int").alias("seq"))
