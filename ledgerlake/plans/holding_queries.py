"""Registered queries of as-of joins, running values, holdings and wealth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import headroom
from ..functions.dates import add_years, recent_month_end_dates, recent_month_ends
from ..functions.money import cents, from_cents, interchange_fee, market_value, reward_points, units_for
from ..operators import holdings, ordered, posting
from ..operators.asof import asof_join, value_on_dates
from .feed_queries import NAV_SQL, prices
from .posting_queries import DEPOSIT_SQL, FUND_ORDER, FUND_SQL, FUND_VIEWS, deposit_accounts, fund_prices, posted_funds
from .registry import Bank, dbl, query, sql_over

MONTHS = 3


def as_of(bank: Bank):
    return bank.orders.agg(F.max("o_orderdate").cast("date")).first()[0]


# --- as-of ----------------------------------------------------------------------------------------


@query("asof_nav", sql_over("fx_raw_nav fx_mf_request", NAV_SQL + """
SELECT r.folio_id, r.scheme_code, r.txn_date, r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, n.nav_date, CAST(n.nav_value AS DOUBLE) AS nav_value
FROM fx_mf_request r ASOF LEFT JOIN nav_clean n ON n.scheme_code = r.scheme_code AND n.nav_date <= r.txn_date"""))
def _asof_nav(bank):
    found = asof_join(bank.fx_mf_request, prices(bank), ["scheme_code"], "txn_date", "nav_date", ["nav_value"])
    return found.select("folio_id", "scheme_code", *FUND_ORDER, "nav_date", dbl("nav_value"))


def posted_order_deposits(bank: Bank) -> DataFrame:
    posted = posting.post_deposit_txn(bank.fx_order_deposit.drop("idempotency_key"), deposit_accounts(bank))
    return posting.accepted(posted).withColumn("txn_date", F.to_date("txn_datetime"))


ORDER_DEPOSIT_SQL = DEPOSIT_SQL.replace("fx_deposit_request", "fx_order_deposit").replace("dep_", "odep_") + """,
as_of AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders),
month_ends AS (SELECT least(last_day(CAST(date_trunc('month', d) - to_months(CAST(i AS INTEGER)) AS DATE)), d) AS snapshot_date FROM as_of, range(0, 3) t(i)),
odep_days AS (SELECT account_id, CAST(txn_datetime AS DATE) AS txn_date, arg_max(running_balance, request_id) AS balance FROM odep_out WHERE outcome = 'accepted' GROUP BY ALL),
odep_accounts AS (SELECT DISTINCT account_id FROM odep_days),
odep_balance AS (
  SELECT g.account_id, g.snapshot_date, coalesce(b.balance, 0) AS balance
  FROM (SELECT account_id, snapshot_date FROM odep_accounts, month_ends) g
  ASOF LEFT JOIN odep_days b ON b.account_id = g.account_id AND b.txn_date <= g.snapshot_date)
"""


@query("balance_as_of", sql_over("fx_account fx_order_deposit", ORDER_DEPOSIT_SQL + """
SELECT account_id, snapshot_date AS as_of, CAST(balance AS DOUBLE) AS running_balance FROM odep_balance"""))
def _balance_as_of(bank):
    dates = recent_month_end_dates(as_of(bank), MONTHS)
    ledger = posted_order_deposits(bank)
    found = value_on_dates(ledger, ["account_id"], "txn_date", ["txn_datetime", "request_id"], "running_balance", dates)
    return found.withColumn("running_balance", dbl("running_balance"))


@query("recent_month_ends", """
WITH as_of AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders),
ends AS (SELECT least(last_day(CAST(date_trunc('month', d) - to_months(CAST(i AS INTEGER)) AS DATE)), d) AS month_end FROM as_of, range(0, 12) t(i))
SELECT month_end, count(o_orderkey) AS n_orders FROM ends LEFT JOIN orders ON last_day(CAST(o_orderdate AS DATE)) = last_day(month_end) GROUP BY month_end""")
def _recent_month_ends(bank):
    """The last twelve month ends of the order dates, with the orders of each month."""
    reach = bank.orders.agg(F.max("o_orderdate").cast("date").alias("d"))
    ends = reach.select(F.explode(recent_month_ends(F.col("d"), 12)).alias("month_end"))
    per_month = bank.orders.groupBy(F.last_day("o_orderdate").alias("_m")).agg(F.count(F.lit(1)).alias("n_orders"))
    joined = ends.join(per_month, F.last_day("month_end") == F.col("_m"), "left")
    return joined.select("month_end", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


# --- scalar formulas over ledgers -----------------------------------------------------------------


@query("card_expiry", """
SELECT o_orderkey AS card_id, CAST(o_orderdate AS DATE) AS issue_date, CAST(CAST(o_orderdate AS DATE) + to_years(CAST(3 + o_orderkey % 3 AS INTEGER)) AS DATE) AS expiry_date FROM orders""")
def _card_expiry(bank):
    issued = F.to_date("o_orderdate")
    years = (F.lit(3) + F.col("o_orderkey") % 3).cast("int")
    return bank.orders.select(F.col("o_orderkey").alias("card_id"), issued.alias("issue_date"), add_years(issued, years).alias("expiry_date"))


@query("card_fees_rewards", sql_over("fx_card_request", """
SELECT request_id, txn_type, CASE WHEN txn_type = 'purchase' THEN ((CAST(amount * 100 AS BIGINT) * 15 + 500) // 1000) / 100.0 END AS interchange_fee,
  CASE WHEN txn_type = 'purchase' THEN CAST(CAST(amount * 100 AS BIGINT) // 10000 AS DOUBLE) END AS reward_points FROM fx_card_request""".strip()))
def _fees(bank):
    amount, kind = F.col("amount"), F.col("txn_type")
    return bank.fx_card_request.select(
        "request_id", "txn_type", dbl(interchange_fee(amount, kind), "interchange_fee"), dbl(reward_points(amount, kind), "reward_points")
    )


@query("account_headroom", sql_over("fx_account fx_card", """
SELECT account_id, 'deposit' AS kind, CAST(CASE WHEN deposit_type = 'overdraft' THEN opening_balance + coalesce(overdraft_limit, 0) ELSE opening_balance - min_balance END AS DOUBLE) AS available
FROM fx_account WHERE status = 'active'
UNION ALL
SELECT c.account_id, 'card', CAST(coalesce(c.credit_limit, 0) - 0 AS DOUBLE) FROM fx_card c JOIN fx_account a ON a.account_id = c.account_id WHERE a.status = 'active'""".strip()))
def _headroom(bank):
    active = bank.fx_account.where("status = 'active'")
    deposits = active.select(
        "account_id", F.lit("deposit").alias("kind"), F.col("opening_balance").alias("balance"), "min_balance",
        F.col("overdraft_limit").alias("spare"), (F.col("deposit_type") == "overdraft").alias("overdraft"),
    )
    money = F.lit(0).cast("decimal(18,2)")
    cards = bank.fx_card.join(active.select("account_id"), "account_id", "left_semi").select(
        "account_id", F.lit("card").alias("kind"), money.alias("balance"), money.alias("min_balance"),
        F.col("credit_limit").alias("spare"), F.lit(False).alias("overdraft"),
    )
    room = headroom(F.col("kind"), F.col("balance"), F.col("min_balance"), F.col("spare"), F.col("overdraft"))
    return deposits.unionByName(cards).select("account_id", "kind", dbl(room, "available"))


@query("mf_units_valuation", sql_over("fx_raw_nav fx_mf_request", NAV_SQL + """,
priced AS (SELECT r.*, CAST(n.nav_value * 100000 AS HUGEINT) AS nav5, (2 * CAST(r.amount * 100 AS HUGEINT) * 100000000 + CAST(n.nav_value * 100000 AS HUGEINT)) // (2 * CAST(n.nav_value * 100000 AS HUGEINT)) AS u
  FROM fx_mf_request r JOIN nav_clean n ON n.scheme_code = r.scheme_code AND n.nav_date = r.txn_date)
SELECT folio_id, scheme_code, txn_date, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(u AS DOUBLE) / 100000 AS units, CAST((2 * u * nav5 + 100000000) // 200000000 AS DOUBLE) / 100 AS market_value FROM priced"""))
def _valuation(bank):
    nav = prices(bank).select("scheme_code", F.col("nav_date").alias("txn_date"), "nav_value")
    priced = bank.fx_mf_request.join(nav, ["scheme_code", "txn_date"])
    priced = priced.withColumn("units", units_for(F.col("amount"), F.col("nav_value")))
    worth = market_value(F.col("units"), F.col("nav_value"))
    return priced.select("folio_id", "scheme_code", *FUND_ORDER, dbl("units"), dbl(worth, "market_value"))


# --- running values -------------------------------------------------------------------------------


@query("running_balance", sql_over("fx_account fx_deposit_request", """
SELECT r.request_id, r.account_id, CAST(coalesce(a.opening_balance, 0) + sum(CASE WHEN r.dr_cr = 'debit' THEN -r.amount ELSE r.amount END)
  OVER (PARTITION BY r.account_id ORDER BY r.txn_datetime, r.request_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_balance
FROM fx_deposit_request r LEFT JOIN fx_account a ON a.account_id = r.account_id""".strip()))
def _running_balance(bank):
    requests = bank.fx_deposit_request
    hot = ordered.hot_keys(requests, ["account_id"])
    amount = cents(F.col("amount"))
    moves = requests.withColumn("_move", F.when(F.col("dr_cr") == "debit", -amount).otherwise(amount))
    summed = ordered.running(
        moves, ["account_id"], ["txn_datetime", "request_id"], {"_sum": ordered.Running("sum", "_move")},
        None, hot,
    )
    joined = summed.join(bank.fx_account.select("account_id", "opening_balance"), "account_id", "left")
    balance = from_cents(F.coalesce(cents(F.col("opening_balance")), F.lit(0)) + F.col("_sum"))
    return joined.select("request_id", "account_id", dbl(balance, "running_balance"))


@query("floored_running_sum", sql_over("fx_mf_request", """
ranked AS (SELECT *, CASE WHEN txn_type = 'redemption' THEN -amount ELSE amount END AS delta,
  row_number() OVER (PARTITION BY folio_id, scheme_code ORDER BY txn_date, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM fx_mf_request),
walk AS (
  SELECT folio_id, scheme_code, rn, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(greatest(delta, 0) AS DECIMAL(18,2)) AS held FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.folio_id, r.scheme_code, r.rn, r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, CAST(greatest(w.held + r.delta, 0) AS DECIMAL(18,2))
  FROM walk w JOIN ranked r ON r.folio_id = w.folio_id AND r.scheme_code = w.scheme_code AND r.rn = w.rn + 1)
SELECT folio_id, scheme_code, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(held AS DOUBLE) AS invested FROM walk"""))
def _floored(bank):
    requests, keys = bank.fx_mf_request, ["folio_id", "scheme_code"]
    hot = ordered.hot_keys(requests, keys)
    amount = cents(F.col("amount"))
    deltas = requests.withColumn("_delta", F.when(F.col("txn_type") == "redemption", -amount).otherwise(amount))
    summed = ordered.floored_sum(deltas, keys, FUND_ORDER, "_delta", "_held", None, hot)
    return summed.select(*keys, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dbl(from_cents(F.col("_held")), "invested"))


@query("strict_timestamps", sql_over("fx_deposit_request", """
ranked AS (SELECT account_id, request_id, CAST(epoch(date_trunc('hour', txn_datetime)) AS BIGINT) AS t,
  row_number() OVER (PARTITION BY account_id ORDER BY txn_datetime, request_id) AS rn FROM fx_deposit_request),
walk AS (
  SELECT account_id, request_id, rn, t FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.account_id, r.request_id, r.rn, greatest(r.t, w.t + 1) FROM walk w JOIN ranked r ON r.account_id = w.account_id AND r.rn = w.rn + 1)
SELECT account_id, request_id, t AS strict_second FROM walk"""))
def _strict(bank):
    """Times cut to the hour tie often; each is moved on until it is later than the one before."""
    requests = bank.fx_deposit_request
    hot = ordered.hot_keys(requests, ["account_id"])
    at = F.col("txn_datetime")
    seconds = F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + F.hour(at) * 3600
    rows = requests.withColumn("_t", seconds)
    strict = ordered.strictly_increasing(
        rows, ["account_id"], ["txn_datetime", "request_id"], "_t", "strict_second", None, hot
    )
    return strict.select("account_id", "request_id", "strict_second")


@query("latest_txn_per_account", sql_over("fx_deposit_request", """
SELECT account_id, request_id, txn_datetime, CAST(amount AS DOUBLE) AS amount, dr_cr FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY txn_datetime DESC, request_id DESC) AS rn FROM fx_deposit_request) WHERE rn = 1""".strip()))
def _latest(bank):
    rows = bank.fx_deposit_request.select("account_id", "request_id", "txn_datetime", "amount", "dr_cr")
    return ordered.latest_per_key(rows, ["account_id"], ["txn_datetime", "request_id"]).withColumn("amount", dbl("amount"))


# --- holdings and wealth --------------------------------------------------------------------------

HOLDING_SQL = FUND_SQL + """,
hold_as_of AS (SELECT CAST(max(o_orderdate) AS DATE) AS hold_day FROM orders),
hold_events AS (SELECT * FROM fund_out, hold_as_of WHERE outcome = 'accepted' AND txn_date <= hold_day),
hold_month AS (SELECT * FROM (SELECT folio_id, scheme_code, CAST(date_trunc('month', txn_date) AS DATE) AS m, held, paid,
  row_number() OVER (PARTITION BY folio_id, scheme_code, date_trunc('month', txn_date) ORDER BY txn_date DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS back FROM hold_events) WHERE back = 1),
hold_grid AS (SELECT folio_id, scheme_code, CAST(unnest(generate_series(CAST(min(m) AS TIMESTAMP), CAST(max(m) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m FROM hold_month GROUP BY folio_id, scheme_code),
hold_state AS (SELECT g.folio_id, g.scheme_code, least(last_day(g.m), hold_day) AS snapshot_date, s.held, s.paid
  FROM hold_as_of, hold_grid g ASOF JOIN hold_month s ON s.folio_id = g.folio_id AND s.scheme_code = g.scheme_code AND s.m <= g.m),
hold_priced AS (SELECT h.*, n.nav_value, CAST(n.nav_value * 100000 AS HUGEINT) AS nav5 FROM hold_state h ASOF JOIN nav_clean n ON n.scheme_code = h.scheme_code AND n.nav_date <= h.snapshot_date),
holding AS (SELECT *, (2 * held * nav5 + 100000000) // 200000000 AS worth FROM hold_priced)
"""
WEALTH_SQL = HOLDING_SQL + "," + ORDER_DEPOSIT_SQL + """,
wealth AS (
  SELECT c.c_custkey AS customer_id, m.snapshot_date, coalesce(d.v, 0) AS deposit_balance, CAST(coalesce(a.v, 0) AS DECIMAL(18,2)) AS mf_aum
  FROM customer c CROSS JOIN month_ends m
    LEFT JOIN (SELECT x.customer_id, b.snapshot_date, sum(b.balance) AS v FROM odep_balance b JOIN fx_account x ON x.account_id = b.account_id GROUP BY ALL) d ON d.customer_id = c.c_custkey AND d.snapshot_date = m.snapshot_date
    LEFT JOIN (SELECT f.customer_id, h.snapshot_date, CAST(sum(h.worth) AS DECIMAL(18,0)) / 100 AS v FROM holding h JOIN fx_folio f ON f.folio_id = h.folio_id GROUP BY ALL) a ON a.customer_id = c.c_custkey AND a.snapshot_date = m.snapshot_date)
"""
WEALTH_VIEWS = f"{FUND_VIEWS} fx_account fx_order_deposit"


def accepted_funds(bank: Bank) -> DataFrame:
    return bank.once("accepted funds", lambda: posting.accepted(posted_funds(bank)).select(
        "folio_id", "scheme_code", *FUND_ORDER, "units_held", "invested_amount"))


def holding_snapshots(bank: Bank, dates: list | None = None) -> DataFrame:
    """Holdings at all month ends or at those among ``dates``. Prices and facts are made once."""
    return holdings.monthly_holdings(accepted_funds(bank), fund_prices(bank), FUND_ORDER, as_of(bank), dates=dates)


def wealth_dates(bank: Bank) -> list:
    return recent_month_end_dates(as_of(bank), MONTHS)


def wealth_snapshots(bank: Bank) -> DataFrame:
    dates = wealth_dates(bank)
    customers = bank.customer.select(F.col("c_custkey").alias("customer_id"))
    return holdings.wealth(
        customers, bank.fx_account, posted_order_deposits(bank), ["txn_datetime", "request_id"],
        holding_snapshots(bank, dates), bank.fx_folio, dates,
    )


@query("mf_holding_snapshot", sql_over(FUND_VIEWS, HOLDING_SQL + """
SELECT folio_id, scheme_code, snapshot_date, CAST(held AS DOUBLE) / 100000 AS units_held, CAST(paid AS DOUBLE) / 100 AS invested_amount, CAST(nav_value AS DOUBLE) AS nav_value,
  CAST(worth AS DOUBLE) / 100 AS market_value, CAST(worth - paid AS DOUBLE) / 100 AS unrealised_gain FROM holding"""))
def _holding_snapshot(bank):
    values = ["units_held", "invested_amount", "nav_value", "market_value", "unrealised_gain"]
    return holding_snapshots(bank).select("folio_id", "scheme_code", "snapshot_date", *[dbl(v) for v in values])


@query("wealth_snapshot", sql_over(WEALTH_VIEWS, WEALTH_SQL + """
SELECT customer_id, snapshot_date, CAST(deposit_balance AS DOUBLE) AS deposit_balance, CAST(mf_aum AS DOUBLE) AS mf_aum, CAST(deposit_balance + mf_aum AS DOUBLE) AS total_relationship_value,
  CASE WHEN deposit_balance + mf_aum >= 10000000 THEN 'ultra_hni' WHEN deposit_balance + mf_aum >= 1000000 THEN 'hni' WHEN deposit_balance + mf_aum >= 100000 THEN 'affluent' ELSE 'mass' END AS wealth_segment FROM wealth"""))
def _wealth(bank):
    return wealth_snapshots(bank).select(
        "customer_id", "snapshot_date", dbl("deposit_balance"), dbl("mf_aum"), dbl("total_relationship_value"), "wealth_segment"
    )
