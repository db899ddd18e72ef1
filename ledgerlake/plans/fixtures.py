"""Banking views over the driver's tables.

The texts run on Spark and on the SQL engine that checks it. ``{name}`` stands for a table or view.
"""

from __future__ import annotations

# name -> (what it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_account": (("customer",), """
SELECT c_custkey AS account_id, c_custkey AS customer_id,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'overdraft' WHEN 'BUILDING' THEN 'checking' WHEN 'FURNITURE' THEN 'term' ELSE 'savings' END AS deposit_type,
  CASE WHEN c_acctbal < 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS opening_balance,
  CASE WHEN c_mktsegment IN ('MACHINERY','HOUSEHOLD') THEN CAST(100 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS min_balance,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(500 AS DECIMAL(18,2)) END AS overdraft_limit,
  CASE WHEN c_custkey % 20 = 7 THEN 'closed' ELSE 'active' END AS status
FROM {customer}"""),
    "fx_deposit_request": (("events",), """
SELECT event_id AS request_id, CASE WHEN event_id % 211 = 0 THEN user_id + 10000000 ELSE user_id END AS account_id,
  ts AS txn_datetime, CAST(value AS DECIMAL(18,2)) AS amount,
  CASE WHEN event_type IN ('purchase','view','error') THEN 'debit' ELSE 'credit' END AS dr_cr,
  CASE event_id % 5 WHEN 0 THEN 'branch' WHEN 1 THEN 'atm' WHEN 2 THEN 'netbanking' WHEN 3 THEN 'mobile' ELSE 'upi' END AS channel,
  CAST(event_id AS STRING) AS idempotency_key
FROM {events}"""),
    "fx_deposit_replay": (("fx_deposit_request",), """
SELECT request_id + 1000000000 AS request_id, account_id, txn_datetime + INTERVAL 1 HOUR AS txn_datetime, amount, dr_cr, channel, idempotency_key
FROM {fx_deposit_request} WHERE request_id % 40 = 0"""),
    "fx_card": (("customer",), """
SELECT c_custkey AS card_id, c_custkey AS account_id,
  CASE c_custkey % 3 WHEN 0 THEN 'credit' WHEN 1 THEN 'debit' ELSE 'prepaid' END AS card_type,
  CAST(50000 + (c_custkey % 10) * 100000 AS DECIMAL(18,2)) AS credit_limit,
  CASE WHEN c_custkey % 25 = 3 THEN 'blocked' ELSE 'active' END AS status
FROM {customer}"""),
    "fx_card_request": (("orders",), """
SELECT o_orderkey AS request_id, o_custkey AS card_id, o_orderdate AS txn_datetime, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'purchase' WHEN '2-HIGH' THEN 'purchase' WHEN '3-MEDIUM' THEN 'atm' WHEN '4-NOT SPECIFIED' THEN 'refund' ELSE 'reversal' END AS txn_type,
  CAST(o_orderkey AS STRING) AS idempotency_key
FROM {orders}"""),
    "fx_payment_request": (("orders",), """
SELECT o_orderkey AS request_id, o_custkey AS from_account_id,
  CASE o_custkey % 5 WHEN 0 THEN 'loan' WHEN 1 THEN 'card' WHEN 2 THEN 'card' ELSE 'deposit' END AS account_type,
  o_orderdate AS payment_datetime, CAST(1 + (o_orderkey * 37) % 5000 AS DECIMAL(18,2)) AS amount,
  CASE o_orderkey % 7 WHEN 0 THEN 'upi' WHEN 1 THEN 'neft' WHEN 2 THEN 'rtgs' WHEN 3 THEN 'imps' WHEN 4 THEN 'nach' WHEN 5 THEN 'bbps' ELSE 'swift' END AS rail
FROM {orders}"""),
    # Kind of each account as a payment source (the same rule as in fx_payment_request).
    "fx_account_kind": (("fx_account",), """
SELECT account_id, customer_id, status,
  CASE account_id % 5 WHEN 0 THEN 'loan' WHEN 1 THEN 'card' WHEN 2 THEN 'card' ELSE 'deposit' END AS account_type
FROM {fx_account}"""),
    "fx_loan": (("orders",), """
SELECT o_orderkey AS loan_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS principal,
  CAST(7 + o_orderkey % 9 AS DECIMAL(6,3)) AS interest_rate, CAST(12 * (1 + o_orderkey % 5) AS INT) AS tenure_months,
  CAST(o_orderdate AS DATE) AS disbursal_date, CASE WHEN o_orderkey % 10 = 9 THEN 'written_off' ELSE 'active' END AS status
FROM {orders}"""),
    "fx_loan_request": (("lineitem",), """
SELECT CASE WHEN l_partkey % 101 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END AS loan_id, CAST(l_shipdate AS DATE) AS txn_date,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CASE WHEN l_linenumber % 3 = 0 THEN 'prepayment' ELSE 'emi' END AS txn_type,
  CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.8 AS DECIMAL(2,1)) AS DECIMAL(18,2)) END AS principal_paid,
  l_linenumber, l_partkey, l_suppkey
FROM {lineitem}"""),
    "fx_raw_nav": (("lineitem",), """
SELECT CAST(l_suppkey % 8 AS STRING) AS scheme_code,
  CASE WHEN l_partkey % 97 = 0 THEN 'not-a-date' ELSE CONCAT(LPAD(CAST(EXTRACT(DAY FROM l_shipdate) AS STRING), 2, '0'), '-', LPAD(CAST(EXTRACT(MONTH FROM l_shipdate) AS STRING), 2, '0'), '-', CAST(EXTRACT(YEAR FROM l_shipdate) AS STRING)) END AS date,
  CASE WHEN l_partkey % 89 = 0 THEN 'N.A.' WHEN l_partkey % 83 = 0 THEN '0' ELSE CONCAT(CAST(10 + (l_partkey * 7 + l_orderkey) % 90 AS STRING), '.', LPAD(CAST((l_orderkey * 13 + l_suppkey) % 100000 AS STRING), 5, '0')) END AS nav,
  l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM {lineitem}"""),
    "fx_scheme_meta": (("supplier", "nation"), """
SELECT CAST(s_suppkey AS STRING) AS scheme_code,
  CASE s_suppkey % 6 WHEN 0 THEN CONCAT(s_name, ' - DIRECT Plan - Growth') WHEN 1 THEN CONCAT(s_name, ' Regular Plan IDCW') WHEN 2 THEN CONCAT(s_name, ' Direct Dividend') WHEN 3 THEN CONCAT(s_name, ' Directory Fund') WHEN 4 THEN '' ELSE CONCAT(s_name, ' regular growth') END AS scheme_name,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE n_name END AS fund_house,
  CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE CONCAT('ING', CAST(s_suppkey AS STRING)) END AS isin_growth, CONCAT('IND', CAST(s_suppkey AS STRING)) AS isin_div_reinvestment
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""),
    "fx_mf_request": (("lineitem", "orders"), """
SELECT o_custkey AS folio_id, CAST(l_suppkey % 8 AS STRING) AS scheme_code, CAST(l_shipdate AS DATE) AS txn_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CASE WHEN l_returnflag = 'R' THEN 'redemption' WHEN l_linestatus = 'F' THEN 'sip' ELSE 'purchase' END AS txn_type, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""),
    "fx_folio": (("customer", "nation"), """
SELECT c_custkey AS folio_id, c_custkey AS customer_id, n_name AS amc_name,
  CASE WHEN c_custkey % 30 = 11 THEN 'closed' ELSE 'active' END AS status
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""),
    "fx_score": (("orders",), """
SELECT o_custkey AS customer_id, o_orderkey AS score_id, CAST(300 + o_orderkey % 601 AS INT) AS score, CAST(o_orderdate AS DATE) AS pull_date
FROM {orders}"""),
    # Deposit movements over the same years as the fund ledger, for wealth and ledgers shared with payments.
    "fx_order_deposit": (("orders",), """
SELECT o_orderkey AS request_id, o_custkey AS account_id, o_orderdate AS txn_datetime, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'debit' ELSE 'credit' END AS dr_cr,
  CAST(o_orderkey AS STRING) AS idempotency_key
FROM {orders}"""),
}


def with_needs(names: list[str]) -> list[str]:
    """The views asked for and those they read, in an order that lets each be defined before its use."""
    ordered: list[str] = []
    for name in names:
        for needed in (*[n for n in VIEWS[name][0] if n in VIEWS], name):
            if needed not in ordered:
                ordered.append(needed)
    return ordered


def plain_sql(name: str) -> str:
    needs, text = VIEWS[name]
    return text.format(**{n: n for n in needs}).strip()
