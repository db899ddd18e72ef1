"""Declared constraints of every table, as SQL predicates. A row breaks a rule when it is false; null passes.

Fixed values: names, enumerations and tolerances of the data model.
"""

from __future__ import annotations

RULES: dict[str, dict[str, str]] = {
    "dim_customer": {
        "customer_type": "customer_type IN ('individual','sme')",
        "kyc_status": "kyc_status IN ('verified','pending','failed')",
        "risk_category": "risk_category IN ('low','medium','high')",
        "segment": "segment IN ('retail','hni','sme')",
        "status": "status IN ('active','dormant','closed')",
    },
    "dim_account": {
        "account_type": "account_type IN ('deposit','card','loan')",
        "status": "status IN ('active','closed','written_off')",
        "closed_has_date": "status <> 'closed' OR close_date IS NOT NULL",
    },
    "deposit_account": {
        "deposit_type": "deposit_type IN ('savings','checking','term','overdraft')",
        "balance_floor": "deposit_type = 'overdraft' OR current_balance >= min_balance OR current_balance >= 0",
        "overdraft_floor": "deposit_type <> 'overdraft' OR current_balance >= -COALESCE(overdraft_limit, 0)",
    },
    "fact_deposit_txn": {
        "amount": "amount > 0",
        "dr_cr": "dr_cr IN ('debit','credit')",
        "channel": "channel IN ('branch','atm','netbanking','mobile','upi')",
    },
    "card_master": {
        "card_type": "card_type IN ('credit','debit','prepaid')",
        "network": "network IN ('visa','mastercard','rupay')",
        "status": "status IN ('active','blocked','expired')",
        "credit_limit": "card_type <> 'credit' OR current_statement_balance <= COALESCE(credit_limit, 0)",
    },
    "fact_card_txn": {
        "amount": "amount > 0",
        "txn_type": "txn_type IN ('purchase','atm','refund','reversal')",
        "entry_mode": "entry_mode IN ('pos','ecom','contactless','atm')",
        "status": "status IN ('approved','declined','reversed')",
    },
    "fact_payment": {
        "beneficiary_type": "beneficiary_type IN ('bank_account','upi','biller','international')",
        "rail": "rail IN ('upi','neft','rtgs','imps','nach','bbps','swift')",
        "amount": "amount > 0",
        "status": "status IN ('initiated','settled','failed','returned')",
    },
    "loan_account": {
        "loan_type": "loan_type IN ('personal','auto','mortgage','sme')",
        "cibil_at_application": "cibil_at_application BETWEEN 300 AND 900",
        "status": "status IN ('active','closed','written_off')",
        "collection_status": "collection_status IN ('in_collections','promise_to_pay')",
        "outstanding": "outstanding_principal >= 0 AND outstanding_principal <= principal",
    },
    "fact_loan_txn": {
        "amount": "amount > 0",
        "txn_type": "txn_type IN ('disbursal','emi','prepayment','charge')",
        "split": "principal_paid + interest_paid <= amount + 0.01",
    },
    "mf_nav_ref": {"nav_value": "nav_value > 0"},
    "fact_mf_nav": {"nav_value": "nav_value > 0"},
    "mf_folio": {"status": "status IN ('active','closed')"},
    "fact_mf_transaction": {
        "txn_type": "txn_type IN ('purchase','redemption','sip','switch_in','switch_out','dividend')",
        "amount": "amount > 0",
        # |units - amount / nav| <= 0.00005, multiplied out so that it stays exact.
        "units": "ABS(units * nav_value - amount) <= 0.00005 * nav_value",
    },
    "mf_holding_current": {
        "units_held": "units_held >= 0",
        "market_value": "ABS(market_value - units_held * nav_value) <= 0.01",
        "unrealised_gain": "ABS(unrealised_gain - (market_value - invested_amount)) <= 0.01",
    },
    "mf_holding_snapshot": {"market_value": "ABS(market_value - units_held * nav_value) <= 0.01"},
    "txn_rejection_log": {
        "source_table": "source_table IN ('fact_deposit_txn','fact_card_txn','fact_payment','fact_loan_txn','fact_mf_transaction')",
        "reason_code": "reason_code IN ('INSUFFICIENT_BALANCE','LIMIT_EXCEEDED','ACCOUNT_CLOSED','NAV_NOT_FOUND','UNITS_EXCEEDED','FK_NOT_FOUND')",
    },
    "credit_bureau_score": {"score": "score BETWEEN 300 AND 900"},
    "loan_delinquency": {"days_past_due": "days_past_due >= 0", "risk_stage": "risk_stage IN (1,2,3)"},
    "customer_wealth_snapshot": {
        "total": "ABS(total_relationship_value - (deposit_balance + mf_aum)) <= 0.01",
    },
    "dim_mf_scheme": {"scheme_code": "scheme_code IS NOT NULL"},
}

# child table, its columns, parent table, its columns
REFERENCES: list[tuple[str, tuple[str, ...], str, tuple[str, ...]]] = [
    ("dim_account", ("customer_id",), "dim_customer", ("customer_id",)),
    ("deposit_account", ("account_id",), "dim_account", ("account_id",)),
    ("fact_deposit_txn", ("account_id",), "deposit_account", ("account_id",)),
    ("card_master", ("account_id",), "dim_account", ("account_id",)),
    ("card_master", ("customer_id",), "dim_customer", ("customer_id",)),
    ("fact_card_txn", ("card_id",), "card_master", ("card_id",)),
    ("fact_payment", ("from_account_id",), "dim_account", ("account_id",)),
    ("loan_account", ("account_id",), "dim_account", ("account_id",)),
    ("loan_account", ("customer_id",), "dim_customer", ("customer_id",)),
    ("fact_loan_txn", ("loan_id",), "loan_account", ("loan_id",)),
    ("mf_folio", ("customer_id",), "dim_customer", ("customer_id",)),
    ("mf_folio", ("settlement_account_id",), "dim_account", ("account_id",)),
    ("fact_mf_transaction", ("folio_id",), "mf_folio", ("folio_id",)),
    ("fact_mf_transaction", ("scheme_code", "nav_date"), "mf_nav_ref", ("scheme_code", "nav_date")),
    ("mf_holding_current", ("folio_id",), "mf_folio", ("folio_id",)),
]
