"""Row-by-row answers on small data, to compare the plans with."""

from __future__ import annotations


def post_deposits(requests: list[dict], accounts: dict[int, dict]) -> dict[int, tuple]:
    """request_id -> (outcome, reason, balance after) by walking all requests in arrival order."""
    rows = sorted(requests, key=lambda r: (r["txn_datetime"], r["request_id"]))
    usable = [r for r in rows if r["amount"] > 0]
    owner = {}
    for r in usable:
        account = accounts.get(r["account_id"])
        if r["idempotency_key"] is not None and account and account["status"] == "active":
            owner.setdefault(r["idempotency_key"], r["account_id"])
    balance = {a: v["current_balance"] for a, v in accounts.items()}
    taken: set = set()
    out = {}
    for r in rows:
        key, account = r["idempotency_key"], accounts.get(r["account_id"])
        if r["amount"] <= 0:
            out[r["request_id"]] = ("quarantined", "INVALID_AMOUNT", None)
        elif account is None:
            out[r["request_id"]] = ("rejected", "FK_NOT_FOUND", None)
        elif account["status"] != "active":
            out[r["request_id"]] = ("rejected", "ACCOUNT_CLOSED", None)
        elif key is not None and owner.get(key, r["account_id"]) != r["account_id"]:
            out[r["request_id"]] = ("quarantined", "KEY_REUSED", None)
        elif key is not None and key in taken:
            out[r["request_id"]] = ("replayed", None, None)
        else:
            overdraft = account["deposit_type"] == "overdraft"
            lowest = -(account["overdraft_limit"] or 0) if overdraft else account["min_balance"]
            now = balance[r["account_id"]]
            after = now - r["amount"] if r["dr_cr"] == "debit" else now + r["amount"]
            if r["dr_cr"] == "debit" and after < lowest:
                out[r["request_id"]] = ("rejected", "LIMIT_EXCEEDED" if overdraft else "INSUFFICIENT_BALANCE", None)
            else:
                balance[r["account_id"]] = after
                if key is not None:
                    taken.add(key)
                out[r["request_id"]] = ("accepted", None, after)
    return out
