"""Requests that arrive after later ones have been posted: only what they touch is settled again.

Balances are kept at the end of every month. An account with a late request goes back to its last such balance from
before that request, and its requests since then are posted once more together with the late ones. Accounts that used
a late request's idempotency key are touched too, as the key may change hands. Everything else stays as it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import posting

REQUEST = ["request_id", "account_id", "txn_datetime", "amount", "dr_cr", "channel", "idempotency_key"]


def _month(column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), "month")


def month_balances(posted: DataFrame) -> DataFrame:
    """account_id, month, balance: after an account's last accepted request of every month in which it has one."""
    last = F.max(F.struct("txn_datetime", "request_id", "running_balance"))["running_balance"].alias("balance")
    return posting.accepted(posted).groupBy("account_id", _month("txn_datetime").alias("month")).agg(last)


def touched(posted: DataFrame, late: DataFrame) -> DataFrame:
    """account_id and ``since``, the first month that has to be settled again."""
    own = late.select("account_id", F.col("txn_datetime").alias("at"))
    # A key with a late use may belong to another account from then on.
    keys = late.where("idempotency_key is not null").groupBy(F.col("idempotency_key").alias("_key")).agg(F.count("*").alias("_n"))
    others = posted.join(keys, F.col("idempotency_key") == F.col("_key"), "left_semi").select("account_id", F.col("txn_datetime").alias("at"))
    return own.unionByName(others).where("account_id is not null").groupBy("account_id").agg(_month_of_first())


def _month_of_first() -> Column:
    return F.trunc(F.min("at").cast("date"), "month").alias("since")


def resettle(posted: DataFrame, late: DataFrame, accounts: DataFrame, balances: DataFrame | None = None, **kw) -> DataFrame:
    """Late requests and all that follow them on the same accounts, posted in order; like ``post_deposit_txn``.

    ``posted``: what has been posted so far, without the late requests. ``balances``: :func:`month_balances` of it.
    The result replaces the rows of ``posted`` with the same request_id.
    """
    since = touched(posted, late)
    balances = month_balances(posted) if balances is None else balances
    earlier = balances.join(since, "account_id").where("month < since").groupBy("account_id").agg(
        F.max(F.struct("month", "balance"))["balance"].alias("_balance"))
    opening = accounts.join(since.select("account_id"), "account_id", "left_semi").join(earlier, "account_id", "left").withColumn(
        "current_balance", F.coalesce("_balance", "current_balance")).drop("_balance")
    mine = posted.join(since, "account_id")
    again = mine.where(_month("txn_datetime") >= F.col("since")).select(*REQUEST)
    wanted = again.unionByName(late.select(*REQUEST)).where("idempotency_key is not null").select("idempotency_key").distinct()
    # Whoever may post with a key owns it, also after a refusal; requests under another's key have been quarantined.
    stays = posted.join(since, "account_id", "left").where(F.col("since").isNull() | (_month("txn_datetime") < F.col("since")))
    owners = stays.where("outcome in ('accepted', 'rejected', 'replayed') and coalesce(reason_code, '') not in ('FK_NOT_FOUND', 'ACCOUNT_CLOSED')")
    history = owners.join(wanted, "idempotency_key", "left_semi").groupBy("idempotency_key").agg(
        F.min("account_id").alias("account_id"), F.some(F.col("outcome") == "accepted").alias("accepted"))
    return posting.post_deposit_txn(again.unionByName(late.select(*REQUEST)), opening, history, **kw)


def replaced(posted: DataFrame, redone: DataFrame) -> DataFrame:
    """``posted`` with the rows that were settled again in place of the old ones."""
    columns = [c for c in posted.columns if c in redone.columns]
    parts = [posted.join(redone.select("request_id"), "request_id", "left_anti").select(*columns), redone.select(*columns)]
    return reduce(lambda a, b: a.unionByName(b), parts)
