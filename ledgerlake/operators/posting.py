"""Posting of money movements against balances, in arrival order, with accept or reject.

Each ledger is brought to one form. A key has ``room``: what may still be used. A request changes it by
``move`` and is refused when fewer than ``need`` are left (null: never refused). Then

1. stateless checks come from joins and never touch the room;
2. a running sum gives the room if nothing were refused. Up to a key's first request that falls short,
   that is the true answer, all in window functions;
3. only from the first shortfall on is a sequential walk needed. The window leaves the rows of a key
   together and in order, so the walk streams over Arrow batches with a few scalars of state, and rows
   before a shortfall pass it as whole columns. Everything of a key happens in one shuffle and one sort;
4. hot keys are cut into slots, ranges of their order, and all slots are settled in parallel, see ``settlement``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import (
    MONEY, cents, from_cents, from_unit_ticks, interchange_fee, market_value, reward_points, unit_ticks, units_for,
)
from ..functions.text import stable_id
from ..session import durable
from .ordered import MAX_GROUP_ROWS, Running, hot_keys, running_in_slots, split_hot
from .rules import RULES
from .settlement import ACCEPTED, REFUSED, REPEATED, WALK_ONLY, settle_in_slots

_BEGIN = Window.unboundedPreceding
DETECT = object()

# Reason codes of the rejection log, then those that only quarantine a request.
REASONS = ("INSUFFICIENT_BALANCE", "LIMIT_EXCEEDED", "ACCOUNT_CLOSED", "NAV_NOT_FOUND", "UNITS_EXCEEDED", "FK_NOT_FOUND")
QUARANTINE_REASONS = ("INVALID_AMOUNT", "INVALID_VALUE", "KEY_REUSED")


@dataclass(frozen=True)
class Ledger:
    """How one kind of request maps onto room, move and need.

    ``terms`` turns the request joined with its state row into the same rows plus ``_reason`` (string),
    ``_opening``, ``_move`` and ``_need`` (long).
    """

    fact: str
    prefix: str
    keys: Sequence[str]
    order: Sequence[str]
    terms: Callable[[DataFrame], DataFrame]
    may_post: Callable[[DataFrame], DataFrame] = field(default=lambda state: state)
    refusal_is_fact: bool = False
    # State columns that have done their work once the terms are there; they are not carried any further.
    state_only: Sequence[str] = ()
    # Columns whose declared rule a request must meet; those it must meet if it has a value; numbers that must be there.
    required: Sequence[str] = ()
    optional: Sequence[str] = ()
    numbers: Sequence[str] = ()


# --- the walk -------------------------------------------------------------------------------------


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Accept or refuse in order. The first short row (``_shorts`` is 1) of a key starts from the room known there."""
    room, tally, retryable = 0, 0, set()
    for batch in batches:
        def column(name):
            return batch.column(batch.schema.get_field_index(name))

        short, shorts = (column(c).to_numpy(zero_copy_only=False) for c in ("_short", "_shorts"))
        first, known = (column(c).to_numpy(zero_copy_only=False) for c in ("_first", "_room"))
        with_tally = "_paid" in batch.schema.names
        codes, rooms = np.where(first, ACCEPTED, REPEATED).astype(np.int32), known.copy()
        tallies = column("_tally").to_numpy(zero_copy_only=False).copy() if with_tally else None
        walk = np.flatnonzero(shorts > 0)
        if len(walk):
            at = pa.array(walk)
            needs, repeats = column("_need").take(at).to_pylist(), column("_repeat").take(at).to_pylist()
            moves = column("_move").take(at).to_pylist()
            paid = column("_paid").take(at).to_pylist() if with_tally else moves
            before = column("_tally_before").take(at).to_pylist() if with_tally else moves
            starts = (short[walk] & (shorts[walk] == 1)).tolist()
            for i, row in enumerate(walk.tolist()):
                if starts[i]:
                    room, tally, retryable = int(known[row]), before[i], set()
                rooms[row] = room
                if not first[row] and repeats[i] not in retryable:
                    codes[row] = REPEATED
                elif needs[i] is not None and room < needs[i]:
                    codes[row] = REFUSED
                    if repeats[i] is not None:
                        retryable.add(repeats[i])
                else:
                    codes[row] = ACCEPTED
                    room += moves[i]
                    tally = max(0, tally + paid[i])
                    retryable.discard(repeats[i])
                if with_tally:
                    tallies[row] = tally
        names = [n for n in batch.schema.names if n not in WALK_ONLY]
        arrays = [column(n) for n in names] + [pa.array(codes), pa.array(rooms)]
        names += ["_code", "_room"]
        if with_tally:
            arrays.append(pa.array(tallies))
            names.append("_tally")
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def settle(moves: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_code`` and ``_room`` (before the request) to every row; keys are small enough for one task.

    Needs ``_opening``, ``_move``, ``_need``, ``_first`` (not a repeat of an earlier request) and
    ``_repeat`` (its idempotency key when it is used more than once). With ``_paid`` and ``_paid_in`` there
    is a second running value, ``_tally``: the sum of ``_paid`` over accepted rows, never below zero.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    earlier, so_far = window.rowsBetween(_BEGIN, -1), window.rowsBetween(_BEGIN, 0)
    used = F.sum(F.when(F.col("_first"), F.col("_move"))).over(earlier)
    walked = (
        moves.withColumn("_room", F.col("_opening") + F.coalesce(used, F.lit(0)))
        .withColumn("_short", F.coalesce(F.col("_first") & (F.col("_room") < F.col("_need")), F.lit(False)))
        .withColumn("_shorts", F.sum(F.col("_short").cast("int")).over(so_far))
    )
    if "_paid" in moves.columns:
        paid = F.sum(F.when(F.col("_first"), F.col("_paid")).otherwise(F.lit(0))).over(so_far)
        walked = walked.withColumn("_paid_sum", F.col("_paid_in") + paid)
        lifted = walked.select(
            "*", F.min("_paid_sum").over(so_far).alias("_low"), F.min("_paid_sum").over(earlier).alias("_low_before"),
            F.lag("_paid_sum").over(window).alias("_sum_before"),
        )
        walked = lifted.select(
            *[c for c in walked.columns if c != "_paid_sum"],
            (F.col("_paid_sum") - F.least(F.lit(0), F.col("_low"))).alias("_tally"),
            F.coalesce(F.col("_sum_before") - F.least(F.lit(0), F.col("_low_before")), F.col("_paid_in")).alias("_tally_before"),
        )
    fields = [f for f in walked.schema.fields if f.name not in WALK_ONLY]
    fields += [T.StructField("_code", T.IntegerType()), T.StructField("_room", T.LongType())]
    if "_paid" in moves.columns:
        fields.append(T.StructField("_tally", T.LongType()))
    return walked.mapInArrow(_walk, T.StructType(fields))


# --- a second running value of hot keys ------------------------------------------------------------


def _tallied(settled: DataFrame, keys, order) -> DataFrame:
    """``_tally`` of settled hot keys, by the same closed form as floored_sum but with an opening value.

    It runs over the ranges in which the rows were settled, however many of them share a day.
    """
    taken = F.when(F.col("_code") == ACCEPTED, F.col("_paid")).otherwise(F.lit(0))
    rows = running_in_slots(settled.withColumn("_taken", taken), keys, [*order, "_tie"], {"_sum": Running("sum", "_taken")})
    rows = running_in_slots(rows.withColumn("_sum", F.col("_sum") + F.col("_paid_in")), keys, [*order, "_tie"], {"_low": Running("min", "_sum")})
    return rows.withColumn("_tally", F.col("_sum") - F.least(F.lit(0), F.col("_low"))).drop("_taken", "_sum", "_low", "_paid_in")


# --- idempotency ----------------------------------------------------------------------------------


def mark_repeats(requests: DataFrame, ledger: Ledger, state: DataFrame) -> DataFrame:
    """Add ``_first``, ``_repeat`` and ``_reused`` from idempotency keys used more than once.

    A key belongs to the account of its first postable request; its use on another account is ``_reused``.
    Null keys never repeat; they get a value of their own in the join so that they do not meet in one task.
    """
    if "idempotency_key" not in requests.columns:
        return requests.select(
            "*", F.lit(True).alias("_first"), F.lit(None).cast("string").alias("_repeat"), F.lit(False).alias("_reused")
        )
    keys, order = list(ledger.keys), list(ledger.order)
    sound = (F.col("amount") > 0) & well_formed(requests, ledger)
    postable = requests.where(F.col("idempotency_key").isNotNull() & sound).join(
        ledger.may_post(state).select(*keys), keys, "left_semi"
    )
    shared = postable.groupBy("idempotency_key").agg(
        F.count(F.lit(1)).alias("_uses"), F.min(F.struct(*order, *keys)).alias("_origin")
    ).where("_uses > 1").select(F.col("idempotency_key").alias("_shared_key"), "_origin")
    alone = F.concat_ws("|", F.lit("\u0000"), *[F.col(c).cast("string") for c in order])
    marked = requests.withColumn("_join_key", F.coalesce("idempotency_key", alone)).join(
        shared, F.col("_join_key") == F.col("_shared_key"), "left"
    )
    known = F.col("_origin").isNotNull()
    here = F.struct(*keys) == F.struct(*[F.col(f"_origin.{k}").alias(k) for k in keys])
    is_origin = F.struct(*order) == F.struct(*[F.col(f"_origin.{c}").alias(c) for c in order])
    usable = F.coalesce(sound, F.lit(False))
    first = ~known | ~usable | is_origin
    retry_key = F.lit(None).cast("string") if ledger.refusal_is_fact else F.when(known & usable, F.col("idempotency_key"))
    return marked.select(
        *requests.columns,
        F.coalesce(first, F.lit(True)).alias("_first"),
        retry_key.alias("_repeat"),
        F.coalesce(known & ~here, F.lit(False)).alias("_reused"),
    )


def match_history(requests: DataFrame, ledger: Ledger, history: DataFrame | None) -> DataFrame:
    """Flag requests whose idempotency key is already a fact: ``_posted`` here, ``_reused_before`` elsewhere.

    A column ``accepted`` of ``history`` may say that a key only has an owner so far and may be tried again by it.
    """
    if history is None or "idempotency_key" not in requests.columns:
        return requests.select("*", F.lit(False).alias("_posted"), F.lit(False).alias("_reused_before"))
    keys = list(ledger.keys)
    past = history.where(F.col("idempotency_key").isNotNull()).select(
        F.col("idempotency_key").alias("_past_key"), F.struct(*keys).alias("_past_owner"),
        (F.col("accepted") if "accepted" in history.columns else F.lit(True)).alias("_past_fact"),
    )
    alone = F.concat_ws("|", F.lit("\u0000"), *[F.col(c).cast("string") for c in ledger.order])
    joined = requests.withColumn("_join_key", F.coalesce("idempotency_key", alone)).join(
        past, F.col("_join_key") == F.col("_past_key"), "left"
    )
    found, same = F.col("_past_key").isNotNull(), F.col("_past_owner") == F.struct(*keys)
    return joined.select(
        *requests.columns,
        F.coalesce(found & same & F.col("_past_fact"), F.lit(False)).alias("_posted"),
        F.coalesce(found & ~same, F.lit(False)).alias("_reused_before"),
    )


# --- the common posting plan ----------------------------------------------------------------------


def post(
    requests: DataFrame,
    state: DataFrame,
    ledger: Ledger,
    history: DataFrame | None = None,
    hot=DETECT,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every request with ``outcome``, ``_reason``, ``_room`` before it, and its stable ``txn_id``.

    outcome is accepted, rejected, replayed (a repeat of an accepted request) or quarantined. Of several state rows of a
    key the largest counts, so that no request is doubled.
    """
    keys, order = list(ledger.keys), list(ledger.order)
    rest = [c for c in state.columns if c not in keys]
    state = state.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_state")).select(*keys, "_state.*")
    homeless = F.lit(False)
    for key in keys:
        homeless = homeless | F.col(key).isNull()
    unplaced = _unplaced(requests.where(homeless), state, ledger)
    requests = requests.where(~homeless)
    if hot is DETECT:
        hot = hot_keys(requests, keys, max_rows)
    marked = match_history(mark_repeats(requests, ledger, state), ledger, history)
    if hot is None:
        settled = settle(_with_terms(marked.join(state, keys, "left"), ledger), keys, order)
    else:
        ordinary, heavy = split_hot(marked, keys, hot)
        # One state row per hot key: bounded as the hot keys are.
        few = state.join(F.broadcast(hot), keys, "left_semi")
        heavy_moves = _with_terms(heavy.join(F.broadcast(few), keys, "left"), ledger)
        slotted = settle_in_slots(heavy_moves, keys, order, max_rows)
        if "_paid" in heavy_moves.columns:
            slotted = _tallied(durable(slotted), keys, order)
        slotted = slotted.drop("_slot", "_tie")
        settled = settle(_with_terms(ordinary.join(state, keys, "left"), ledger), keys, order).unionByName(slotted)
    settled = settled.unionByName(unplaced.select(*settled.columns))
    identity = [F.lit(ledger.fact), *[F.col(k) for k in keys]]
    if "idempotency_key" in requests.columns:
        own = F.concat_ws("|", *[F.col(c).cast("string") for c in order])
        identity.append(F.coalesce(F.col("idempotency_key"), own))
    else:
        identity.extend(F.col(c) for c in order)
    outcome = (
        F.when(F.col("_reason").isin(*QUARANTINE_REASONS), "quarantined")
        .when(F.col("_posted"), "replayed")
        .when(F.col("_reason").isNotNull(), "rejected")
        .when(F.col("_code") == ACCEPTED, "accepted")
        .when(F.col("_code") == REPEATED, "replayed")
        .otherwise("rejected")
    )
    return settled.select("*", outcome.alias("outcome"), stable_id(ledger.prefix, *identity).alias("txn_id"))


def _unplaced(requests: DataFrame, state: DataFrame, ledger: Ledger) -> DataFrame:
    """Requests without a key belong to no account. They would all meet in one task, so they stay where they are."""
    rows = requests.select(
        "*", F.lit(True).alias("_first"), F.lit(None).cast("string").alias("_repeat"),
        *[F.lit(False).alias(c) for c in ("_reused", "_posted", "_reused_before")],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in state.schema.fields if f.name not in ledger.keys],
    )
    return _with_terms(rows, ledger).select(
        "*", F.lit(REFUSED).alias("_code"), F.lit(0).cast("long").alias("_room"), F.lit(0).cast("long").alias("_tally")
    )


def well_formed(requests: DataFrame, ledger: Ledger) -> Column:
    """Do a request's declared values hold? Required ones must be there, optional ones may be null."""
    good = F.lit(True)
    for column, rule in RULES[ledger.fact].items():
        if column in ledger.required or (column in ledger.optional and column in requests.columns):
            holds = F.expr(rule)
            good = good & F.coalesce(holds, F.lit(column not in ledger.required))
    for column in ledger.numbers:
        good = good & F.col(column).isNotNull()
    return good


def _with_terms(joined: DataFrame, ledger: Ledger) -> DataFrame:
    """Apply the ledger's terms, then the checks common to all ledgers."""
    rows = ledger.terms(joined)
    reason = (
        F.when(~F.coalesce(F.col("amount") > 0, F.lit(False)), "INVALID_AMOUNT")
        .when(~well_formed(joined, ledger), "INVALID_VALUE")
        .when(F.col("_reason").isNotNull(), F.col("_reason"))
        .when(F.col("_reused") | F.col("_reused_before"), "KEY_REUSED")
    )
    rows = rows.withColumn("_reason", reason).drop(*ledger.state_only)
    live = F.col("_reason").isNull() & ~F.col("_posted")
    return (
        rows.withColumn("_opening", F.coalesce(F.col("_opening"), F.lit(0)).cast("long"))
        .withColumn("_move", F.when(live, F.col("_move")).otherwise(F.lit(0)).cast("long"))
        .withColumn("_need", F.when(live, F.col("_need")).cast("long"))
        .withColumns({"_paid": F.when(live, F.col("_paid")).otherwise(F.lit(0))} if "_paid" in rows.columns else {})
    )


def _room_after() -> Column:
    return F.col("_room") + F.when(F.col("outcome") == "accepted", F.col("_move")).otherwise(F.lit(0))


def _finish(posted: DataFrame, requests: DataFrame, reason: Column, **extra: Column) -> DataFrame:
    refused = (F.col("outcome") == "rejected") & F.col("_reason").isNull()
    return posted.select(
        *requests.columns, "txn_id", "outcome",
        F.when(refused, reason).otherwise(F.col("_reason")).alias("reason_code"),
        *[column.alias(name) for name, column in extra.items()],
    )


# --- the five ledgers -----------------------------------------------------------------------------


def _deposit_terms(joined: DataFrame) -> DataFrame:
    overdraft = F.col("deposit_type") == "overdraft"
    lowest = F.when(overdraft, -F.coalesce(cents(F.col("overdraft_limit")), F.lit(0))).otherwise(
        cents(F.col("min_balance"))
    )
    debit = F.col("dr_cr") == "debit"
    amount = cents(F.col("amount"))
    return joined.select(
        "*",
        F.when(F.col("status").isNull(), "FK_NOT_FOUND").when(F.col("status") != "active", "ACCOUNT_CLOSED").alias("_reason"),
        (cents(F.col("current_balance")) - lowest).alias("_opening"),
        F.when(debit, -amount).otherwise(amount).alias("_move"),
        F.when(debit, amount).alias("_need"),
        lowest.alias("_lowest"),
    )


DEPOSIT = Ledger(
    "fact_deposit_txn", "DTXN_", ("account_id",), ("txn_datetime", "request_id"),
    _deposit_terms, lambda state: state.where("status = 'active'"),
    state_only=("current_balance", "min_balance", "overdraft_limit", "status"), required=("dr_cr",), optional=("channel",),
)


def post_deposit_txn(requests: DataFrame, accounts: DataFrame, history=None, hot=DETECT, max_rows=MAX_GROUP_ROWS):
    """Debits and credits against deposit accounts.

    ``accounts``: account_id, deposit_type, current_balance, min_balance, overdraft_limit, status.
    Adds outcome, reason_code, txn_id and running_balance (after an accepted request).
    """
    state = accounts.select("account_id", "deposit_type", "current_balance", "min_balance", "overdraft_limit", "status")
    posted = post(requests, state, DEPOSIT, history, hot, max_rows)
    reason = F.when(F.col("deposit_type") == "overdraft", "LIMIT_EXCEEDED").otherwise("INSUFFICIENT_BALANCE")
    balance = F.when(F.col("outcome") == "accepted", from_cents(_room_after() + F.col("_lowest")))
    return _finish(posted, requests, reason, running_balance=balance)


def _card_terms(joined: DataFrame) -> DataFrame:
    spend = F.col("txn_type").isin("purchase", "atm")
    amount = cents(F.col("amount"))
    limit = F.coalesce(cents(F.col("credit_limit")), F.lit(0))
    return joined.select(
        "*",
        F.when(F.col("status").isNull(), "FK_NOT_FOUND").when(F.col("status") != "active", "ACCOUNT_CLOSED").alias("_reason"),
        (limit - cents(F.col("current_statement_balance"))).alias("_opening"),
        F.when(spend, -amount).otherwise(amount).alias("_move"),
        F.when(spend, amount).alias("_need"),
        limit.alias("_limit"),
    )


CARD = Ledger(
    "fact_card_txn", "CTXN_", ("card_id",), ("txn_datetime", "request_id"),
    _card_terms, refusal_is_fact=True, state_only=("credit_limit", "current_statement_balance", "status"),
    required=("txn_type",), optional=("entry_mode",),
)


def post_card_txn(requests: DataFrame, cards: DataFrame, history=None, hot=DETECT, max_rows=MAX_GROUP_ROWS):
    """Card transactions against a credit limit; a declined one is a fact too.

    ``cards``: card_id, credit_limit, current_statement_balance, status. Adds outcome, reason_code, txn_id,
    txn_status (approved or declined, null when no fact exists), statement_balance after it, and interchange_fee and
    reward_points of an approved purchase.
    """
    state = cards.select("card_id", "credit_limit", "current_statement_balance", "status")
    posted = post(requests, state, CARD, history, hot, max_rows)
    status = F.when(F.col("outcome") == "accepted", "approved").when(
        (F.col("outcome") == "rejected") & ~F.coalesce(F.col("_reason") == "FK_NOT_FOUND", F.lit(False)), "declined"
    )
    balance = F.when(F.col("outcome") == "accepted", from_cents(F.col("_limit") - _room_after()))
    done, kind = F.col("outcome") == "accepted", F.col("txn_type")
    return _finish(
        posted, requests, F.lit("LIMIT_EXCEEDED"), txn_status=status, statement_balance=balance,
        interchange_fee=F.when(done, interchange_fee(F.col("amount"), kind)), reward_points=F.when(done, reward_points(F.col("amount"), kind)),
    )


def _payment_terms(joined: DataFrame) -> DataFrame:
    kind = F.col("account_type")
    amount = cents(F.col("amount"))
    deposit_floor = F.when(
        F.col("deposit_type") == "overdraft", -F.coalesce(cents(F.col("overdraft_limit")), F.lit(0))
    ).otherwise(cents(F.col("min_balance")))
    card_limit = F.coalesce(cents(F.col("credit_limit")), F.lit(0))
    room = F.when(kind == "deposit", cents(F.col("balance")) - deposit_floor).when(
        kind == "card", card_limit - cents(F.col("balance"))
    )
    return joined.select(
        "*",
        F.when(F.col("status").isNull(), "FK_NOT_FOUND")
        .when((F.col("status") != "active") | ~kind.isin("deposit", "card"), "ACCOUNT_CLOSED")
        .alias("_reason"),
        room.alias("_opening"), (-amount).alias("_move"), amount.alias("_need"),
        deposit_floor.alias("_lowest"), card_limit.alias("_limit"),
    )


PAYMENT = Ledger(
    "fact_payment", "PAY_", ("from_account_id",), ("payment_datetime", "request_id"),
    _payment_terms, lambda state: state.where("status = 'active' and account_type in ('deposit', 'card')"),
    state_only=("balance", "min_balance", "overdraft_limit", "deposit_type", "credit_limit", "status"), optional=("rail", "beneficiary_type"),
)


def payment_sources(accounts: DataFrame, deposits: DataFrame, cards: DataFrame) -> DataFrame:
    """One balance row per account of any kind: the deposit balance or the card statement.

    The kind decides which of the two tables an account reads, so they are stacked and joined once.
    """
    deposit_rows = deposits.select(
        "account_id", F.lit("deposit").alias("account_type"), F.col("current_balance").alias("balance"),
        "min_balance", "overdraft_limit", "deposit_type", F.lit(None).cast(MONEY).alias("credit_limit"),
    )
    # An account with several cards pays as far as the card with the least room allows.
    room = F.coalesce(F.col("credit_limit"), F.lit(0)) - F.col("current_statement_balance")
    tightest = F.min(F.struct(room.alias("room"), F.col("current_statement_balance"), F.col("credit_limit"))).alias("card")
    card_rows = cards.groupBy("account_id").agg(tightest).select("account_id", "card.current_statement_balance", "card.credit_limit").select(
        "account_id", F.lit("card").alias("account_type"), F.col("current_statement_balance").alias("balance"),
        F.lit(None).cast(MONEY).alias("min_balance"), F.lit(None).cast(MONEY).alias("overdraft_limit"),
        F.lit(None).cast("string").alias("deposit_type"), "credit_limit",
    )
    return accounts.select("account_id", "account_type", "status").join(
        deposit_rows.unionByName(card_rows), ["account_id", "account_type"], "left"
    )


def post_payment(requests: DataFrame, sources: DataFrame, history=None, hot=DETECT, max_rows=MAX_GROUP_ROWS):
    """Payments from deposit accounts (balance falls) or cards (statement rises).

    ``sources`` comes from :func:`payment_sources`. Adds outcome, reason_code, txn_id and balance_after.
    """
    state = sources.withColumnRenamed("account_id", "from_account_id")
    posted = post(requests, state, PAYMENT, history, hot, max_rows)
    reason = F.when(F.col("account_type") == "card", "LIMIT_EXCEEDED").otherwise("INSUFFICIENT_BALANCE")
    after = F.when(F.col("account_type") == "deposit", _room_after() + F.col("_lowest")).otherwise(
        F.col("_limit") - _room_after()
    )
    return _finish(
        posted, requests, reason, balance_after=F.when(F.col("outcome") == "accepted", from_cents(after)),
        status=F.when(F.col("outcome") == "accepted", "settled"),
    )


def _loan_terms(joined: DataFrame) -> DataFrame:
    principal = cents(F.col("principal_paid"))
    return joined.select(
        "*",
        F.when(F.col("status").isNull(), "FK_NOT_FOUND")
        .when(F.col("status").isin("closed", "written_off"), "ACCOUNT_CLOSED").alias("_reason"),
        cents(F.col("outstanding_principal")).alias("_opening"),
        (-principal).alias("_move"),
        F.when(F.col("txn_type") == "prepayment", F.greatest(cents(F.col("amount")), principal))
        .otherwise(principal).alias("_need"),
    )


def loan_ledger(order: Sequence[str]) -> Ledger:
    return Ledger(
        "fact_loan_txn", "LTXN_", ("loan_id",), tuple(order), _loan_terms,
        lambda state: state.where("status not in ('closed', 'written_off')"),
        state_only=("outstanding_principal", "status"), required=("txn_type",), numbers=("principal_paid",),
    )


def post_loan_txn(
    requests: DataFrame, loans: DataFrame, order: Sequence[str] = ("txn_date", "request_id"),
    history=None, hot=DETECT, max_rows=MAX_GROUP_ROWS,
):
    """Instalments and prepayments against the outstanding principal.

    ``loans``: loan_id, outstanding_principal, status. Adds outcome, reason_code, txn_id and outstanding_after.
    """
    state = loans.select("loan_id", "outstanding_principal", "status")
    posted = post(requests, state, loan_ledger(order), history, hot, max_rows)
    too_large = (F.col("txn_type") == "prepayment") & (cents(F.col("amount")) > F.col("_room"))
    reason = F.when(too_large, "INSUFFICIENT_BALANCE").otherwise("LIMIT_EXCEEDED")
    after = F.when(F.col("outcome") == "accepted", from_cents(_room_after()))
    return _finish(posted, requests, reason, outstanding_after=after)


def _fund_terms(joined: DataFrame) -> DataFrame:
    units = unit_ticks(F.col("units"))
    sell = F.col("txn_type").isin("redemption", "switch_out")
    return joined.select(
        "*",
        F.when(F.col("folio_status").isNull(), "FK_NOT_FOUND")
        .when(F.col("folio_status") != "active", "ACCOUNT_CLOSED")
        .when(F.col("nav_value").isNull(), "NAV_NOT_FOUND").alias("_reason"),
        F.coalesce(unit_ticks(F.col("held_before")), F.lit(0)).alias("_opening"),
        F.when(sell, -units).otherwise(units).alias("_move"),
        F.when(sell, units).alias("_need"),
        # Selling takes the amount off the invested sum, but never below zero.
        F.when(sell, -cents(F.col("amount"))).otherwise(cents(F.col("amount"))).alias("_paid"),
        F.coalesce(cents(F.col("invested_before")), F.lit(0)).alias("_paid_in"),
    )


def fund_ledger(order: Sequence[str]) -> Ledger:
    return Ledger(
        "fact_mf_transaction", "MFTXN_", ("folio_id", "scheme_code"), tuple(order), _fund_terms,
        state_only=("held_before", "invested_before", "folio_status"), required=("txn_type",),
    )


def post_mf_transaction(
    requests: DataFrame, folios: DataFrame, nav: DataFrame, holdings: DataFrame | None = None,
    order: Sequence[str] = ("txn_date", "request_id"), history=None, hot=DETECT, max_rows=MAX_GROUP_ROWS,
):
    """Fund purchases and redemptions at the exact NAV of ``nav_date``.

    ``folios``: folio_id, status; ``nav``: scheme_code, nav_date, nav_value; ``holdings``: folio_id,
    scheme_code, units_held, invested_amount. Adds outcome, reason_code, txn_id, nav_value, units, and the
    holding after an accepted request: units_held, invested_amount, market_value, unrealised_gain.
    """
    keys = ["folio_id", "scheme_code"]
    # Prices come first: the join by folio then leaves the rows as the window by folio and scheme needs them.
    priced = (
        requests.join(nav.select("scheme_code", "nav_date", "nav_value"), ["scheme_code", "nav_date"], "left")
        .join(folios.select("folio_id", F.col("status").alias("folio_status")), "folio_id", "left")
        .withColumn("units", units_for(F.col("amount"), F.col("nav_value")))
    )
    if hot is DETECT:
        hot = hot_keys(requests, keys, max_rows)
    if holdings is None:
        # No rows: the optimizer drops the join with it.
        holdings = requests.select(*keys).where(F.lit(False)).select(
            "*", F.lit(0).cast("decimal(18,5)").alias("units_held"), F.lit(0).cast(MONEY).alias("invested_amount")
        )
    state = holdings.select(
        *keys, F.col("units_held").alias("held_before"), F.col("invested_amount").alias("invested_before")
    )
    ledger = fund_ledger(order)
    if "idempotency_key" in requests.columns:
        ledger = _with_fund_owners(ledger, priced, keys)
    posted = post(priced, state, ledger, history, hot, max_rows)
    done = F.col("outcome") == "accepted"
    held = from_unit_ticks(_room_after())
    worth, invested = market_value(held, F.col("nav_value")), from_cents(F.col("_tally"))
    return _finish(
        posted, requests, F.lit("UNITS_EXCEEDED"), nav_value=F.col("nav_value"), units=F.col("units"),
        units_held=F.when(done, held), invested_amount=F.when(done, invested), market_value=F.when(done, worth),
        unrealised_gain=F.when(done, (worth - invested).cast(MONEY)),
    )


def _with_fund_owners(ledger: Ledger, priced: DataFrame, keys: list[str]) -> Ledger:
    """Only a request on an open folio with a known price can own an idempotency key."""
    owners = priced.where((F.col("folio_status") == "active") & F.col("nav_value").isNotNull()).select(*keys).distinct()
    return replace(ledger, may_post=lambda _: owners)


# --- what posting leaves behind -------------------------------------------------------------------


def accepted(posted: DataFrame) -> DataFrame:
    return posted.where("outcome = 'accepted'")


def rejection_log(posted: DataFrame, ledger: Ledger, at: str) -> DataFrame:
    """Rows of the rejection log from one posted batch."""
    owner = F.col(ledger.keys[0]).cast("string")
    key = F.col("idempotency_key") if "idempotency_key" in posted.columns else F.lit(None).cast("string")
    identity = [F.lit(ledger.fact), *[F.col(c) for c in (*ledger.keys, *ledger.order)]]
    return posted.where("outcome = 'rejected'").select(
        stable_id("REJ_", *identity).alias("rejection_id"),
        F.lit(ledger.fact).alias("source_table"),
        F.col("txn_id").alias("attempted_key"),
        owner.alias("account_or_folio_id"),
        F.col("amount"), "reason_code",
        F.col(at).cast("timestamp_ntz").alias("rejected_at"),
        key.alias("idempotency_key"),
    )


def rejection_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("source_table", "reason_code").agg(
        F.count(F.lit(1)).alias("n_rejected"), F.sum("amount").alias("amount")
    )


def closing_balances(posted: DataFrame, accounts: DataFrame, ledger: Ledger, balance: str) -> DataFrame:
    """Balance of every account after the batch: the last accepted row's, else the one it had."""
    keys, order = list(ledger.keys), list(ledger.order)
    last = accepted(posted).groupBy(*keys).agg(
        F.max(F.struct(*order, F.col(balance).alias("_b")))["_b"].alias("_last")
    )
    return accounts.join(last, keys, "left")


def reconcile_deposits(posted: DataFrame, accounts: DataFrame) -> DataFrame:
    """Opening balance plus accepted movements against the balance stored with the last of them."""
    moved = accepted(posted).groupBy("account_id").agg(
        F.sum(F.when(F.col("dr_cr") == "debit", -F.col("amount")).otherwise(F.col("amount"))).alias("net_accepted"),
        F.max(F.struct("txn_datetime", "request_id", "running_balance"))["running_balance"].alias("_stored"),
    )
    joined = accounts.join(moved, "account_id", "left")
    net = F.coalesce(F.col("net_accepted").cast(MONEY), F.lit(0).cast(MONEY))
    computed = (F.col("current_balance") + net).cast(MONEY)
    stored = F.coalesce(F.col("_stored"), F.col("current_balance"))
    return joined.select(
        "account_id", F.col("current_balance").alias("opening_balance"), net.alias("net_accepted"),
        stored.alias("closing_balance"), (computed == stored).alias("reconciled"),
    )


def current_holdings(posted: DataFrame, order: Sequence[str]) -> DataFrame:
    """Holding per folio and scheme after its last accepted request (last posted, not latest NAV)."""
    values = ["units_held", "invested_amount", "nav_value", "market_value", "unrealised_gain"]
    top = accepted(posted).groupBy("folio_id", "scheme_code").agg(
        F.max(F.struct(*order, F.struct("txn_date", *values).alias("_v")))["_v"].alias("_v")
    )
    return top.select("folio_id", "scheme_code", F.col("_v.txn_date").alias("as_of_date"), *[f"_v.{c}" for c in values])


def unified_requests(deposits: DataFrame, payments: DataFrame) -> DataFrame:
    """Deposit movements and payments out of deposit accounts as one request stream.

    Posted together they share one running balance, which two separate ledgers do not.
    """
    left = deposits.select(
        "account_id", "txn_datetime", F.struct(F.lit("deposit").alias("source"), F.col("request_id").alias("id")).alias("request_id"),
        "amount", "dr_cr",
    )
    right = payments.select(
        F.col("from_account_id").alias("account_id"), F.col("payment_datetime").alias("txn_datetime"),
        F.struct(F.lit("payment").alias("source"), F.col("request_id").alias("id")).alias("request_id"),
        "amount", F.lit("debit").alias("dr_cr"),
    )
    return left.unionByName(right)
