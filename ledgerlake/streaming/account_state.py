"""Deposit requests posted as they arrive, with what is known of an account and of an idempotency key kept from batch to batch.

A key belongs to the account of its first usable request. An account has a balance, the time of its last posting and what
became of its keys, so a micro-batch reads the files that have landed and its own keys' and accounts' state, and no earlier
result. A landed backlog is settled set by set: who owns a key and what the account opens with come from one shuffle each,
the rest is the walk of ``operators.posting``; the state lies in ``state_table``. Where a trigger finds a few rows,
``run_by_row`` does the same with two keyed operators and RocksDB state, a call for each group of keys and each account.
Rows of one account in one micro-batch are sorted by (time, request); how many files a micro-batch takes bounds them.

A request from before its account's last posting cannot be put in order any more: it leaves as ``late``, and
``operators.late`` settles it. A replay of an accepted key is no such case: it is answered, not posted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.money import cents, from_cents
from ..functions.text import stable_id
from ..operators import posting
from ..operators.settlement import ACCEPTED, REFUSED, REPEATED, Account
from ..session import emptied, swept
from ..sources.tables import Lake
from .ledger_stream import REQUESTS, append_stream
from .state_table import StateTable

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Landed files of one micro-batch.
MAX_FILES = 1_000

#: Groups of idempotency keys. The rows of one group in one micro-batch are in memory together.
KEY_GROUPS = 256

_NAMES = ["request_id", "account_id", "txn_datetime", "amount", "dr_cr", "channel", "idempotency_key"]
# Input columns by place, as computed ones reach the processors without their names. Whole numbers are never null there:
# pandas would turn a column with a null into floats, and long ids would lose digits.
_CARRIED = ["request_id", "_no_id", "_account", "txn_datetime", "amount", "dr_cr", "channel", "idempotency_key", "_cents", "_sound"]
_CARRIED_TYPES = ("request_id bigint, _no_id boolean, _account bigint, txn_datetime timestamp_ntz, amount decimal(18,2), dr_cr string, "
                  "channel string, idempotency_key string")
_CHECKED = [*_CARRIED, "_usable", "_group"]
_OWNED = [*_CARRIED, "_reused", "_seen", "_room", "_lowest", "_overdraft", "_active"]
_NOBODY = -1 << 63

POSTED = f"{REQUESTS}, outcome string, reason_code string, txn_id string, running_balance decimal(18,2)"
#: Arrival order of an account's requests, what is missing last.
_ORDER = ["_no_time", "txn_datetime", "_no_id", "request_id"]


class KeyOwners(StatefulProcessor):
    """Marks requests whose idempotency key belongs to another account, and keys that an earlier batch has used.

    Keys come in groups by hash, so that a call settles many of them; each has its own entry in the state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.owner = handle.getMapState("owner", "idempotency_key string", "account_id bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).set_axis(_CHECKED, axis=1)
        # A request without a key leaves no state, and one that may not post owns nothing.
        usable = (frame["idempotency_key"].notna() & frame["_usable"]).to_numpy(bool)
        mine = frame.loc[usable, ["idempotency_key", "txn_datetime", "_no_id", "request_id", "_account"]]
        first = mine.sort_values(["txn_datetime", "_no_id", "request_id"]).drop_duplicates("idempotency_key")
        owner, earlier = {}, set()
        for name, account in zip(first["idempotency_key"].tolist(), first["_account"].tolist()):
            known = self.owner.getValue((name,))
            if known is None:
                self.owner.updateValue((name,), (account,))
                owner[name] = account
            else:
                owner[name] = known[0]
                earlier.add(name)
        names, accounts = mine["idempotency_key"].tolist(), mine["_account"].tolist()
        reused, seen = np.zeros(len(frame), bool), np.zeros(len(frame), bool)
        reused[usable] = [owner[n] != a for n, a in zip(names, accounts)]
        seen[usable] = [n in earlier for n in names]
        frame["_reused"], frame["_seen"] = reused, seen
        yield frame[[*_CARRIED, "_reused", "_seen"]]

    def close(self) -> None:
        pass


class Balances(StatefulProcessor):
    """Accepts or refuses the requests of an account in order. An account's state begins with its first posted request."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.account = handle.getValueState("account", "room bigint, lowest bigint, overdraft boolean, active boolean, last_at bigint")
        self.keys = handle.getMapState("keys", "idempotency_key string", "outcome int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).set_axis(_OWNED, axis=1).sort_values(
            ["txn_datetime", "_no_id", "request_id"], kind="stable", ignore_index=True)
        outcome, reason = np.full(len(frame), None, object), np.full(len(frame), None, object)
        balance = np.full(len(frame), None, object)
        good, at = frame["_cents"].to_numpy() > 0, frame["txn_datetime"].to_numpy().astype("datetime64[us]").astype(np.int64)

        def settle(where, what, why):
            outcome[where], reason[where] = what, why

        free = np.ones(len(frame), bool)
        state, opening = None, frame.iloc[0]
        if opening["_active"] is not None and not pd.isna(opening["_active"]):
            state = self.account.get() or (int(opening["_room"]), int(opening["_lowest"]), bool(opening["_overdraft"]), bool(opening["_active"]), None)
        for mask, what, why in (
            (~good, "quarantined", "INVALID_AMOUNT"), (~frame["_sound"].to_numpy(bool), "quarantined", "INVALID_VALUE"),
            (np.full(len(frame), state is None), "rejected", "FK_NOT_FOUND"),
            (np.full(len(frame), state is not None and not state[3]), "rejected", "ACCOUNT_CLOSED"),
            (frame["_reused"].to_numpy(bool), "quarantined", "KEY_REUSED"),
        ):
            settle(mask & free, what, why)
            free &= ~mask
        if state is not None and state[3]:
            room, lowest, overdraft, active, last_at = state
            named = frame["idempotency_key"].where(frame["idempotency_key"].notna(), None).to_numpy(object)
            # Only keys that an earlier batch has used can have an outcome.
            asked = dict.fromkeys(named[free & frame["_seen"].to_numpy(bool)])
            before = {k: found[0] for k in asked if (found := self.keys.getValue((k,))) is not None}
            replayed = free & np.array([before.get(k) == ACCEPTED for k in named], bool)
            settle(replayed, "replayed", None)
            late = free & ~replayed & (at < last_at if last_at is not None else np.zeros(len(frame), bool))
            settle(late, "late", None)
            rows = np.flatnonzero(free & ~replayed & ~late)
            if len(rows):
                room, last_at = self._walk(frame, rows, named, room, lowest, overdraft, last_at, at, outcome, reason, balance)
                self.account.update((room, lowest, overdraft, active, last_at))
        frame["outcome"], frame["reason_code"], frame["_balance"] = outcome, reason, pd.array(balance, "Int64")
        yield frame[[*_CARRIED[:-2], "outcome", "reason_code", "_balance"]]

    def _walk(self, frame, rows, named, room, lowest, overdraft, last_at, at, outcome, reason, balance):
        debit = frame["dr_cr"].to_numpy(object)[rows] == "debit"
        amount = frame["_cents"].to_numpy(np.int64)[rows]
        # Keys used more than once in the batch are settled one by one; the others go by blocks.
        uses = pd.Series(named[rows]).value_counts()
        again = set(uses[uses > 1].index)
        repeat = [k if k in again else None for k in named[rows]]
        met: set = set()
        first = np.array([k is None or not (k in met or met.add(k)) for k in repeat], bool)
        account = Account(room)
        codes, rooms = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int64)
        move = np.where(debit, -amount, amount)
        account.take(first, amount, debit, move, repeat, np.zeros(len(rows), bool), codes, rooms)
        for i, row in enumerate(rows.tolist()):
            if codes[i] == ACCEPTED:
                outcome[row], balance[row] = "accepted", int(rooms[i] + move[i] + lowest)
            elif codes[i] == REFUSED:
                outcome[row], reason[row] = "rejected", "LIMIT_EXCEEDED" if overdraft else "INSUFFICIENT_BALANCE"
            else:
                outcome[row] = "replayed"
            if named[row] is not None and codes[i] in (ACCEPTED, REFUSED):
                self.keys.updateValue((named[row],), (int(codes[i]),))
        done = at[rows[codes == ACCEPTED]]
        if len(done):
            last_at = int(done[-1]) if last_at is None else max(last_at, int(done[-1]))
        return account.room, last_at

    def close(self) -> None:
        pass


def opening_state(accounts: DataFrame) -> DataFrame:
    """Room, floor and flags of accounts as the stream starts from them; without a balance there is no room, as in a batch."""
    overdraft = F.col("deposit_type") == "overdraft"
    lowest = F.when(overdraft, -F.coalesce(cents(F.col("overdraft_limit")), F.lit(0))).otherwise(cents(F.col("min_balance")))
    return accounts.where("account_id is not null").select(
        F.col("account_id").cast("bigint").alias("account_id"), F.coalesce(cents(F.col("current_balance")) - lowest, F.lit(0)).alias("room"), lowest.alias("lowest"),
        F.coalesce(overdraft, F.lit(False)).alias("overdraft"), F.coalesce(F.col("status") == "active", F.lit(False)).alias("active"))


def _reason(active: Column, reused: Column) -> Column:
    """Why a request may not be posted at all; ``active`` is null where there is no account."""
    return (
        F.when(F.col("_cents") <= 0, "INVALID_AMOUNT").when(~F.col("_sound"), "INVALID_VALUE").when(active.isNull(), "FK_NOT_FOUND")
        .when(~active, "ACCOUNT_CLOSED").when(reused, "KEY_REUSED"))


def _txn_id() -> Column:
    own = F.concat_ws("|", F.col("txn_datetime").cast("string"), F.col("request_id").cast("string"))
    identity = [F.lit(posting.DEPOSIT.fact), F.col("account_id"), F.coalesce(F.col("idempotency_key"), own)]
    return F.when(F.col("outcome") != "late", stable_id(posting.DEPOSIT.prefix, *identity)).alias("txn_id")


class StatefulDepositStream:
    """Posts landed requests below ``root``: results in ``posted``, progress and state in ``checkpoint``.

    ``accounts`` are the balances before the first request; once the stream has begun, its state goes on.
    """

    def __init__(self, spark: SparkSession, root: str, accounts: DataFrame, max_files: int = MAX_FILES):
        self.spark, self.root, self.max_files = spark, root, max_files
        self.accounts = opening_state(accounts)

    def opening(self) -> DataFrame:
        """The balances before the first request, written when the stream begins."""
        lake = Lake(self.spark, self.root)
        if not lake.exists("opening"):
            lake.overwrite("opening", self.accounts)
        return lake.read("opening")

    def _checked(self, requests: DataFrame, accounts: DataFrame) -> DataFrame:
        """Requests with ``_sound``, ``_cents`` and ``_usable``: may it post and own its key?"""
        active = accounts.where("active").select("account_id").withColumn("_open", F.lit(True))
        sound = posting.well_formed(requests, posting.DEPOSIT)
        checked = requests.withColumns({"_sound": sound, "_cents": F.coalesce(cents(F.col("amount")), F.lit(0)).cast("bigint")}).join(
            active, "account_id", "left")
        return checked.withColumn("_usable", F.coalesce(F.col("_open") & F.col("_sound") & (F.col("_cents") > 0), F.lit(False))).drop("_open")

    def _terms(self, accounts: DataFrame) -> DataFrame:
        return accounts.groupBy(F.col("account_id").alias("_account")).agg(F.max(F.struct(
            F.col("room").alias("_room"), F.col("lowest").alias("_lowest"), F.col("overdraft").alias("_overdraft"), F.col("active").alias("_active"),
        )).alias("_terms")).select("_account", "_terms.*")

    def _state(self) -> tuple[StateTable, StateTable]:
        """What earlier batches made of keys and accounts: a key's owner and whether it is a fact; what was moved and last posted."""
        keys = StateTable(self.spark, f"{self.root}/state/keys", "idempotency_key string, owner bigint, accepted boolean", {"owner": F.max, "accepted": F.max})
        moved = StateTable(self.spark, f"{self.root}/state/accounts", "account_id bigint, moved bigint, last_at timestamp_ntz", {"moved": F.sum, "last_at": F.max})
        return keys, moved

    def _owned(self, rows: DataFrame, past: DataFrame) -> DataFrame:
        """``_reused``, ``_done`` (a fact of an earlier batch) and ``_uses`` of every request's key."""
        alone = F.concat_ws("|", F.lit("\u0000"), F.col("txn_datetime").cast("string"), F.col("request_id").cast("string"))
        named = F.col("_usable") & F.col("idempotency_key").isNotNull()
        stack = rows.withColumns({"_key": F.coalesce("idempotency_key", alone), "_named": named}).unionByName(
            past.select(F.col("idempotency_key").alias("_key"), "owner", "accepted"), allowMissingColumns=True)
        of_key = Window.partitionBy("_key")
        first = F.min(F.when(F.col("_named"), F.struct(*_ORDER, "account_id"))).over(of_key)["account_id"]
        met = stack.select(
            *rows.columns, "_named", F.coalesce(F.max("owner").over(of_key), first).alias("_owner"), F.max("accepted").over(of_key).alias("_fact"),
            F.count_if("_named").over(of_key).alias("_uses"))
        # Entries of the state have done their work.
        return met.where("_named is not null").select(
            *rows.columns, (F.col("_named") & (F.col("_owner") != F.col("account_id"))).alias("_reused"),
            (F.col("_named") & F.coalesce("_fact", F.lit(False))).alias("_done"), F.when(F.col("_named"), F.col("_uses")).alias("_uses"))

    def _settled(self, rows: DataFrame, terms: DataFrame, past: DataFrame) -> DataFrame:
        """Requests that name an account, with what became of them."""
        state = terms.join(past.withColumnRenamed("account_id", "_account"), "_account", "left")
        placed = rows.join(state, F.col("account_id") == F.col("_account"), "left")
        free, at = F.col("_reason").isNull(), F.col("txn_datetime")
        late = F.col("last_at").isNotNull() & (at.isNull() | (at < F.col("last_at")))
        debit = F.col("dr_cr") == "debit"
        placed = placed.withColumn("_reason", _reason(F.col("_active"), F.col("_reused"))).withColumn(
            "_past", F.when(free & F.col("_done"), "replayed").when(free & late, "late"))
        live = F.col("_reason").isNull() & F.col("_past").isNull()
        moves = placed.withColumns({
            "_opening": F.coalesce("_room", F.lit(0)) + F.coalesce("moved", F.lit(0)), "_need": F.when(live & debit, F.col("_cents")),
            "_move": F.when(live, F.when(debit, -F.col("_cents")).otherwise(F.col("_cents"))).otherwise(F.lit(0)).cast("long"),
            "_repeat": F.when(live & (F.col("_uses") > 1), F.col("idempotency_key"))})
        nth = F.row_number().over(Window.partitionBy("account_id", "_repeat").orderBy(*_ORDER))
        moves = moves.withColumn("_first", F.col("_repeat").isNull() | (nth == 1)).drop(
            "_account", "_room", "_active", "_cents", "_sound", "_usable", "_reused", "_done", "_uses", "moved", "last_at")
        return posting.settle(moves, ["account_id"], _ORDER)

    def take_in(self, requests: DataFrame, batch: int) -> None:
        """Post the requests of one micro-batch. It writes the same again when it is run again."""
        with swept(self.spark):
            accounts, (keys, moved) = self.opening(), self._state()
            taken, posted = f"{self.root}/taken/batch_id={batch}", f"{self.root}/posted/batch_id={batch}"
            checked = self._checked(requests, accounts)
            # The source is read once; what follows reads its rows several times.
            checked.write.mode("overwrite").parquet(taken)
            rows = self.spark.read.schema(checked.schema).parquet(taken).withColumns(
                {"_no_time": F.col("txn_datetime").isNull(), "_no_id": F.col("request_id").isNull()})
            placed = rows.where("account_id is not null")
            past = keys.known(placed.where("_usable and idempotency_key is not null").select("idempotency_key"), batch)
            settled = self._settled(self._owned(placed, past), self._terms(accounts), moved.known(placed.select("account_id"), batch))
            # Requests without an account would all meet in one task; they have no state to wait for.
            apart = rows.where("account_id is null").withColumn("_reason", _reason(F.lit(None).cast("boolean"), F.lit(False)))
            ended = settled.unionByName(apart.drop("_sound", "_cents", "_usable"), allowMissingColumns=True)
            self._finished(ended).write.mode("overwrite").parquet(posted)
            done = self.spark.read.schema(POSTED).parquet(posted)
            signed = F.when(F.col("dr_cr") == "debit", -cents(F.col("amount"))).otherwise(cents(F.col("amount")))
            # A posting without a time says nothing of what may come after it.
            moved.put(done.where("outcome = 'accepted'").groupBy("account_id").agg(
                F.sum(signed).alias("moved"), F.when(F.count_if(F.col("txn_datetime").isNull()) == 0, F.max("txn_datetime")).alias("last_at")), batch)
            # Whoever may post with a key owns it. Replays follow an entry that is there.
            own = done.where("idempotency_key is not null and (outcome in ('accepted', 'late') or reason_code in ('INSUFFICIENT_BALANCE', 'LIMIT_EXCEEDED'))")
            keys.put(own.groupBy("idempotency_key").agg(
                F.max("account_id").alias("owner"), F.max(F.col("outcome") == "accepted").alias("accepted")), batch)
            emptied(self.spark, taken)

    def _finished(self, settled: DataFrame) -> DataFrame:
        code, reason = F.col("_code"), F.col("_reason")
        outcome = (
            F.when(reason.isin(*posting.QUARANTINE_REASONS), "quarantined").when(reason.isNotNull(), "rejected")
            .when(F.col("_past").isNotNull(), F.col("_past")).when(code == ACCEPTED, "accepted").when(code == REPEATED, "replayed").otherwise("rejected"))
        short = F.when(F.col("_overdraft"), "LIMIT_EXCEEDED").otherwise("INSUFFICIENT_BALANCE")
        rows = settled.withColumn("outcome", outcome)
        return rows.select(
            *_NAMES, "outcome", F.when(F.col("outcome") == "rejected", F.coalesce(reason, short)).otherwise(reason).alias("reason_code"), _txn_id(),
            F.when(F.col("outcome") == "accepted", from_cents(F.col("_room") + F.col("_move") + F.col("_lowest"))).alias("running_balance"))

    def results(self, requests: DataFrame) -> DataFrame:
        """:meth:`run_by_row`: two keyed operators behind each other."""
        accounts = self.opening()
        alone = F.concat_ws("|", F.lit("\u0000"), F.col("txn_datetime").cast("string"), F.col("request_id").cast("string"))
        group = F.pmod(F.xxhash64(F.coalesce("idempotency_key", alone)), F.lit(KEY_GROUPS)).cast("int")
        checked = self._checked(requests.withColumn("_group", group), accounts).withColumns({
            "_no_id": F.col("request_id").isNull(), "request_id": F.coalesce("request_id", F.lit(0).cast("bigint")),
            # Requests without an account have no state to wait for.
            "_account": F.coalesce("account_id", F.lit(_NOBODY)),
        })
        owned = checked.select(*_CHECKED).groupBy("_group").transformWithStateInPandas(
            KeyOwners(), _CARRIED_TYPES + ", _cents bigint, _sound boolean, _reused boolean, _seen boolean", "append", "none")
        placed = owned.join(self._terms(accounts), "_account", "left").select(*_OWNED)
        posted = placed.groupBy("_account").transformWithStateInPandas(
            Balances(), _CARRIED_TYPES + ", outcome string, reason_code string, _balance bigint", "append", "none")
        posted = posted.select(
            F.when(~F.col("_no_id"), F.col("request_id")).alias("request_id"), F.when(F.col("_account") != _NOBODY, F.col("_account")).alias("account_id"),
            *_NAMES[2:], "outcome", "reason_code", "_balance")
        return posted.withColumns({"txn_id": _txn_id(), "running_balance": from_cents(F.col("_balance"))}).drop("_balance")

    def _landed(self, landing: str) -> DataFrame:
        return self.spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", self.max_files).parquet(landing)

    def run(self, landing: str) -> StreamingQuery:
        """Post every landed file not seen before, then stop."""
        self.opening()
        return (
            self._landed(landing).writeStream.foreachBatch(self.take_in).option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True).start()
        )

    def run_by_row(self, landing: str) -> StreamingQuery:
        """The same with state in RocksDB; a stream that has begun in one way goes on in it."""
        conf, name = self.spark.conf, "spark.sql.streaming.stateStore.providerClass"
        before = conf.get(name, None)
        conf.set(name, PROVIDER)
        try:
            return append_stream(self.results(self._landed(landing)), f"{self.root}/posted", f"{self.root}/checkpoint")
        finally:
            conf.unset(name) if before is None else conf.set(name, before)

    def posted(self) -> DataFrame:
        return self.spark.read.schema(POSTED).parquet(f"{self.root}/posted")

    def late(self) -> DataFrame:
        return self.posted().where("outcome = 'late'").select(*_NAMES)
