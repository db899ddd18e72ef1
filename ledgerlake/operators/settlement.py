"""Hot keys: the ranges of one key's requests settled in parallel, also where requests are refused.

A range takes the room with which its key enters to the room with which it leaves. Requests are decided alike for all
entry rooms of an interval, and there the range does nothing but shift the room: it is a piecewise translation, and one
walk finds the piece in which an entry room lies, with its limits. Before a key's first range that falls short, totals
give all entry rooms. Behind it

1. every range is walked from a supposed room, all of them in parallel;
2. the pieces are put one behind the other: a room that lies in a range's piece leaves it shifted. Where it lies
   beside the piece, the range is walked again from there in the next round, and what follows is put together with
   the room it left with last time. Refusals make different entry rooms end alike, so that room is nearly always right
   and two rounds suffice however many ranges fall short;
3. an idempotency key that is used in several ranges may be tried again after a refusal. Which of them are open when a
   range begins comes from the outcomes of the ranges before, and a range whose open keys change is walked again.

The first range that does not fit yet has the right room and the right open keys, so each round settles one more range
at least and what fits is exact. Keys that do not fit after ``ROUNDS`` rounds stream through one walk, which gives the
same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable
from .ordered import MAX_GROUP_ROWS, in_ranges, match

REFUSED, ACCEPTED, REPEATED = 0, 1, 2
#: Rounds of walks before a key that still does not fit is streamed.
ROUNDS = 8
_BEGIN = Window.unboundedPreceding
_FAR = 1 << 60

# Columns that nothing needs after the walk.
WALK_ONLY = ("_opening", "_need", "_short", "_shorts", "_room", "_paid_in", "_tally", "_tally_before")


# --- one walk -------------------------------------------------------------------------------------


class Account:
    """A key's state while its rows stream by: the room, and the repeated keys whose last try was refused.

    ``down`` and ``up`` say by how much the room at the start might have differed without any other decision.
    """

    def __init__(self, room: int):
        self.room, self.retryable, self.met = room, set(), {}
        self.start, self.down, self.up = room, _FAR, _FAR

    def take(self, first, need, limited, move, repeat, opened, codes, rooms) -> None:
        """Settle rows in order. Runs without repeats go by blocks; only a refusal ends a block early."""
        special = np.flatnonzero(np.array([r is not None for r in repeat], bool))
        at, block = 0, 64
        while at < len(first):
            after = np.searchsorted(special, at)
            if after < len(special) and special[after] == at:
                self._repeat(at, first, need, limited, move, repeat[at], opened[at], codes, rooms)
                at += 1
                continue
            end = min(at + block, special[after] if after < len(special) else len(first))
            live = first[at:end]
            gain = np.cumsum(np.where(live, move[at:end], 0))
            room = self.room + np.r_[0, gain[:-1]]
            bound = live & limited[at:end]
            short = np.flatnonzero(bound & (room < need[at:end]))
            stop = end if not len(short) else at + int(short[0])
            rooms[at:stop] = room[:stop - at]
            codes[at:stop] = np.where(live[:stop - at], ACCEPTED, REPEATED)
            spare = (room - need[at:end])[:stop - at][bound[:stop - at]]
            if len(spare):
                self.down = min(self.down, int(spare.min()))
            block = block * 2 if not len(short) else 64
            if stop > at:
                self.room += int(gain[stop - at - 1])
            if len(short):
                rooms[stop], codes[stop] = self.room, REFUSED
                self.up = min(self.up, int(need[stop]) - self.room - 1)
                stop += 1
            at = stop

    def _repeat(self, at, first, need, limited, move, key, opened, codes, rooms) -> None:
        if opened and key not in self.met:
            self.retryable.add(key)
        rooms[at] = self.room
        if not first[at] and key not in self.retryable:
            codes[at] = REPEATED
            return
        if limited[at] and self.room < need[at]:
            codes[at] = REFUSED
            self.up = min(self.up, int(need[at]) - self.room - 1)
            self.retryable.add(key)
            self.met[key] = REFUSED
            return
        codes[at] = ACCEPTED
        if limited[at]:
            self.down = min(self.down, self.room - int(need[at]))
        self.room += int(move[at])
        self.retryable.discard(key)
        self.met[key] = ACCEPTED


def _changes(batch: pa.RecordBatch, keys: Sequence[str], last: tuple | None) -> tuple[np.ndarray, tuple]:
    """Row numbers at which a new key begins, and the key of the last row."""
    new = np.zeros(batch.num_rows, bool)
    for key in keys:
        values = batch.column(batch.schema.get_field_index(key))
        new[1:] |= pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False).astype(bool)

    def at(row):
        return tuple(batch.column(batch.schema.get_field_index(k))[row].as_py() for k in keys)

    new[0] = last is None or at(0) != last
    return np.flatnonzero(new), at(batch.num_rows - 1)


def _walked(batches: Iterator[pa.RecordBatch], group: Sequence[str]):
    """(batch, codes, rooms, accounts that ended in it with their group); groups come whole and in order.

    ``_room_in`` is the room a group begins with, ``_opened`` marks repeated keys that are open then.
    """
    account, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue

        def column(name, batch=batch):
            return batch.column(batch.schema.get_field_index(name))

        first = column("_first").to_numpy(zero_copy_only=False).astype(bool)
        limited = np.asarray(column("_need").is_valid())
        need, move, begin = (column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("_need", "_move", "_room_in"))
        repeat, opened = column("_repeat").to_pylist(), column("_opened").to_numpy(zero_copy_only=False).astype(bool)
        codes, rooms = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
        starts, key = _changes(batch, group, last)
        edges, ended = [0, *starts[starts > 0], batch.num_rows], []
        fresh = set(starts.tolist())
        for a, b in zip(edges[:-1], edges[1:]):
            if a in fresh:
                if account is not None:
                    ended.append((last, account))
                account = Account(int(begin[a]))
                last = tuple(column(k)[a].as_py() for k in group)
            account.take(first[a:b], need[a:b], limited[a:b], move[a:b], repeat[a:b], opened[a:b], codes[a:b], rooms[a:b])
        last = key
        yield batch, codes, rooms, ended
    if account is not None:
        yield None, None, None, [(last, account)]


_EXTRA = ("_room_in", "_opened")


def _settled(group: Sequence[str]):
    """Rows with ``_code`` and ``_room``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, codes, rooms, _ in _walked(batches, group):
            if batch is not None:
                names = [n for n in batch.schema.names if n not in (*WALK_ONLY, *_EXTRA)]
                columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(codes), pa.array(rooms)], names=[*names, "_code", "_room"])

    return run


def _tried(group: Sequence[str], schema: pa.Schema):
    """Per range its piece (``_repeat`` null), and each repeated key's last outcome in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, ended in _walked(batches, group):
            for at, account in ended:
                rows = [(*at, None, account.start - account.down, account.start + account.up, account.room - account.start, None)]
                rows += [(*at, key, None, None, None, code) for key, code in account.met.items()]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _opening_rooms(keys: Sequence[str]):
    """Put the pieces of one key's ranges behind each other."""

    def run(ranges: pd.DataFrame) -> pd.DataFrame:
        ranges = ranges.sort_values("_slot").reset_index(drop=True)
        room, rooms, fits = int(ranges["_room_in"][0]), [], []
        for low, high, shift, was in zip(ranges["_low"], ranges["_high"], ranges["_shift"], ranges["_room_in"]):
            rooms.append(room)
            fits.append(bool(low <= room <= high))
            # Beside its piece a range is taken to end as it did when it was walked.
            room = room + int(shift) if fits[-1] else int(was) + int(shift)
        return pd.DataFrame({**{k: ranges[k] for k in keys}, "_slot": ranges["_slot"], "_room_in": rooms, "_fits": fits})

    return run


# --- all ranges -----------------------------------------------------------------------------------


def settle_in_slots(moves: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Same answer as ``posting.settle`` for keys too large for one task, range by range in parallel.

    ``_slot`` and ``_tie`` of the ranges stay for a second running value.
    """
    keys, order = list(keys), list(order)
    cut, columns = [*keys, "_slot"], [*moves.columns, "_tie", "_slot"]
    carried = [c for c in columns if c not in ("_opening", "_need")]
    rows = in_ranges(moves, keys, order, max_rows)
    within = Window.partitionBy(*cut).orderBy(*order, "_tie").rowsBetween(_BEGIN, -1)
    live_move = F.when(F.col("_first"), F.col("_move")).otherwise(F.lit(0))
    placed = rows.withColumn("_gain", F.coalesce(F.sum(live_move).over(within), F.lit(0)))
    slots = placed.groupBy(*cut).agg(
        F.sum(live_move).alias("_total"), F.min("_opening").alias("_begin"),
        F.max(F.when(F.col("_first"), F.col("_need") - F.col("_gain"))).alias("_required"),
    )
    chain = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(_BEGIN, -1)
    entered = durable(slots.withColumn("_room_in", F.col("_begin") + F.coalesce(F.sum("_total").over(chain), F.lit(0)))
                      .select(*cut, "_room_in", "_total", F.coalesce(F.col("_room_in") < F.col("_required"), F.lit(False)).alias("_broken")))
    stops = entered.where("_broken").groupBy(*keys).agg(F.min(F.struct("_slot", "_room_in")).alias("_stop"))
    known = durable(match(entered.drop("_broken"), stops, keys, "left").select(
        *cut, "_total", "_room_in", F.col("_stop._room_in").alias("_stop_room"),
        F.coalesce(F.col("_slot") >= F.col("_stop._slot"), F.lit(False)).alias("_walked")))
    cleared = match(placed, known.where("not _walked").select(*cut, "_room_in"), cut, "inner").select(
        *carried,
        F.when(F.col("_first"), ACCEPTED).otherwise(REPEATED).alias("_code"),
        (F.col("_room_in") + F.col("_gain")).alias("_room"),
    )
    walked = known.where("_walked")
    if walked.isEmpty():
        return cleared
    after = match(rows, walked.select(*cut), cut, "left_semi")
    fitting, opened, streamed = _rooms(after, walked, keys, order)
    parts = [cleared, _walk(after, fitting.select(*cut, "_room_in"), opened, cut, cut, order).select(*cleared.columns)]
    if streamed is not None:
        starts = match(walked, streamed, keys, "left_semi").select(*cut, F.col("_stop_room").alias("_room_in"))
        parts.append(_walk(after, starts, None, keys, cut, order).select(*cleared.columns))
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    return done


def _dealt(rows: DataFrame, rooms: DataFrame, opened: DataFrame | None, by: list[str], cut: list[str], order: list[str]) -> DataFrame:
    """Rows of the ranges in ``rooms`` in walking order, ``by`` telling what one task must see whole."""
    rows = match(rows, rooms, cut, "inner")
    if opened is None:
        rows = rows.withColumn("_opened", F.lit(False))
    else:
        rows = match(rows, opened.withColumn("_flag", F.lit(True)), [*cut, "_repeat"], "left").withColumn(
            "_opened", F.col("_flag").isNotNull() & F.col("_repeat").isNotNull()).drop("_flag")
    return rows.repartition(*by).sortWithinPartitions(*cut, *order, "_tie")


def _walk(rows: DataFrame, rooms: DataFrame, opened: DataFrame | None, by: list[str], cut: list[str], order: list[str]) -> DataFrame:
    # What a second running value needs passes through under another name; it is settled afterwards.
    stream = _dealt(rows, rooms, opened, by, cut, order).withColumnRenamed("_paid_in", "_paid_kept")
    fields = [f for f in stream.schema.fields if f.name not in (*WALK_ONLY, *_EXTRA)]
    fields += [T.StructField("_code", T.IntegerType()), T.StructField("_room", T.LongType())]
    return stream.mapInArrow(_settled(by), T.StructType(fields)).withColumnRenamed("_paid_kept", "_paid_in")


def _rooms(after: DataFrame, walked: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Right entry rooms of ranges, their open repeated keys, and the keys that did not fit in time (or None)."""
    cut = [*keys, "_slot"]
    so_far = Window.partitionBy(*keys).orderBy("_slot")
    # A room never falls below zero by a refusal, so a sum lifted at zero is a fair guess.
    reached = F.col("_stop_room") + F.coalesce(F.sum("_total").over(so_far.rowsBetween(_BEGIN, -1)), F.lit(0))
    guessed = walked.withColumn("_sum", reached)
    rooms = durable(guessed.select(
        *cut, (F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(so_far.rowsBetween(_BEGIN, 0)))).cast("long").alias("_room_in")))
    twice = after.where("_repeat is not null").groupBy(*keys, "_repeat").agg(F.min("_slot").alias("a"), F.max("_slot").alias("b")).where("a < b")
    shared = durable(twice.select(*keys, "_repeat"))
    shared = None if shared.isEmpty() else shared
    needed = [*cut, *order, "_tie", "_first", "_repeat", "_need", "_move"]
    narrow = after.select(*dict.fromkeys(needed))
    fields = [after.schema[c] for c in cut] + [after.schema["_repeat"]]
    fields += [T.StructField(c, T.LongType()) for c in ("_low", "_high", "_shift")] + [T.StructField("_code", T.IntegerType())]
    schema = T.StructType(fields)
    shape = T.StructType([*[after.schema[c] for c in cut], T.StructField("_room_in", T.LongType()), T.StructField("_fits", T.BooleanType())])

    tried, open_now, todo = None, None, rooms
    for _ in range(ROUNDS):
        stream = _dealt(narrow, todo, open_now, cut, cut, order)
        found = durable(stream.mapInArrow(_tried(cut, _arrow(schema)), schema))
        # Ranges that fitted keep what their walk gave.
        tried = found if tried is None else durable(match(tried, todo.select(*cut), cut, "left_anti").unionByName(found))
        pieces = match(rooms, tried.where("_repeat is null").select(*cut, "_low", "_high", "_shift"), cut, "inner")
        composed = pieces.groupBy(*keys).applyInPandas(_opening_rooms(keys), shape)
        opens = None if shared is None else durable(_open_keys(match(tried.where("_repeat is not null"), shared, [*keys, "_repeat"], "left_semi"), after, keys))
        if opens is not None:
            changed = _difference(opens, open_now, [*cut, "_repeat"]).select(*cut).distinct().withColumn("_changed", F.lit(True))
            composed = match(composed, changed, cut, "left").withColumn("_fits", F.col("_fits") & F.col("_changed").isNull()).drop("_changed")
        composed = durable(composed)
        open_now, rooms = opens, composed.drop("_fits")
        todo = composed.where("not _fits").drop("_fits")
        if todo.isEmpty():
            return rooms, open_now, None
    late = durable(todo.select(*keys).distinct())
    return match(rooms, late, keys, "left_anti"), open_now, late


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _open_keys(outcomes: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, range, repeated key) that are open when the range begins: refused before and not accepted since."""
    cut = [*keys, "_slot"]
    uses = after.where("_repeat is not null").select(*cut, "_repeat").distinct()
    known = match(uses, outcomes.select(*cut, "_repeat", "_code"), [*cut, "_repeat"], "left")
    before = Window.partitionBy(*keys, "_repeat").orderBy("_slot").rowsBetween(_BEGIN, -1)
    last = F.max(F.when(F.col("_code") == ACCEPTED, 2).when(F.col("_code") == REFUSED, 1)).over(before)
    return known.withColumn("_last", last).where("_last = 1").select(*cut, "_repeat")


def _difference(left: DataFrame, right: DataFrame | None, columns: list[str]) -> DataFrame:
    if right is None:
        return left
    return match(left, right, columns, "left_anti").unionByName(match(right, left, columns, "left_anti"))


