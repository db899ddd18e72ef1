"""Ordered per-key computations that stay balanced when one key owns much of the data.

A window partition is one task, so a key with a third of all rows would be one task too. Keys above
``MAX_GROUP_ROWS`` are therefore cut into slots, ranges of their own order; each slot is a window partition, and
what earlier slots contribute comes from one small row per slot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

MAX_GROUP_ROWS = 2_000_000
_BEGIN = Window.unboundedPreceding


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, or None.

    The result has at most count(df) / max_rows rows, which is what makes it safe to broadcast. Counts are
    exact and combined map-side, so a retried task sees the same list.
    """
    def above(*columns: str) -> DataFrame:
        counts = df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        return counts.where(F.col("_n") > max_rows).select(*columns)

    # The first column alone has fewer groups, and no pair is larger than its part: mostly this settles it.
    heavy = above(keys[0])
    if heavy.isEmpty():
        return None
    heavy = durable(above(*keys))
    return None if heavy.isEmpty() else heavy


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` where null equals null, as it does in a grouping."""
    names = {k: f"_m_{k}" for k in keys}
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys; ``hot`` is bounded, see :func:`hot_keys`."""
    return match(df, F.broadcast(hot), keys, "left_anti"), match(df, F.broadcast(hot), keys, "left_semi")


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Deal rows into ranges of (keys, order); ``_slot`` numbers them, ``_tie`` makes the order total.

    Ranges are cut through a key wherever its rows need it, however many share an hour or a day, and nulls are values
    like any other. The ranges are kept in reliable storage, so that a repeated task cannot deal them anew.
    """
    rows = durable(df.withColumn("_tie", F.xxhash64(*df.columns)))
    parts = int(rows.count() // max_rows) + 1
    ranged = rows.repartitionByRange(parts, *[F.col(c) for c in (*keys, *order, "_tie")])
    return durable(ranged.withColumn("_slot", F.spark_partition_id()))


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, count, min, max or last (last skips nulls).

    With ``before`` the current row is left out.
    """

    kind: str
    column: str
    before: bool = False

    def over(self, keys: Sequence[str], order: Sequence[str]) -> Column:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(_BEGIN, -1 if self.before else 0)
        return self._plain(F.col(self.column)).over(window)

    def _plain(self, column: Column) -> Column:
        if self.kind == "last":
            return F.last(column, ignorenulls=True)
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.kind](column)

    def slot_total(self, order: Sequence[str]) -> Column:
        if self.kind == "last":
            column = F.col(self.column)
            return F.max(F.when(column.isNotNull(), F.struct(*order, column.alias("_kept"))))["_kept"]
        return self._plain(F.col(self.column))

    def carried(self, total: Column) -> Column:
        """Combine the totals of earlier slots."""
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}.get(
            self.kind, lambda c: F.last(c, ignorenulls=True)
        )(total)

    def merge(self, carry: Column, local: Column) -> Column:
        if self.kind in ("sum", "count"):
            return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
        if self.kind == "last":
            return F.coalesce(local, carry)
        return {"min": F.least, "max": F.greatest}[self.kind](carry, local)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Running],
    slot: Callable[[], Column] | None,
    hot: DataFrame | None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add running values over (keys, order).

    Hot keys are cut into ranges of at most about ``max_rows`` rows, or by ``slot`` if it is given; it must not decrease
    along ``order``.
    """
    keys, order = list(keys), list(order)
    if hot is None:
        return df.select("*", *[v.over(keys, order).alias(name) for name, v in values.items()])
    ordinary, heavy = split_hot(df, keys, hot)
    if slot is None:
        heavy, order = in_ranges(heavy, keys, order, max_rows), [*order, "_tie"]
    else:
        heavy = heavy.withColumn("_slot", slot())
    cut = running_in_slots(heavy, keys, order, values).select(*df.columns, *values)
    return running(ordinary, keys, [c for c in order if c != "_tie"], values, slot, None).unionByName(cut)


def running_in_slots(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Running]) -> DataFrame:
    """The same for rows with ``_slot``, as :func:`in_ranges` deals them."""
    cut = [*keys, "_slot"]
    totals = rows.groupBy(*cut).agg(*[v.slot_total(order).alias(f"_t_{name}") for name, v in values.items()])
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(_BEGIN, -1)
    carries = totals.select(
        *cut, *[v.carried(F.col(f"_t_{name}")).over(earlier).alias(f"_c_{name}") for name, v in values.items()]
    )
    local = rows.select("*", *[v.over(cut, order).alias(f"_l_{name}") for name, v in values.items()])
    return match(local, carries, cut, "left").select(
        *rows.columns,
        *[v.merge(F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name) for name, v in values.items()],
    )


def floored_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    slot: Callable[[], Column] | None,
    hot: DataFrame | None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Running sum that is lifted back to zero whenever it would fall below.

    Closed form: S minus the lower of zero and the lowest S so far, so two prefix aggregates do it.
    """
    total, lowest = f"_{name}_sum", f"_{name}_low"
    df = running(df, keys, order, {total: Running("sum", value)}, slot, hot, max_rows)
    df = running(df, keys, order, {lowest: Running("min", total)}, slot, hot, max_rows)
    floored = F.col(total) - F.least(F.lit(0), F.col(lowest))
    return df.withColumn(name, floored).drop(total, lowest)


def strictly_increasing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    seconds: str,
    name: str,
    slot: Callable[[], Column] | None,
    hot: DataFrame | None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Whole-second times per key, each pushed to at least one second after the one before.

    Closed form of t[i] = max(t[i], t[i-1] + 1): position plus the highest (t - position) so far.
    """
    df = df.withColumn("_one", F.lit(1).cast("long"))
    df = running(df, keys, order, {"_pos": Running("sum", "_one")}, slot, hot, max_rows)
    df = df.withColumn("_lead", F.col(seconds) - F.col("_pos"))
    df = running(df, keys, order, {"_high": Running("max", "_lead")}, slot, hot, max_rows)
    return df.withColumn(name, F.col("_pos") + F.col("_high")).drop("_one", "_pos", "_lead", "_high")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``: an aggregate with map-side combine, so a hot key is no problem."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, F.struct(*rest).alias("_rest"))).alias("_top"))
    return picked.select(*keys, *[f"_top.{c}" for c in order], *[f"_top._rest.{c}" for c in rest]).select(*df.columns)
