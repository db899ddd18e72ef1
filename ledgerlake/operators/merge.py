"""Upserts, status changes, incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows win. ``source`` has one row per key."""
    keys = list(keys)
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source.select(*target.columns))


def upsert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target yet: what has to be appended."""
    keys = list(keys)
    return source.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def apply_status_changes(rows: DataFrame, changes: DataFrame, key: str, status: str = "status") -> DataFrame:
    """New status where ``changes`` (key, new_status) has one for the key."""
    return rows.join(changes.select(key, "new_status"), key, "left").withColumn(
        status, F.coalesce("new_status", status)
    ).drop("new_status")


def finalize(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of ``changes`` (key, status and whatever goes with it) in place of their own, where it has the key.

    Of several changes for a key the largest counts, so the result hangs on no order.
    """
    new = [c for c in changes.columns if c != key]
    one = changes.groupBy(key).agg(F.max(F.struct(*new)).alias("_new"))
    joined = rows.join(one, key, "left")
    return joined.withColumns({c: F.coalesce(f"_new.{c}", c) for c in new}).select(*rows.columns)


def card_status_after(account_status: Column) -> Column:
    """Card status that follows from a no longer active account."""
    return F.when(account_status == "closed", "blocked").when(account_status != "active", "expired")


def watermarks(facts: DataFrame, key: str, date: str) -> DataFrame:
    """Highest date on file per key."""
    return facts.groupBy(key).agg(F.max(date).alias("watermark"))


def against_watermark(batch: DataFrame, marks: DataFrame, key: str, date: str) -> DataFrame:
    """Flag every row as new (above the key's mark, or no mark) or late."""
    fresh = F.col("watermark").isNull() | (F.col(date) > F.col("watermark"))
    return batch.join(marks, key, "left").withColumn("is_new", fresh)


def new_rows(batch: DataFrame, facts: DataFrame, key: str, date: str) -> DataFrame:
    flagged = against_watermark(batch, watermarks(facts, key, date), key, date)
    return flagged.where("is_new").select(*batch.columns)


def late_rows(batch: DataFrame, facts: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Rows at or below the mark that would change the table: back-filled dates and restated values."""
    old = against_watermark(batch, watermarks(facts, key, date), key, date).where("not is_new")
    on_file = facts.select(key, date, F.col(value).alias("on_file"))
    joined = old.join(on_file, [key, date], "left")
    kind = F.when(F.col("on_file").isNull(), "backfilled").when(F.col("on_file") != F.col(value), "restated")
    return joined.withColumn("late_kind", kind).where("late_kind is not null").select(*batch.columns, "on_file", "late_kind")


def refresh_status(schemes: DataFrame, fetched: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Outcome per scheme: FAILED without a response, OK with new rows, else NO_NEW_ROWS."""
    answered = fetched.select(key).distinct().withColumn("_answered", F.lit(True))
    counts = fresh.groupBy(key).agg(F.count(F.lit(1)).alias("_new"))
    joined = schemes.select(key).join(answered, key, "left").join(counts, key, "left")
    status = F.when(F.col("_answered").isNull(), "FAILED").when(F.col("_new") > 0, "OK").otherwise("NO_NEW_ROWS")
    return joined.select(key, status.alias("status"), F.coalesce("_new", F.lit(0)).alias("n_new"))


def mirror_changes(silver: DataFrame, mirror: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Key-level difference of a table and its mirror."""
    left = silver.select(*keys, F.col(value).alias("silver_value"), F.lit(True).alias("_s"))
    right = mirror.select(*keys, F.col(value).alias("mirror_value"), F.lit(True).alias("_m"))
    kind = (
        F.when(F.col("_m").isNull(), "missing_in_mirror").when(F.col("_s").isNull(), "missing_in_silver")
        .when(F.col("silver_value") != F.col("mirror_value"), "value_differs").otherwise("in_sync")
    )
    return left.join(right, list(keys), "full").select(*keys, "silver_value", "mirror_value", kind.alias("state"))
