"""Control totals of a posted batch: do requests, facts, rejections and balances tie?

Every request has a checksum, and checksums are added up, so order and partitions do not matter and repeated rows
count. What was asked must equal what became of it, in number and in sum; each key's opening value and its accepted
movements must give the value stored with the last of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


WIDE = "decimal(38,0)"


def checksum(*identity: Column) -> Column:
    """60 bits of a hash of a row's identity, as a number that can be summed."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in identity])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast(WIDE)


def _sum(column: Column, name: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0).cast(WIDE)).cast(WIDE).alias(name)


def control_totals(
    ledger: str, requests: DataFrame, posted: DataFrame, identity: Sequence[Column], opening: DataFrame, keys: Sequence[str],
    order: Sequence[str], moved: Column, stored: Column,
) -> DataFrame:
    """One row: counts and checksums by outcome, and whether they and the balances tie.

    ``opening``: keys and ``value``, whole numbers, one row per key; a key without a row opens at 0. ``moved`` is what an
    accepted request adds to it and ``stored`` the value kept with it. Refused requests move nothing.
    """
    keys, order = list(keys), list(order)
    asked = requests.agg(F.count(F.lit(1)).alias("n_requests"), _sum(checksum(*identity), "asked"))
    done = F.col("outcome").isin("accepted", "rejected", "replayed", "quarantined")
    is_fact = F.col("outcome") == "accepted"
    # The posted rows are made and read once: every key of either side has its opening value, its counts and its movement in one group.
    facts = posted.select(
        *keys, F.lit(None).cast("long").alias("_open"), F.when(done, F.col("outcome")).alias("_outcome"), F.when(done, checksum(*identity)).alias("_check"),
        F.when(is_fact, moved.cast("long")).alias("_moved"), F.when(is_fact, F.struct(*order, stored.cast("long").alias("_v"))).alias("_at"))
    opened = opening.select(*keys, F.col("value").cast("long").alias("_open"))
    tied = facts.unionByName(opened, allowMissingColumns=True).groupBy(*keys).agg(
        F.max("_open").alias("_open"), F.count("_outcome").alias("n_settled"), F.sum("_check").alias("settled"),
        *[F.count_if(F.col("_outcome") == o).alias(f"n_{o}") for o in ("accepted", "rejected")],
        F.sum(F.when(F.col("_outcome") == "accepted", F.col("_check"))).alias("sum_accepted"),
        F.sum("_moved").alias("_moved"), F.max("_at")["_v"].alias("_last"),
    ).withColumns({"_open": F.coalesce("_open", F.lit(0)), "_moved": F.coalesce("_moved", F.lit(0))})
    closing = F.coalesce(F.col("_last"), F.col("_open"))
    became = tied.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_settled", "n_accepted", "n_rejected")],
        _sum(F.col("settled"), "settled"), _sum(F.col("sum_accepted"), "sum_accepted"),
        _sum(F.col("_open").cast(WIDE), "opening_total"), _sum(F.col("_moved").cast(WIDE), "net_accepted"), _sum(closing.cast(WIDE), "closing_total"),
        F.count_if(F.col("_open") + F.col("_moved") != closing).alias("n_keys_off"))
    # Two frames of one row each, laid over each other.
    stacked = asked.unionByName(became, allowMissingColumns=True)
    joined = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return joined.select(
        F.lit(ledger).alias("ledger"), "n_requests", "n_accepted", "n_rejected", F.col("asked").cast("string").alias("checksum_requests"),
        F.col("sum_accepted").cast("string").alias("checksum_accepted"),
        *[F.col(c).cast("string").alias(c) for c in ("opening_total", "net_accepted", "closing_total")], "n_keys_off",
        ((F.col("asked") == F.col("settled")) & (F.col("n_requests") == F.col("n_settled"))).alias("requests_tie"),
        ((F.col("opening_total") + F.col("net_accepted") == F.col("closing_total")) & (F.col("n_keys_off") == 0)).alias("balances_tie"))


