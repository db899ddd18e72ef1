"""Sharding by jump consistent hashing: a stable key and the number of shards decide, no ring table is kept.

The key walks a fixed pseudo-random sequence of jumps; the last shard it reaches below the number of shards is its
own. With one more shard a key either stays or moves to the new one, because the walk itself does not change.

Defined cases: a null key counts as key 0; a key that is no whole number counts as a 64-bit hash of it; a null or empty text has no bytes; equal rows share a shard and take
neighbouring slots; an empty table gives an empty result; extra columns of the input pass through ``assign`` (the
columns ``shard`` and ``grown_shard`` are replaced) and are dropped by ``layout``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerlake.llm.common import read, running_start, written

# Multiplier of the published 64-bit linear congruential sequence, as two 32-bit halves.
MULTIPLIER_HIGH = 0x27BB2EE6
MULTIPLIER_LOW = 0x87B0B0FD

#: Walks end after about ln(shards) jumps; those that are longer go on in a second, full loop.
USUAL_JUMPS = 64
ROWS_PER_BUCKET = 50_000


def _times_plus_one(high: Column, low: Column) -> tuple[Column, Column]:
    """Halves of state * multiplier + 1 modulo 2^64, by products that stay below 2^63."""
    upper, lower = MULTIPLIER_LOW >> 16, MULTIPLIER_LOW & 0xFFFF
    mask = F.lit(0xFFFFFFFF).cast("long")
    p = low * upper
    s = low * lower + 1 + F.shiftleft(p.bitwiseAND(F.lit(0xFFFF).cast("long")), 16)
    carry = F.shiftright(s, 32) + F.shiftright(p, 16)
    h = high * lower + F.shiftleft((high * upper).bitwiseAND(F.lit(0xFFFF).cast("long")), 16)
    return (carry + h + low * MULTIPLIER_HIGH).bitwiseAND(mask), s.bitwiseAND(mask)


def _walk(start: Column, steps: Column, shards: int) -> Column:
    def jump(state: Column, _: Column) -> Column:
        high, low = _times_plus_one(state["high"], state["low"])
        to = F.floor((state["to"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(high, 1) + 1).cast("double")))
        moved = F.struct(high.alias("high"), low.alias("low"), state["to"].alias("at"), to.alias("to"))
        return F.when(state["to"] < shards, moved).otherwise(state)

    return F.aggregate(steps, start, jump)


def _jumps(key: Column, shards: int) -> Column:
    """struct(at, to): the last shard below ``shards`` and the next place of the walk."""
    word = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    mask = F.lit(0xFFFFFFFF).cast("long")
    start = F.struct(
        F.shiftright(word, 32).bitwiseAND(mask).alias("high"), word.bitwiseAND(mask).alias("low"),
        F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("to"))
    return _walk(start, F.sequence(F.lit(1), F.lit(min(shards, USUAL_JUMPS))), shards)


def assign(docs: DataFrame, key: Column, shards: int) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (with one more shard). Reads each row once, without a shuffle."""
    if not isinstance(docs.select(key.alias("_key")).schema[0].dataType, IntegralType):
        key = F.when(key.isNotNull(), F.xxhash64(key))
    docs = docs.drop("shard", "grown_shard").withColumn("_walk", _jumps(key, shards))
    if shards > USUAL_JUMPS:
        # Each jump moves on by one shard at least, so ``shards`` steps end every walk.
        full = _walk(F.col("_walk"), F.sequence(F.lit(1), F.lit(shards)), shards)
        docs = docs.withColumn("_walk", F.when(F.col("_walk.to") < shards, full).otherwise(F.col("_walk")))
    at, to = F.col("_walk.at").cast("int"), F.col("_walk.to")
    return docs.withColumns({"shard": at, "grown_shard": F.when(to == shards, F.lit(shards)).otherwise(at)}).drop("_walk")


def _hex_digits(rows: int) -> int:
    digits = 1
    while 16 ** digits * ROWS_PER_BUCKET < rows:
        digits += 1
    return digits


def layout(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document with its place: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots run through a shard by (hash of the key, key, checksum, size). Rows that agree in all of these are counted
    per input partition first, so that a repeated key is never gathered; no shard is sorted by one task.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    place = assign(
        docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")),
        F.col("doc_id"), shards)
    place = place.withColumn("mixed", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    place = written(place.withColumn("part", F.spark_partition_id()), "shard-places")
    digits = _hex_digits(place.count())
    same = ["shard", "grown_shard", "mixed", "doc_id", "text_crc32", "size", "part"]
    counted = place.groupBy(*same).agg(F.count("*").alias("n")).withColumn("bucket", F.substring("mixed", 1, digits))
    order = [F.col(c) for c in ("mixed", "doc_id", "text_crc32", "size", "part")]
    placed = running_start(counted, ["shard"], "bucket", order, "n", "first_slot")
    slots = placed.withColumn("slot", F.explode(F.sequence(F.col("first_slot"), F.col("first_slot") + F.col("n") - 1)))
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents on 24 shards."""
    return layout(read(spark, folder, "documents"), 24)


#: The same in DuckDB: the walk as a recursive query in 128-bit integers, CRC-32 bit by bit from its polynomial.
ORACLE = """
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(text, '') AS text, CASE WHEN coalesce(doc_id, 0) < 0 THEN 18446744073709551616::HUGEINT + doc_id ELSE coalesce(doc_id, 0)::HUGEINT END AS k0
  FROM documents),
walk AS (
  SELECT DISTINCT k0, k0 AS k, (-1)::BIGINT AS cur, 0::BIGINT AS too FROM docs
  UNION ALL
  SELECT k0, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT,
    too, floor((too + 1)::DOUBLE * (2147483648.0::DOUBLE / (((k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT) // 8589934592::HUGEINT + 1)::DOUBLE))::BIGINT
  FROM walk WHERE too < 24),
ended AS (SELECT k0, cur, too FROM walk WHERE too >= 24),
crc_table AS (
  SELECT list(list_reduce(list_prepend(i::UBIGINT, [0,1,2,3,4,5,6,7]::UBIGINT[]),
      lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
sized AS (
  SELECT doc_id, k0, (octet_length(encode(text)) + 8)::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, coalesce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::UBIGINT), []::UBIGINT[])),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255::UBIGINT)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32,
    md5(coalesce(doc_id::VARCHAR, '')) AS mixed
  FROM docs, crc_table)
SELECT s.doc_id, s.size, s.text_crc32, 'key' AS law, e.cur::INTEGER AS shard,
  row_number() OVER (PARTITION BY e.cur ORDER BY s.mixed, s.doc_id, s.text_crc32, s.size) - 1 AS slot,
  CASE WHEN e.too = 24 THEN 24 ELSE e.cur::INTEGER END AS grown_shard
FROM sized s JOIN ended e USING (k0)
"""
