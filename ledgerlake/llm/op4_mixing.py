"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks, then seeded block selection.

Each source has a target in words. Blocks of equal length are given to sources by the highest quotients
target / (2k + 1); the quotas are whole numbers, spread over output shards one block apart at most. A source's
documents stand in a seeded order as one stream of words, which is cut into one segment for each shard, as long as the
shard's quota asks. Inside each segment the blocks are chosen by seed: a run of as many as the quota, from a seeded
start, going round as often as needed, so that documents stay whole but for the ends of runs and segments.

Defined cases: a null text has no words and takes none; a null source is a source of its own, ordered last; equal
rows stand next to each other; a source without words has no target; a source with fewer seats than shards has empty segments; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, read, running_start, written

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 4_000


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(source, source_size, weight, target): ``share`` of all words by weight, none above ``most`` times its source.

    What is cut off is shared again by weight until nothing is above: the level L with sum(min(most * size, L * weight))
    = share * sum(size), found by one pass over the sources in the order in which they reach their limit. Windows run
    over one row per source.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(every) - 1) % n + 1).cast("int"))
    sized = sizes.withColumn("weight", turn).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    reach = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = reach.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    sized = sized.withColumn("level", level).withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    final = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(whole)
    return sized.select("source", "source_size", "weight", F.when(F.col("full"), F.col("limit")).otherwise(
        F.least(F.col("limit"), final["level"] * F.col("weight"))).alias("target"))


def quotas(targeted: DataFrame, block: int) -> DataFrame:
    """Add ``blocks``: seats of each source when round(total target / block) blocks go to the highest quotients.

    With n sources and K blocks, no source gets fewer than it would at a divisor that hands out K - n/2 on average, or
    more than at K + n/2; only the quotients between (about 2n in all) are compared.
    """
    whole = Window.partitionBy()
    summed = targeted.withColumn("total", F.sum("target").over(whole)).withColumn("n", F.count("*").over(whole))
    summed = summed.withColumn("seats", F.round(F.col("total") / block))
    at = lambda k: F.when(F.col("total") > 0, F.floor(F.col("target") * F.greatest(k, F.lit(0.0)) / F.col("total") + 0.5)).otherwise(0)
    ranged = summed.withColumn("sure", F.greatest(at(F.col("seats") - F.col("n") / 2 - 1) - 1, F.lit(0))).withColumn("top", at(F.col("seats") + F.col("n") / 2 + 1) + 1)
    ranged = ranged.withColumn("open", F.col("seats") - F.sum("sure").over(whole))
    asked = ranged.withColumn("k", F.explode(F.sequence(F.col("sure"), F.col("top"))))
    rank = F.row_number().over(Window.orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), F.col("source").asc_nulls_last(), "k"))
    won = asked.withColumn("won", (rank <= F.col("open")) & (F.col("target") > 0))
    return won.groupBy("source", "source_size", "weight", "target").agg((F.first("sure") + F.sum(F.col("won").cast("long"))).alias("blocks"))


def shard_quotas(quota: DataFrame, shards: int) -> DataFrame:
    """(source, shard, blocks): each source's blocks over equal shards, highest quotients first, ties going round.

    Shards of one source differ by one block at most, and so do the shards' totals.
    """
    start = F.coalesce(F.sum("blocks").over(Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = quota.withColumn("start", start % shards).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    extra = F.pmod(F.col("shard") - F.col("start"), F.lit(shards)) < F.col("blocks") % shards
    return each.select("source", "shard", (F.floor(F.col("blocks") / shards) + extra.cast("long")).alias("blocks"))


def _seeded(seed: str, value: Column) -> Column:
    """60 pseudo-random bits as a long."""
    text = F.concat(F.lit(f"{seed}/"), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def segments(quota: DataFrame, shards: int, block: int, most: float, seed: str) -> DataFrame:
    """(source, source_size, target, blocks, segments): one row per source, its segments in shard order.

    A segment is (shard, low, size, run, rounds, left): where it lies in the source's stream, the seeded start of its
    run, and the words it takes, as whole rounds and the rest. Its length is in proportion to the shard's quota, so the
    limit of ``most`` times falls on all shards alike. Products of words and blocks are decimals; they exceed a long.
    """
    per = shard_quotas(quota, shards).select(F.col("source").alias("_source"), "shard", F.col("blocks").alias("won"))
    own = quota.join(per, F.col("source").eqNullSafe(F.col("_source"))).where("won > 0")
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("upto", F.sum("won").over(upto))
    cut = lambda seats: F.expr(f"(CAST(source_size AS DECIMAL(19, 0)) * CAST({seats} AS DECIMAL(18, 0))) div CAST(blocks AS DECIMAL(18, 0))")
    own = own.withColumns({"low": cut("upto - won"), "high": cut("upto")}).withColumn("size", F.col("high") - F.col("low"))
    own = own.where("size > 0").withColumn("words", F.least(F.col("won") * block, F.floor(F.col("size") * F.lit(float(most)))))
    start = _seeded(f"{seed}/start", F.concat(F.col("shard").cast("string"), F.lit("/"), F.coalesce("source", F.lit(""))))
    run = F.pmod(start, F.greatest(F.floor(F.col("size") / block), F.lit(1))) * block
    one = F.struct("shard", "low", "size", run.alias("run"), F.floor(F.col("words") / F.col("size")).alias("rounds"), (F.col("words") % F.col("size")).alias("left"))
    held = own.groupBy("source").agg(F.array_sort(F.collect_list(one)).alias("segments")).withColumnRenamed("source", "_source")
    return quota.join(held, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "blocks", F.coalesce("segments", F.array().cast(held.schema["segments"].dataType)).alias("segments"))


def _words_of(segment: Column, first: Column, end: Column) -> Column:
    """Words that a segment takes of the words [first, end) of its source's stream."""
    size, run, left = segment["size"], segment["run"], segment["left"]
    inside = lambda x: F.least(F.greatest(x - segment["low"], F.lit(0)), size)
    # Of the segment's words [0, x): those in the run, and those in what of the run goes round to the segment's start.
    upto = lambda x: F.least(F.greatest(x - run, F.lit(0)), left) + F.least(x, F.greatest(run + left - size, F.lit(0)))
    low, high = inside(first), inside(end)
    return segment["rounds"] * (high - low) + upto(high) - upto(low)


def mix(docs: DataFrame, weights: list[int], share: float, most: float, block: int, seed: str, shards: int) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, blocks (of its source), taken, and ``shards``,
    an array of (shard, words): which shards take how many of its words."""
    rows = docs.select("doc_id", "source", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"))
    rows = written(rows.withColumn("mixed", _seeded(seed, F.col("doc_id"))).withColumn("part", F.spark_partition_id()), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    quota = written(quotas(targets(sizes, weights, share, most), block), "mix-quotas")
    own = written(segments(quota, shards, block, most, seed).withColumnRenamed("source", "_source"), "mix-segments")
    buckets = rows.count() // ROWS_PER_BUCKET + 1
    # Rows that agree in everything are counted per input partition first, so that a repeated id is never gathered.
    counted = rows.groupBy("source", "mixed", "doc_id", "size", "part").agg(F.count("*").alias("n")).withColumns(
        {"bucket": F.floor(F.col("mixed") / F.lit(2.0**60) * buckets), "words": F.col("size") * F.col("n")})
    order = [F.col(c) for c in ("mixed", "doc_id", "size", "part")]
    placed = running_start(counted, ["source"], "bucket", order, "words", "first")
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).withColumn("first", F.col("first") + F.col("copy") * F.col("size"))
    joined = copies.join(own, F.col("source").eqNullSafe(F.col("_source")))
    end = F.col("first") + F.col("size")
    each = F.transform(F.filter("segments", lambda s: (s["low"] < end) & (s["low"] + s["size"] > F.col("first"))),
                       lambda s: F.struct(s["shard"].alias("shard"), _words_of(s, F.col("first"), end).cast("long").alias("words")))
    joined = joined.withColumn("shards", F.filter(each, lambda s: s["words"] > 0))
    taken = F.aggregate("shards", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["words"])
    return joined.select("doc_id", "source", "size", "source_size", "target", "blocks", taken.alias("taken"), "shards")


def mixed_rows(docs: DataFrame, **how: object) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (to the nearest whole number; it cuts two documents a segment)."""
    taken = mix(docs, **how).where("size > 0").groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("n"))
    names = {c: fresh(docs, f"mix_{c}") for c in ("id", "source", "size", "times", "turn")}
    times = taken.select(F.col("doc_id").alias(names["id"]), F.col("source").alias(names["source"]), F.col("size").alias(names["size"]),
                         F.round(F.col("taken") / (F.col("n") * F.col("size"))).cast("int").alias(names["times"])).where(F.col(names["times"]) > 0)
    own = F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD)).cast("long")
    joined = docs.join(times, docs["doc_id"].eqNullSafe(F.col(names["id"])) & docs["source"].eqNullSafe(F.col(names["source"])) & (own == F.col(names["size"])))
    return joined.withColumn(names["turn"], F.explode(F.sequence(F.lit(1), F.col(names["times"])))).select(*docs.columns)


# What the query and the pipeline mix to.
PRODUCTION = {"weights": [5, 2, 1], "share": 1.5, "most": 2.0, "block": 16, "seed": "mix", "shards": 24}


def op4_apportioned_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, sources weighing 5, 2, 1 in turn, 150 % of all words, at most twice each; ``shards`` is a list of shard:words."""
    listed = F.array_join(F.transform("shards", lambda s: F.concat_ws(":", s["shard"].cast("string"), s["words"].cast("string"))), ",")
    return mix(read(spark, folder, "documents"), **PRODUCTION).select("doc_id", "size", "source_size", "target", "taken", listed.alias("shards"))


ORACLE = r"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS mixed FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
sized AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS lim FROM sizes),
share AS (SELECT sum(source_size) * 1.5::DOUBLE AS budget FROM sizes),
-- share what is left by weight among those below their limit, again and again
fill AS (
  SELECT 0 AS step, (SELECT list(source_size * 0.0::DOUBLE ORDER BY source NULLS LAST) FROM sized) AS capped, -1 AS found
  UNION ALL
  SELECT step + 1,
    (SELECT list(CASE WHEN c > 0 OR lim <= lvl * weight THEN lim ELSE 0 END ORDER BY source NULLS LAST) FROM (
      SELECT source, lim, weight, c, ((SELECT budget FROM share) - sum(c) OVER ()) / nullif(sum(CASE WHEN c > 0 THEN 0 ELSE weight END) OVER (), 0) AS lvl
      FROM (SELECT source, lim, weight, fill.capped[row_number() OVER (ORDER BY source NULLS LAST)] AS c FROM sized))),
    len(list_filter(capped, lambda x: x > 0))
  FROM fill WHERE found < len(list_filter(capped, lambda x: x > 0))),
last_ AS (SELECT capped FROM fill ORDER BY step DESC LIMIT 1),
targeted AS (
  SELECT source, source_size, CASE WHEN c > 0 THEN lim ELSE coalesce(least(lim, ((SELECT budget FROM share) - sum(c) OVER ()) / nullif(sum(CASE WHEN c > 0 THEN 0 ELSE weight END) OVER (), 0) * weight), lim) END AS target
  FROM (SELECT *, (SELECT capped FROM last_)[row_number() OVER (ORDER BY source NULLS LAST)] AS c FROM sized)),
quotients AS (
  SELECT source, target, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS place
  FROM targeted, range(0, (SELECT ceil(max(target) / 16 + 2)::BIGINT FROM targeted)) r(k) WHERE target > 0),
quota AS (
  SELECT t.source, t.source_size, t.target, coalesce((SELECT count(*) FROM quotients q WHERE q.source IS NOT DISTINCT FROM t.source
      AND q.place <= (SELECT round(sum(target) / 16) FROM targeted)), 0) AS blocks FROM targeted t),
seats AS (
  SELECT q.*, s AS shard, blocks // 24 + CASE WHEN (s - start_ % 24 + 24) % 24 < blocks % 24 THEN 1 ELSE 0 END AS won
  FROM (SELECT *, coalesce(sum(blocks) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_ FROM quota) q, range(24) r(s)),
cuts AS (
  SELECT *, sum(won) OVER (PARTITION BY source ORDER BY shard)::HUGEINT AS upto FROM seats WHERE won > 0),
bounds AS (
  SELECT source, shard, won, (source_size::HUGEINT * (upto - won) // blocks)::BIGINT AS low, (source_size::HUGEINT * upto // blocks)::BIGINT AS high FROM cuts),
segments AS (
  SELECT source, shard, low, high - low AS s, least(won * 16, 2 * (high - low)) AS words,
    (('0x' || substr(md5('mix/start/' || shard || '/' || coalesce(source, '')), 1, 15))::BIGINT % greatest((high - low) // 16, 1)) * 16 AS run
  FROM bounds WHERE high > low),
placed AS (
  SELECT r.doc_id, r.size, q.source, q.source_size, q.target, row_number() OVER () AS place,
    coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.mixed, r.doc_id, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_
  FROM rows_ r JOIN quota q ON r.source IS NOT DISTINCT FROM q.source),
met AS (
  SELECT p.place, g.*, least(greatest(p.first_ - low, 0), s) AS a, least(greatest(p.first_ + p.size - low, 0), s) AS b
  FROM placed p JOIN segments g ON p.source IS NOT DISTINCT FROM g.source AND g.low < p.first_ + p.size AND g.low + g.s > p.first_),
worth AS (
  SELECT place, shard, ((words // s) * (b - a)
    + least(greatest(b - run, 0), words % s) + least(b, greatest(run + words % s - s, 0))
    - least(greatest(a - run, 0), words % s) - least(a, greatest(run + words % s - s, 0)))::BIGINT AS words FROM met),
summed AS (
  SELECT place, sum(words)::BIGINT AS taken, string_agg(shard || ':' || words, ',' ORDER BY shard) AS shards FROM worth WHERE words > 0 GROUP BY place)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, coalesce(shards, '') AS shards FROM placed LEFT JOIN summed USING (place)
"""
