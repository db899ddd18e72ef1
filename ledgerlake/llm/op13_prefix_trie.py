"""Conversation prefix trie: every distinct beginning of conversations, counted by ROLLUP over positional turn columns.

A turn is a hash of role and text followed by the text's code points, so texts never move. Turns of a conversation
lie in blocks of eight positions, one row each, and ``GROUP BY block, prior node, ROLLUP (t1, ..., t8)`` gives all
prefixes of all blocks together, told apart by ``grouping_id``. A node is named by its depth and two 64-bit
exclusive-ors of position-tagged turn hashes; so the key of the prior block's node is known for every block at once,
however long a conversation is, and blocks need no loop.

What concerns a subtree comes from members as well. Members share all nodes above the point where they part, and a
conversation that is the smallest member of a node is so of all deeper nodes on its path. Summed over a node's
members, code points from that node on to where each becomes its nodes' smallest member count every node of the
subtree once for each member but one: that is the saving, and a second ROLLUP over suffix sums yields it. A leaf is
counted by its smallest member in the same pass.

Hot keys: positions come from ranges of (conversation, turn), so a conversation of any size is spread; hot turns and
prefixes meet map-side combined; a node's parent is one row on the other side of a join that adaptive execution can
split. Conversations that end at one node are listed in chunks of 65536 ids; one task streams a node's chunks through
SHA-256, which is sequential by definition, and holds one chunk at a time.

Defined cases: null roles and texts are empty; a null turn comes first, equal turns go by their hash; a null conversation
id belongs to no conversation; repeated rows are turns of their own; an empty table has no node, not even the root;
ids are whole numbers; extra columns do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import read, written

#: Positions of a block. A row is written out once for each of them, plus one, before prefixes are combined.
WIDTH = 8
#: Ids of one chunk lie in a range of this size.
CHUNK = 65_536
ROWS_PER_RANGE = 200_000
#: A block's number divided by this is the unit in which marks of long conversations are added up.
BLOCKS_PER_BUCKET = 1_024

T = [f"t{i}" for i in range(1, WIDTH + 1)]


# --- turns and where they stand -------------------------------------------------------------------


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of a hash of role and text, in hex, then the text's code points."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.length(text).cast("string"))


def _chars(turn: Column) -> Column:
    return F.coalesce(F.substring(turn, 33, 20).cast("long"), F.lit(0).cast("long"))


def _mark(depth: Column, turn: Column) -> list[Column]:
    """What a turn at a place adds to the name of every prefix that holds it."""
    return [F.coalesce(F.xxhash64(depth, turn), F.lit(0)), F.coalesce(F.xxhash64(turn, depth, F.lit(13)), F.lit(0))]


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, within, turn id) of every turn, and (conv_id, part, start): within + start is its place from 0.

    Ranges of (conversation, turn) are written before they are numbered, so a repeated task finds the same ones.
    """
    rows = written(turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_id(F.col("role"), F.col("text")).alias("tid")), "trie-turns")
    ranges = rows.count() // ROWS_PER_RANGE + rows.sparkSession.sparkContext.defaultParallelism
    dealt = written(rows.repartitionByRange(int(ranges), "conv_id", F.col("turn").asc_nulls_first(), "tid")
                    .withColumn("part", F.spark_partition_id()), "trie-ranges")
    order = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "tid")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    starts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return dealt.select("conv_id", "part", (F.row_number().over(order) - 1).cast("long").alias("within"), "tid"), starts


Rebuild = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def as_they_are(placed: DataFrame, starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations unchanged: (conv_id of all, conv_id and depth and turn of all turns)."""
    turns = placed.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("start") + F.col("within") + 1).alias("depth"), "tid")
    return starts.select("conv_id").distinct(), turns


def with_borrowed_heads(group: int, most: int) -> Rebuild:
    """Conversation c takes its first h turns from conversation c - c % ``group``; h is crc32(c) % ``most``.

    A base lends to fewer than twice ``group`` conversations, and lends fewer than ``most`` turns.
    """

    def rebuild(placed: DataFrame, starts: DataFrame) -> tuple[DataFrame, DataFrame]:
        heads = (
            placed.join(starts, ["conv_id", "part"]).withColumn("pos", F.col("start") + F.col("within")).where(F.col("pos") < most - 1)
            .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "tid"))).alias("head"))
            .select(F.col("conv_id").alias("base"), "head"))
        convs = starts.select("conv_id").distinct().select(
            "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
            (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
        lent = written(
            convs.join(heads, "base", "left")
            .select("conv_id", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,tid:string>>")), F.lit(1), F.col("h").cast("int")).alias("head")),
            "trie-heads")
        first = lent.select("conv_id", F.inline("head")).select("conv_id", (F.col("pos") + 1).alias("depth"), "tid")
        # What is known of a conversation goes to its ranges first: a conversation has few of them, however long it is.
        known = starts.join(lent.select("conv_id", "h", F.size("head").alias("k")), "conv_id")
        own = placed.join(known, ["conv_id", "part"]).withColumn("pos", F.col("start") + F.col("within")).where("pos >= h")
        return lent.select("conv_id"), first.unionAll(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k") + 1).alias("depth"), "tid"))

    return rebuild


# --- blocks ---------------------------------------------------------------------------------------


def _xor(parts: list[Column]) -> Column:
    total = parts[0]
    for part in parts[1:]:
        total = total.bitwiseXOR(part)
    return total


def blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, block, t1 to t8, and of all earlier blocks of the conversation: x1, x2 (name), c0 (code points)."""
    place = turns.select("conv_id", F.floor((F.col("depth") - 1) / WIDTH).alias("block"), "depth", ((F.col("depth") - 1) % WIDTH + 1).alias("at"), "tid")
    marks = _mark(F.col("depth"), F.col("tid"))
    wide = place.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("at") == i + 1, F.col("tid"))).alias(t) for i, t in enumerate(T)],
        *[F.bit_xor(m).alias(f"m{i + 1}") for i, m in enumerate(marks)], F.sum(_chars(F.col("tid"))).alias("c"))
    turnless = convs.join(wide.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("block"), *[F.lit(None).cast("string").alias(t) for t in T],
        *[F.lit(0).cast("long").alias(c) for c in ("m1", "m2", "c")])
    rows = written(wide.unionByName(turnless).withColumn("bucket", F.floor(F.col("block") / BLOCKS_PER_BUCKET)), "trie-blocks")
    within = Window.partitionBy("conv_id", "bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(window, names):
        zero = F.lit(0).cast("long")
        return [F.coalesce(F.bit_xor(names[0]).over(window), zero), F.coalesce(F.bit_xor(names[1]).over(window), zero),
                F.coalesce(F.sum(names[2]).over(window), zero)]

    totals = rows.groupBy("conv_id", "bucket").agg(F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2"), F.sum("c").alias("c"))
    enter = totals.select("conv_id", "bucket", *[c.alias(n) for c, n in zip(so_far(before, ["m1", "m2", "c"]), ("b1", "b2", "b3"))])
    inside = rows.select("*", *[c.alias(n) for c, n in zip(so_far(within, ["m1", "m2", "c"]), ("w1", "w2", "w3"))])
    return inside.join(enter, ["conv_id", "bucket"]).select(
        "conv_id", "block", *T, F.col("w1").bitwiseXOR(F.col("b1")).alias("x1"), F.col("w2").bitwiseXOR(F.col("b2")).alias("x2"),
        (F.col("w3") + F.col("b3")).alias("c0"), "m1", "m2", "c")


def _rolled(rows: DataFrame, extra: str) -> DataFrame:
    """All prefixes of all blocks: level (turns of the prefix within its block), block, x1, x2, t1.., and ``extra``."""
    columns = ", ".join(T)
    grouped = rows.sparkSession.sql(
        f"SELECT block, x1, x2, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, count(*) AS n_convs, min(conv_id) AS conv_id, {extra} "
        f"FROM {{rows}} GROUP BY block, x1, x2, ROLLUP ({columns})", rows=rows)
    # A conversation that has ended has no prefix at that level; the root is the first block without any turn.
    last = F.element_at(F.array(*T), F.greatest(F.col("level"), F.lit(1)).cast("int"))
    return grouped.withColumn("last", F.when(F.col("level") > 0, last)).where("last is not null or (level = 0 and block = 0)")


def _named(nodes: DataFrame) -> DataFrame:
    """Add depth, the node's name (n1, n2) and its parent's (p1, p2)."""
    first = F.col("block") * WIDTH
    marks = [_mark(first + i + 1, F.col(t)) for i, t in enumerate(T)]
    zero = F.lit(0).cast("long")
    named = {"depth": first + F.col("level")}
    for k in (0, 1):
        own = _xor([F.when(F.col("level") >= i + 1, m[k]).otherwise(zero) for i, m in enumerate(marks)])
        above = _xor([F.when(F.col("level") > i + 1, m[k]).otherwise(zero) for i, m in enumerate(marks)])
        named[f"n{k + 1}"], named[f"p{k + 1}"] = F.col(f"x{k + 1}").bitwiseXOR(own), F.col(f"x{k + 1}").bitwiseXOR(above)
    return nodes.withColumns(named)


# --- which conversations end where ----------------------------------------------------------------


def _stream_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks come node by node in order; one digest per node."""
    node, digest = None, None

    def row(node, digest):
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in node] + [pa.array([digest.hexdigest()])], names=["depth", "n1", "n2", "ends_sha256"])

    for batch in batches:
        done = []
        for depth, n1, n2, ids in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("depth", "n1", "n2", "ids")]):
            if (depth, n1, n2) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, n1, n2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["depth", "n1", "n2", "ends_sha256"])
    if node is not None:
        yield row(node, digest)


def _ends(rows: DataFrame) -> DataFrame:
    """depth, n1, n2 and ends_sha256 of every node at which a conversation ends."""
    turns = sum((F.col(t).isNotNull().cast("long") for t in T), F.lit(0).cast("long"))
    last = F.max(F.struct("block", (F.col("block") * WIDTH + turns).alias("depth"), F.col("x1").bitwiseXOR(F.col("m1")).alias("n1"),
                          F.col("x2").bitwiseXOR(F.col("m2")).alias("n2")))
    ending = rows.groupBy("conv_id").agg(last.alias("e")).select("conv_id", "e.depth", "e.n1", "e.n2")
    chunks = ending.groupBy("depth", "n1", "n2", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    dealt = chunks.repartition("depth", "n1", "n2").sortWithinPartitions("depth", "n1", "n2", "chunk")
    return dealt.mapInArrow(_stream_hash, "depth long, n1 long, n2 long, ends_sha256 string")


# --- the trie -------------------------------------------------------------------------------------

NO_END = hashlib.sha256(b"").hexdigest()


def trie(conversations: DataFrame, rebuild: Rebuild = as_they_are) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is the smallest id of its members and its depth. ``rebuild`` may change conversations before.
    """
    convs, turns = rebuild(*numbered(conversations))
    rows = written(blocks(convs, turns), "trie-rows")
    path = " + ".join(f"coalesce(cast(substring({t}, 33, 20) AS bigint), 0)" for t in T)
    nodes = written(
        _named(_rolled(rows, "max(c0) AS c0")).select(
            "depth", "n1", "n2", "p1", "p2", "conv_id", (F.col("c0") + F.expr(path) - _chars(F.col("last"))).alias("above")), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count("*").alias("n_children"))
    counted = written(nodes.join(children, ["depth", "n1", "n2"], "left").select(
        "*", F.coalesce("n_children", F.lit(0)).cast("long").alias("children")).drop("n_children"), "trie-counted")
    # From its first own node on a conversation is its nodes' smallest member; code points before that are shared with
    # a smaller one. A conversation without a node of its own equals a smaller one and shares all it has.
    owned = counted.groupBy("conv_id").agg(F.min(F.struct("depth", "above"))["above"].alias("shared"), F.max((F.col("children") == 0).cast("long")).alias("leaf"))
    whole = rows.groupBy("conv_id").agg(F.sum("c").alias("whole"))
    known = whole.join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("shared", "whole").alias("shared"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"))
    suffix, gone = {}, F.col("c0")
    for i, t in enumerate(T):
        suffix[f"s{i + 1}"] = F.greatest(F.col("shared") - gone, F.lit(0))
        gone = gone + _chars(F.col(t))
    sums = ", ".join(f"sum(s{i + 1})" for i in range(WIDTH))
    summed = _named(_rolled(rows.join(known, "conv_id").withColumns(suffix), f"sum(leaf) AS n_leaves, sum(shared) AS s0, array({sums}) AS s"))
    saved = F.when(F.col("level") == 0, F.col("s0")).otherwise(F.element_at("s", F.greatest(F.col("level"), F.lit(1)).cast("int")))
    named = ["depth", "n1", "n2"]
    ends = counted.select(*named, F.col("children").alias("n_children")).join(_ends(rows), named, "left")
    parents = counted.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return summed.select(*named, "p1", "p2", "conv_id", "n_convs", "n_leaves", saved.alias("saved_tokens")).join(ends, named).join(
        parents, ["depth", "p1", "p2"], "left"
    ).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
             F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256"))


def op13_rollup_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, each with up to five turns borrowed from the first of its hundred."""
    return trie(read(spark, folder, "conversations"), with_borrowed_heads(100, 6))


#: The same in DuckDB: paths are strings of turn hashes, a subtree is what starts with a path.
ORACLE = """
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i::UBIGINT, [0,1,2,3,4,5,6,7]::UBIGINT[]),
      lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
raw AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS h, length(coalesce(text, '')) AS c
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, substr(h, 1, 32) || c AS tid, c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(h, 1, 32) || c) - 1 AS pos FROM raw),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::UBIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255::UBIGINT)::BIGINT + 1])), 4294967295::UBIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM raw), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS side, t.pos, t.tid, t.c FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.tid, t.c FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, c, string_agg(tid || '/', '') OVER (w ROWS UNBOUNDED PRECEDING) AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY side, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ended AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max_by(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(c) AS c,
    CASE WHEN depth > 1 THEN array_to_string(string_split(path, '/')[1:depth - 1], '/') || '/' WHEN depth = 1 THEN '' END AS above
  FROM paths GROUP BY path, depth),
counted AS (SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.above = n.path) AS n_children FROM nodes n),
below AS (
  SELECT n.path, count(*) FILTER (WHERE s.n_children = 0) AS n_leaves, sum((s.n_convs - 1) * s.c)::BIGINT AS saved_tokens
  FROM counted n JOIN counted s ON starts_with(s.path, n.path) GROUP BY n.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted n JOIN below b USING (path) LEFT JOIN ended e USING (path) LEFT JOIN nodes p ON p.path = n.above
"""
