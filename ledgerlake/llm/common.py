"""Shared by the operators here: written intermediate tables, connected components, distributed running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import new_folder


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage is cut and every later use sees the same rows."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """16 bytes that stand for a whole text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def running_start(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of a group that come before, by (bucket, order).

    A group may be any size: rows are ordered only within (group, bucket), and buckets are added up from one small
    row each. ``df`` is read twice, so it must be a written table or cheap and deterministic.
    """
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_total"))
    starts = totals.select(*[F.col(c).alias(f"_{c}") for c in [*group, bucket]],
                           F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, bucket]]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    within = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(starts, condition)
        .withColumn(name, F.col("_start") + F.col("_within"))
        .drop("_within", "_start", *[f"_{c}" for c in [*group, bucket]])
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``; returns (node, root), root being the smallest node.

    Alternates two contractions until nothing changes: every neighbour above a node is hung on the node's smallest
    neighbour, then every neighbour at or below it. Smallest neighbours are map-side combined minima, and hubs are
    only ever the skewed side of a join whose other side has one row per node. Every round is a written table.
    """
    edges = written(edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        wide = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = wide.groupBy("a").agg(F.min("b").alias("m"))
        hung = wide.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = written(hung.unionAll(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
