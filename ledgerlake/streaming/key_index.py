"""Idempotency without an end: every key ever accepted, in an index of which a batch reads what may concern it.

Keys are dealt into buckets by hash, and each bucket has a Bloom filter of fixed size. A batch asks the filters first
and reads only those buckets that may hold one of its keys; the index decides, so a wrong hint costs a read and no row.
Entries of four batches are merged into one run, four runs into a larger one, hence a bucket lies in a few files for
each power of four batches. A batch owns its folders and writes the same again when it is run again; which runs exist
follows from the number of batches alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Runs that are merged into one.
FAN_IN = 4


def runs(batches: int) -> list[tuple[int, int]]:
    """The runs (first batch, end) that cover ``batches`` batches, large ones first."""
    found, at, size = [], 0, 1
    while size * FAN_IN <= batches:
        size *= FAN_IN
    while size:
        while at + size <= batches:
            found.append((at, at + size))
            at += size
        size //= FAN_IN
    return found


class KeyIndex:
    """Keys below ``root``. ``words`` 64-bit words a bucket have to suit the number of keys; more buckets mean less read."""

    def __init__(self, spark: SparkSession, root: str, key: T.StructType, buckets: int = 64, words: int = 1_024, hashes: int = 4):
        self.spark, self.root, self.key = spark, root, key
        self.buckets, self.words, self.hashes = buckets, words, hashes
        #: Buckets that the last batch read.
        self.read: list[int] = []

    def _names(self) -> list[str]:
        return self.key.names

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self._names(), F.lit("bucket")), F.lit(self.buckets)).cast("int")

    def _bits(self, keys: DataFrame) -> DataFrame:
        """(bucket, word, bit mask) of every key, one row for each of its hashes."""
        at = [F.pmod(F.xxhash64(*self._names(), F.lit(i)), F.lit(self.words * 64)) for i in range(self.hashes)]
        spread = keys.select("*", F.explode(F.array(*at)).alias("_at"))
        return spread.withColumns({"word": F.shiftright("_at", 6).cast("int"), "mask": F.expr("shiftleft(1L, cast(_at & 63 as int))")}).drop("_at")

    def _run(self, run: tuple[int, int]) -> DataFrame:
        schema = T.StructType([*self.key.fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/keys/{run[0]}-{run[1]}")

    def _write(self, keys: DataFrame, run: tuple[int, int]) -> None:
        keys.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/keys/{run[0]}-{run[1]}")

    def _filter(self, batches: int) -> DataFrame:
        return self.spark.read.schema("bucket int, word int, bits bigint").parquet(f"{self.root}/filters/{batches}")

    def unseen(self, keys: DataFrame, batch: int) -> DataFrame:
        """Of distinct ``keys`` those that no earlier batch has added. ``keys`` must be cheap to read again."""
        keys = keys.select(*self._names()).withColumn("bucket", self._bucket())
        self.read = []
        if batch == 0:
            return keys.select(*self._names())
        hits = self._bits(keys).join(self._filter(batch), ["bucket", "word"], "left")
        held = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
        maybe = hits.groupBy(*self._names(), "bucket").agg(F.every(held).alias("_all")).where("_all")
        # As many values at most as there are buckets.
        self.read = sorted(r[0] for r in maybe.select("bucket").distinct().collect())
        if not self.read:
            return keys.select(*self._names())
        parts = [self._run(run).where(F.col("bucket").isin(self.read)) for run in runs(batch)]
        past = reduce(lambda a, b: a.unionByName(b), parts)
        return keys.join(past, [*self._names(), "bucket"], "left_anti").select(*self._names())

    def add(self, keys: DataFrame, batch: int) -> None:
        """Enter distinct new ``keys`` as those of ``batch``, and merge runs that are due."""
        keys = keys.select(*self._names()).withColumn("bucket", self._bucket())
        self._write(keys, (batch, batch + 1))
        own = self._bits(keys).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        if batch > 0:
            own = own.unionByName(self._filter(batch)).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        own.write.mode("overwrite").parquet(f"{self.root}/filters/{batch + 1}")
        size = FAN_IN
        while (batch + 1) % size == 0:
            step = size // FAN_IN
            parts = [self._run((at, at + step)) for at in range(batch + 1 - size, batch + 1, step)]
            self._write(reduce(lambda a, b: a.unionByName(b), parts), (batch + 1 - size, batch + 1))
            size *= FAN_IN


class UnboundedDedupe:
    """Keeps the first use of every key, however long ago it was, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], **index):
        self.spark, self.root, self.schema = spark, root, schema
        self.keys, self.order = list(keys), list(order)
        self.index = KeyIndex(spark, f"{root}/index", T.StructType([schema[k] for k in keys]), **index)
        #: Buckets read per batch since this object was made.
        self.log: dict[int, int] = {}

    def _stage(self, name: str, df: DataFrame, batch: int) -> DataFrame:
        path = f"{self.root}/{name}/batch_id={batch}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def take_in(self, rows: DataFrame, batch: int) -> None:
        rest = [c for c in rows.columns if c not in (*self.keys, *self.order)]
        named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        # One row per key and batch, combined map-side; a request without a key repeats nothing.
        top = F.min(F.struct(*self.order, *rest)).alias("_first")
        alone = rows.where(~named)
        first = rows.where(named).groupBy(*self.keys).agg(top).select(*self.keys, "_first.*").select(*rows.columns)
        first = self._stage("seen", first, batch)
        unseen = self._stage("unseen", self.index.unseen(first.select(*self.keys), batch), batch)
        first.join(unseen, self.keys, "left_semi").unionByName(alone).write.mode("overwrite").parquet(f"{self.root}/kept/batch_id={batch}")
        self.index.add(unseen, batch)
        self.log[batch] = len(self.index.read)

    def run(self, landing: str):
        """Take in every landed file not seen before, then stop."""
        return (
            self.spark.readStream.schema(self.schema).parquet(landing).writeStream.foreachBatch(self.take_in)
            .option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        )

    def kept(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/kept").drop("batch_id")
