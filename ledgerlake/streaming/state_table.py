"""State of a stream as a table: sums and maxima per key, of which a batch reads the buckets its own keys fall into.

Keys are dealt into buckets by hash. A batch adds one run of entries; entries of four batches are merged into one run and
four runs into a larger one, as in ``key_index``, hence a bucket lies in a few files for each power of four batches. A
batch owns its folders and writes the same again when it is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .key_index import FAN_IN, runs

BUCKETS = 32


class StateTable:
    """Entries below ``root``: ``schema`` has the keys and the values, ``merge`` says how two values of a key become one."""

    def __init__(self, spark: SparkSession, root: str, schema: str, merge: dict[str, Callable[[str], Column]], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.merge, self.buckets = spark, root, schema, merge, buckets
        #: Buckets that the last batch read.
        self.read: list[int] = []

    def _bucket(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _run(self, run: tuple[int, int]) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self.root}/{run[0]}-{run[1]}")

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{run[0]}-{run[1]}")

    def _merged(self, parts: Sequence[DataFrame]) -> DataFrame:
        stack = reduce(lambda a, b: a.unionByName(b), parts)
        keys = [c for c in stack.columns if c not in self.merge]
        return stack.groupBy(*keys).agg(*[f(c).alias(c) for c, f in self.merge.items()]) if len(parts) > 1 else stack

    def known(self, keys: DataFrame, batch: int) -> DataFrame:
        """Entries that earlier batches made, at least those of ``keys``, which must be cheap to read again."""
        self.read = []
        if batch > 0:
            # As many values at most as there are buckets.
            self.read = sorted(r[0] for r in keys.select(self._bucket(keys.columns).alias("bucket")).distinct().collect())
        if not self.read:
            return self.spark.createDataFrame([], self.schema)
        return self._merged([self._run(run).where(F.col("bucket").isin(self.read)) for run in runs(batch)]).drop("bucket")

    def put(self, rows: DataFrame, batch: int) -> None:
        """Enter ``rows``, one for each key, as those of ``batch``, and merge runs that are due."""
        self._write(rows.withColumn("bucket", self._bucket([c for c in rows.columns if c not in self.merge])), (batch, batch + 1))
        size = FAN_IN
        while (batch + 1) % size == 0:
            step = size // FAN_IN
            parts = [self._run((at, at + step)) for at in range(batch + 1 - size, batch + 1, step)]
            self._write(self._merged(parts), (batch + 1 - size, batch + 1))
            size *= FAN_IN
