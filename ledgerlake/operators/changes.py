"""Change data capture: differences of a table as a log, and a copy that is kept up by applying it.

An entry holds its key, what was done (insert, update, delete), the values before and after, and a sequence number that
rises per key. Applying an entry asks only whether its number is above the one on file, so entries may arrive twice,
late, or in any order. Deleted keys stay as tombstones: an old entry cannot bring them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import Lake


def capture(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str], number: int) -> DataFrame:
    """Entries that turn ``before`` into ``after``; both have one row per key."""
    keys, values = list(keys), list(values)
    # Stacked and grouped: both sides meet by key without a join, and rows that are alike on both sides leave no entry.
    sides = [df.select(*keys, F.lit(side).alias("_side"), F.struct(*values).alias("_row")) for side, df in enumerate((before, after))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("_side") == side, F.col("_row"))).alias(name) for side, name in enumerate(("before", "after"))],
        *[F.count_if(F.col("_side") == side).alias(f"_n{side}") for side in (0, 1)])
    op = F.when(F.col("_n0") == 0, "insert").when(F.col("_n1") == 0, "delete").when(~F.col("before").eqNullSafe(F.col("after")), "update")
    return both.withColumn("op", op).where("op is not null").select(
        *keys, "op", "before", "after", F.lit(number).cast("long").alias("seq"))


class Copy:
    """A copy of a table in ``lake``: keys, values, ``seq`` of the last change and ``deleted``."""

    def __init__(self, lake: Lake, table: str, keys: Sequence[str], values: Sequence[str]):
        self.lake, self.table, self.keys, self.values = lake, table, list(keys), list(values)

    def apply(self, entries: DataFrame, _batch: int = 0) -> None:
        """Bring the copy up to date with ``entries``."""
        rest = [F.col(f"_e.after.{v}").alias(v) for v in self.values]
        # Of several entries for a key the one with the highest number says what it is now.
        last = entries.groupBy(*self.keys).agg(F.max(F.struct("seq", F.col("op").alias("op"), "after")).alias("_e"))
        rows = self.lake.staged(f"{self.table}-entries", last.select(
            *self.keys, *rest, F.col("_e.seq").alias("seq"), (F.col("_e.op") == "delete").alias("deleted")))
        if self.lake.exists(self.table):
            known = self.lake.read_months_of(self.table, rows).select(*self.keys, F.col("seq").alias("_on_file"))
            rows = rows.join(known, self.keys, "left").where(F.col("_on_file").isNull() | (F.col("seq") > F.col("_on_file"))).drop("_on_file")
        self.lake.merge(self.table, rows, self.keys, keep_existing=False)

    def rows(self) -> DataFrame:
        """The rows that are there now."""
        return self.lake.read(self.table).where("not deleted").select(*self.keys, *self.values, "seq")

    def follow(self, spark: SparkSession, landing: str, schema, checkpoint: str) -> StreamingQuery:
        """Apply every landed file of entries not seen before, then stop."""
        return (
            spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )

