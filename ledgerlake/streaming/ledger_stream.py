"""Deposit requests as a stream of landed files; repeats within a time span dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

REQUESTS = (
    "request_id bigint, account_id bigint, txn_datetime timestamp_ntz, amount decimal(18,2), dr_cr string, channel string, "
    "idempotency_key string"
)


def read_requests(spark: SparkSession, landing: str) -> DataFrame:
    return spark.readStream.schema(REQUESTS).parquet(landing)


def first_of_key(requests: DataFrame, time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Drop repeats that arrive within ``delay``. The state holds keys no longer than that, and rows older than the
    watermark are dropped unseen: where neither may happen, see ``key_index``."""
    timed = requests.withColumn("_event_time", F.col(time).cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
