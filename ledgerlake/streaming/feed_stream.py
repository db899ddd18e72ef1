"""Fund feed as a stream of landed files: bronze text to silver prices and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import feed
from ..sources.tables import Lake

LANDED = "raw_id string, endpoint string, scheme_code string, seq bigint, payload string, fetched_at timestamp_ntz"


def silver_stream(spark: SparkSession, landing: str, lake: Lake, checkpoint: str) -> StreamingQuery:
    """Take in every landed file not seen before, then stop.

    Each micro-batch is cleaned and merged insert-if-absent, so a batch that is run again after a failure
    adds nothing twice. ``seq`` orders responses, the position orders the entries of one.
    """

    def take_in(batch: DataFrame, _batch_id: int) -> None:
        order = ["seq", "pos"]
        checked = feed.checked_prices(feed.parse_raw(batch, keep=["seq"]))
        lake.merge("fact_mf_nav", feed.clean_prices(checked, order), ["scheme_code", "nav_date"], keep_existing=True)
        lake.merge("dq_quarantine", feed.quarantined_prices(checked, order), ["quarantine_id"], keep_existing=True)

    return (
        spark.readStream.schema(LANDED).json(landing)
        .writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
