"""Full load and daily refresh of the fund feed, each one flow from landed responses to finished tables.

Counts of a run are observed while its tables are written; nothing is read a second time for them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge
from . import feed, responses
from .tables import Lake

_ORDER = ["fetched_at", "raw_id", "pos"]
_KEYS = ["scheme_code", "nav_date"]
MARKS = "nav_marks"
RUN_OUTCOME = "load_outcome"


def _one() -> Column:
    return F.count(F.lit(1)).alias("n")


class FundLoad:
    """Loads into ``lake``: dim_mf_scheme, fact_mf_nav, mf_nav_ref, dq_quarantine, marks and the outcome of every scheme."""

    def __init__(self, lake: Lake):
        self.lake = lake
        self.spark: SparkSession = lake.spark

    # --- shared steps -----------------------------------------------------------------------------

    def _outcomes(self, schemes: DataFrame, bronze: DataFrame, more: DataFrame | None, run_at: dt.datetime) -> Observation:
        """Store per scheme whether it could be loaded, and why not. ``more``: scheme_code and n_new of a refresh."""
        found = responses.outcomes(bronze).groupBy("scheme_code").agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(F.col("outcome") != "malformed").alias("_ok"))
        rows = schemes.select("scheme_code").join(found, "scheme_code", "left")
        reason = F.when(F.col("_n").isNull(), "no response").when(F.col("_ok") == 0, "no response could be parsed")
        status = F.when(reason.isNotNull(), "FAILED")
        if more is None:
            rows = rows.select("scheme_code", F.coalesce(status, F.lit("OK")).alias("status"), reason.alias("reason"))
        else:
            rows = rows.join(more, "scheme_code", "left").select(
                "scheme_code", F.coalesce(status, F.when(F.col("n_new") > 0, "OK").otherwise("NO_NEW_ROWS")).alias("status"), reason.alias("reason"))
        seen = Observation()
        counted = rows.withColumn("run_at", F.lit(run_at).cast("timestamp_ntz")).observe(
            seen, _one(), *[F.count_if(F.col("status") == s).alias(s) for s in ("OK", "NO_NEW_ROWS", "FAILED")])
        self.lake.overwrite(RUN_OUTCOME, counted)
        return seen

    def _quarantine(self, parts: list[DataFrame], run_at: dt.datetime) -> Observation:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        seen = Observation()
        self.lake.merge("dq_quarantine", rows.withColumn("quarantined_at", F.lit(run_at).cast("timestamp_ntz")), ["quarantine_id"], True, seen=seen)
        return seen

    def _store_prices(self, rows: DataFrame) -> tuple[Observation, Observation]:
        """Prices into silver (what is on file stays) and into the mirror (the newest wins), and marks moved up."""
        new, synced = Observation(), Observation()
        self.lake.merge("fact_mf_nav", rows, _KEYS, True, seen=new)
        self.lake.merge("mf_nav_ref", rows.select(*_KEYS, "nav_value"), _KEYS, False, seen=synced)
        self.lake.raise_marks(MARKS, rows, "scheme_code", "nav_date")
        return new, synced

    def failed(self) -> DataFrame:
        """Schemes that the last run could not load."""
        return self.lake.read(RUN_OUTCOME).where("status = 'FAILED'").select("scheme_code", "reason")

    def _summary(self, values: dict[str, int]) -> DataFrame:
        schema = T.StructType([T.StructField("metric", T.StringType()), T.StructField("value", T.LongType())])
        return self.spark.createDataFrame(list(values.items()), schema)

    # --- the two runs -----------------------------------------------------------------------------

    def full_load(self, catalogue: DataFrame, bronze: DataFrame, run_at: dt.datetime, seed: int, limit: int) -> DataFrame:
        """Load a seeded choice of ``catalogue`` (schemeCode, schemeName) from landed ``bronze`` responses."""
        universe = Observation()
        self.lake.overwrite("mf_catalogue", catalogue.observe(universe, _one()))
        named = self.lake.read("mf_catalogue").where("schemeCode <> '' and schemeName <> ''").select(F.col("schemeCode").cast("string").alias("scheme_code"))
        self.lake.overwrite("mf_curated", feed.seeded_sample(named, seed, limit))
        schemes = self.lake.read("mf_curated")
        self.lake.append("mf_api_raw", bronze.join(schemes, "scheme_code", "left_semi"))
        raw = self.lake.read("mf_api_raw")
        outcome = self._outcomes(schemes, raw, None, run_at)

        meta = responses.classified(raw).where("outcome <> 'malformed'").select("meta.*").distinct()
        dims = Observation()
        self.lake.merge("dim_mf_scheme", feed.scheme_rows(meta), ["scheme_code"], False, seen=dims)
        checked = self.lake.staged("checked", feed.checked_prices(responses.price_rows(raw)))
        tried = Observation()
        flagged = self.lake.staged("flagged", feed.orphan_flag(feed.clean_prices(checked, _ORDER), self.lake.read("dim_mf_scheme")).observe(
            tried, _one(), F.count_if("is_orphan").alias("orphaned")))
        new, synced = self._store_prices(flagged.where("not is_orphan").drop("is_orphan"))
        kept = self._quarantine([
            feed.quarantined_prices(checked, _ORDER), feed.quarantined_orphans(flagged.where("is_orphan")), feed.quarantined_schemes(meta),
            responses.quarantined_responses(raw)], run_at)
        status = outcome.get
        return self._summary({
            "universe_size": universe.get["n"], "curated_schemes": status["n"], "schemes_succeeded": status["OK"], "schemes_failed": status["FAILED"],
            "dim_rows_upserted": dims.get["n"], "nav_rows_attempted": tried.get["n"], "nav_rows_orphaned_anti_join": tried.get["orphaned"],
            "nav_rows_upserted": new.get["n"], "quarantine_rows_written": kept.get["n"], "core_mf_nav_ref_synced": synced.get["n"],
        })

    def daily_refresh(self, bronze: DataFrame, run_at: dt.datetime) -> DataFrame:
        """Take in what is newer than each scheme's mark from newly landed responses of known schemes."""
        self.lake.require_rows("dim_mf_scheme")
        schemes = self.lake.read("dim_mf_scheme").select("scheme_code")
        raw = self.lake.staged("responses", bronze.join(schemes, "scheme_code", "left_semi"))
        self.lake.append("mf_api_raw", raw)
        checked = self.lake.staged("checked", feed.checked_prices(responses.price_rows(raw)))
        clean = feed.clean_prices(checked, _ORDER)
        flagged = merge.against_watermark(clean, self.lake.read(MARKS), "scheme_code", "nav_date")
        fresh = self.lake.staged("fresh", flagged.where("is_new").select(*clean.columns))
        outcome = self._outcomes(schemes, raw, fresh.groupBy("scheme_code").agg(F.count(F.lit(1)).alias("n_new")), run_at)
        new, synced = self._store_prices(fresh)
        kept = self._quarantine([feed.quarantined_prices(checked, _ORDER), responses.quarantined_responses(raw)], run_at)
        status = outcome.get
        return self._summary({
            "schemes_checked": status["n"], "schemes_with_new_rows": status["OK"], "schemes_no_new_rows": status["NO_NEW_ROWS"],
            "schemes_failed": status["FAILED"], "nav_rows_upserted": new.get["n"], "quarantine_rows_written": kept.get["n"],
            "core_mf_nav_ref_synced": synced.get["n"],
        })
