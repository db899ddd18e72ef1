"""Fund feed: landed JSON to bronze, bronze to silver rows and quarantine rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import feed_date, missing, nav_key, option_of, plan_of, positive_nav, stable_id
from ..schemas import FEED_LIST, FEED_PAYLOAD


# --- bronze ---------------------------------------------------------------------------------------


def read_scheme_list(spark: SparkSession, path: str) -> DataFrame:
    """Landed fund catalogue files."""
    return spark.read.schema(FEED_LIST).json(path)


def raw_rows(payloads: DataFrame, endpoint: str, keep: Sequence[str] = ()) -> DataFrame:
    """Bronze rows from (scheme_code, payload text, fetched_at) and the columns to ``keep``.

    The id repeats when a landing is repeated."""
    code = F.col("scheme_code").cast("string")
    return payloads.select(
        stable_id("", F.lit(endpoint), code, F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"), F.col("payload")).alias("raw_id"),
        F.lit(endpoint).alias("endpoint"), code.alias("scheme_code"), "payload", "fetched_at", *keep,
    )


def latest_raw(bronze: DataFrame) -> DataFrame:
    """Newest response per scheme, once, however often it was landed. Only ids are grouped before the payload moves."""
    newest = bronze.where("endpoint = 'mf_scheme'").groupBy("scheme_code").agg(
        F.max(F.struct("fetched_at", "raw_id"))["raw_id"].alias("raw_id")
    )
    # Rows with one id are equal: the id is a hash of all they hold.
    return bronze.join(newest.select("raw_id"), "raw_id", "left_semi").dropDuplicates(["raw_id"])


def parse_raw(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per price entry: response id, meta fields, position in the response, raw date and price text."""
    body = bronze.where("endpoint = 'mf_scheme'").select(
        "raw_id", F.col("scheme_code").alias("asked_code"), "fetched_at", *keep, F.from_json("payload", FEED_PAYLOAD).alias("body")
    )
    return body.select(
        "raw_id", "asked_code", "fetched_at", *keep, "body.meta", F.posexplode("body.data").alias("pos", "entry")
    ).select("raw_id", F.col("asked_code").alias("scheme_code"), "fetched_at", *keep, "meta", "pos", "entry.date", "entry.nav")


# --- silver: prices -------------------------------------------------------------------------------


def checked_prices(rows: DataFrame) -> DataFrame:
    """Cast the raw texts; ``problem`` is bad_date, bad_nav or null."""
    cast = rows.withColumn("nav_date", feed_date(F.col("date"))).withColumn("nav_value", positive_nav(F.col("nav")))
    return cast.withColumn(
        "problem", F.when(F.col("nav_date").isNull(), "bad_date").when(F.col("nav_value").isNull(), "bad_nav")
    )


def clean_prices(checked: DataFrame, order: Sequence[str]) -> DataFrame:
    """One price per scheme and date, the last in ``order``. Combined map-side, so a large scheme is no problem."""
    best = checked.where("problem is null").groupBy("scheme_code", "nav_date").agg(
        F.max(F.struct(*order, "nav_value"))["nav_value"].alias("nav_value")
    )
    return best.select(nav_key(F.col("scheme_code"), F.col("nav_date")).alias("nav_id"), "scheme_code", "nav_date", "nav_value")


def _quarantine(rows: DataFrame, table: str, identity: Sequence[Column], payload: Column, reason: Column) -> DataFrame:
    return rows.select(
        stable_id("", F.lit(table), *identity).alias("quarantine_id"), F.lit(table).alias("source_table"),
        payload.alias("raw_payload"), reason.alias("reason"),
    )


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("None"))


def quarantined_prices(checked: DataFrame, order: Sequence[str]) -> DataFrame:
    """Unusable price rows with the raw text and the reason; a rerun gives the same ids."""
    # The wording of the two reasons.
    bad_date = F.concat(F.lit("unparseable nav_date '"), _shown("date"), F.lit("' for scheme "), "scheme_code")
    bad_nav = F.concat(
        F.lit("invalid nav_value '"), _shown("nav"), F.lit("' for scheme "), "scheme_code", F.lit(" on "), _shown("date")
    )
    return _quarantine(
        checked.where("problem is not null"), "silver.fact_mf_nav",
        [F.col("scheme_code"), *[F.col(c) for c in order]], F.to_json(F.struct("date", "nav")),
        F.when(F.col("problem") == "bad_date", bad_date).otherwise(bad_nav),
    )


def orphan_flag(rows: DataFrame, schemes: DataFrame) -> DataFrame:
    """Rows with ``is_orphan``: valid and orphan rows from one join instead of a semi and an anti join."""
    known = schemes.select("scheme_code").distinct().withColumn("_known", F.lit(True))
    return rows.join(known, "scheme_code", "left").withColumn("is_orphan", F.col("_known").isNull()).drop("_known")


def quarantined_orphans(orphans: DataFrame) -> DataFrame:
    reason = F.concat(F.lit("scheme_code "), "scheme_code", F.lit(" not present among the known schemes"))
    payload = F.to_json(F.struct("scheme_code", "nav_date", "nav_value"))
    return _quarantine(orphans, "silver.fact_mf_nav", [F.lit("orphan"), F.col("scheme_code"), F.col("nav_date")], payload, reason)


# --- silver: schemes ------------------------------------------------------------------------------


def _incomplete() -> Column:
    return missing(F.col("scheme_code")) | missing(F.col("scheme_name")) | missing(F.col("fund_house"))


def _optional(meta: DataFrame, name: str) -> Column:
    return F.col(name) if name in meta.columns else F.lit(None).cast("string").alias(name)


def scheme_rows(meta: DataFrame) -> DataFrame:
    """Scheme dimension from meta fields, plan and option read out of the name."""
    name = F.col("scheme_name")
    return meta.where(~_incomplete()).select(
        F.col("scheme_code").cast("string").alias("scheme_code"), "scheme_name", F.col("fund_house").alias("amc_name"),
        _optional(meta, "scheme_category"), _optional(meta, "scheme_type"),
        plan_of(name).alias("plan"), option_of(name).alias("option"),
        F.coalesce(F.nullif(F.col("isin_growth"), F.lit("")), F.nullif(F.col("isin_div_reinvestment"), F.lit(""))).alias("isin"),
    )


def quarantined_schemes(meta: DataFrame) -> DataFrame:
    body = F.to_json(F.struct(*meta.columns))
    lacking = F.array_compact(F.array(*[F.when(missing(F.col(c)), c) for c in ("scheme_code", "scheme_name", "fund_house")]))
    reason = F.concat(F.lit("scheme without "), F.array_join(lacking, ", "))
    return _quarantine(meta.where(_incomplete()), "silver.dim_mf_scheme", [body], body, reason)


def seeded_sample(schemes: DataFrame, seed: int, size: int, code: str = "scheme_code") -> DataFrame:
    """A repeatable draw of ``size`` codes: the lowest keyed hashes win, whatever the file order."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(code)))
    return schemes.select(code).distinct().orderBy(draw, code).limit(size).orderBy(F.col(code).cast("long"))


# --- corrections ----------------------------------------------------------------------------------


def apply_corrections(quarantined: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Re-run the casts on quarantined price rows with corrected texts.

    ``quarantined``: quarantine_id, scheme_code, date, nav. ``corrections``: quarantine_id, field_corrected,
    new_value, corrected_at, corrected_by. Returns the rechecked rows and the correction log.
    """
    log = corrections.join(quarantined, "quarantine_id").select(
        stable_id("COR_", F.col("quarantine_id"), F.col("field_corrected")).alias("correction_id"),
        "quarantine_id", "field_corrected",
        F.when(F.col("field_corrected") == "date", F.col("date")).otherwise(F.col("nav")).alias("old_value"),
        "new_value", "corrected_at", "corrected_by",
    )
    def latest(field: str) -> Column:
        mine = F.when(F.col("field_corrected") == field, F.struct("corrected_at", "new_value"))
        return F.max(mine)["new_value"].alias(f"_{field}")
    fixes = corrections.groupBy("quarantine_id").agg(latest("date"), latest("nav"))
    mended = quarantined.join(fixes, "quarantine_id", "left")
    for name in ("date", "nav"):
        mended = mended.withColumn(name, F.coalesce(F.col(f"_{name}"), F.col(name)))
    return checked_prices(mended.drop("_date", "_nav")), log


def store_corrections(lake, quarantined: DataFrame, corrections: DataFrame, order: Sequence[str]) -> None:
    """Apply corrections to a lake: the log is kept, rows that are now sound go to silver unless their day is on file."""
    mended, log = apply_corrections(quarantined, corrections)
    lake.merge("dq_correction_log", log, ["correction_id"], keep_existing=True)
    lake.merge("fact_mf_nav", clean_prices(lake.staged("mended", mended), order), ["scheme_code", "nav_date"], keep_existing=True)
