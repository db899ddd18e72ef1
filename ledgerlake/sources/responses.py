"""Feed responses as they really come: some are no JSON, some hold no prices, some are very long.

No response is lost: each one is ``parsed``, ``empty`` or ``malformed``, and what is not parsed goes to quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import stable_id
from ..schemas import FEED_PAYLOAD

#: Texts above this many bytes are cut into entries before they are parsed, and the entries dealt to all tasks.
LARGE_BYTES = 4 << 20

_META = [f.name for f in FEED_PAYLOAD["meta"].dataType.fields]
_FIELDS = ["raw_id", "scheme_code", "fetched_at"]


def classified(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scheme responses with ``body`` (variant), ``outcome``, ``meta`` and ``entries`` (array of variants)."""
    # What ``inline`` gives is worked out once a row: a filter on the outcome would else be moved below and parse anew.
    rows = bronze.where("endpoint = 'mf_scheme'").select(
        *_FIELDS, *keep, "payload", F.inline(F.array(F.struct(F.try_parse_json("payload").alias("body")))))
    rows = rows.select("*", F.inline(F.array(F.struct(
        F.try_variant_get("body", "$.data", "variant").alias("data"), F.try_variant_get("body", "$.data", "array<variant>").alias("entries")))))
    data, entries = F.col("data"), F.col("entries")
    is_object = F.schema_of_variant("body").startswith("OBJECT")
    outcome = (
        F.when(F.col("body").isNull() | ~F.coalesce(is_object, F.lit(False)), "malformed")
        .when(data.isNull() | F.is_variant_null(data), "empty")
        .when(entries.isNull(), "malformed").when(F.size(entries) == 0, "empty").otherwise("parsed")
    )
    meta = F.struct(*[F.try_variant_get("body", f"$.meta.{name}", "string").alias(name) for name in _META])
    return rows.select(*_FIELDS, *keep, "payload", outcome.alias("outcome"), meta.alias("meta"), entries.alias("entries"))


def outcomes(bronze: DataFrame) -> DataFrame:
    """What became of every response: raw_id, scheme_code, outcome, n_entries."""
    rows = classified(bronze)
    return rows.select("raw_id", "scheme_code", "outcome", F.when(F.col("outcome") == "parsed", F.size("entries")).otherwise(0).alias("n_entries"))


def _entries(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    told = rows.where("outcome = 'parsed'").select(*_FIELDS, *keep, "meta", F.posexplode("entries").alias("pos", "entry"))
    return told.select(*_FIELDS, *keep, "meta", "pos", *[F.try_variant_get("entry", f"$.{c}", "string").alias(c) for c in ("date", "nav")])


def price_rows(bronze: DataFrame, keep: Sequence[str] = (), large: int = LARGE_BYTES) -> DataFrame:
    """One row per price entry of all parsed responses, with its place in the response.

    A long text is cut where one entry ends and the next begins; its entries are parsed wherever they are dealt to. A
    cut that fell into a quoted text leaves pieces that are no JSON; such a response is parsed as a whole.
    """
    keep = list(keep)
    is_large = F.coalesce(F.octet_length("payload") > large, F.lit(False))
    whole = _entries(classified(bronze.where(~is_large), keep), keep)
    long = bronze.where(is_large & F.col("endpoint").eqNullSafe("mf_scheme"))
    shape = r'(?s)^(.*?"data"\s*:\s*\[)(.*)(\][^\[\]]*)$'
    cut = long.select(*_FIELDS, *keep, F.concat(F.regexp_extract("payload", shape, 1), F.regexp_extract("payload", shape, 3)).alias("shell"),
                      F.posexplode(F.split(F.trim(F.regexp_extract("payload", shape, 2)), r"(?<=\})\s*,\s*(?=\{)")).alias("pos", "text"))
    dealt = cut.repartition("raw_id", "pos").withColumn("entry", F.try_parse_json("text")).withColumn("frame", F.try_parse_json("shell"))
    sound = F.coalesce(F.schema_of_variant("entry").startswith("OBJECT") & F.schema_of_variant("frame").startswith("OBJECT"), F.lit(False))
    broken = dealt.groupBy("raw_id").agg(F.every(sound).alias("ok")).where("not ok").select("raw_id")
    meta = F.struct(*[F.try_variant_get("frame", f"$.meta.{name}", "string").alias(name) for name in _META])
    in_parts = dealt.join(broken, "raw_id", "left_anti").select(
        *_FIELDS, *keep, meta.alias("meta"), "pos", *[F.try_variant_get("entry", f"$.{c}", "string").alias(c) for c in ("date", "nav")])
    again = _entries(classified(long.join(broken, "raw_id", "left_semi"), keep), keep)
    return whole.unionByName(in_parts).unionByName(again)


def quarantined_responses(bronze: DataFrame) -> DataFrame:
    """Responses without a usable price list, as quarantine rows; the raw text can be found by its raw_id."""
    lost = classified(bronze).where("outcome <> 'parsed'")
    said = F.when(F.col("outcome") == "empty", "response holds no prices").otherwise("response is not a JSON object with a list of prices")
    return lost.select(
        stable_id("", F.lit("bronze.mf_api_raw"), F.col("raw_id")).alias("quarantine_id"), F.lit("bronze.mf_api_raw").alias("source_table"),
        F.to_json(F.struct("raw_id", "scheme_code")).alias("raw_payload"), said.alias("reason"))
