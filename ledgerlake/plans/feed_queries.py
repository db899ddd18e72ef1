"""Registered queries of the fund feed: bronze, silver, merges and incremental loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge
from ..operators.quality import duplicate_keys, stacked
from ..session import new_folder
from ..sources import feed, responses
from ..sources.calendar import dim_date
from ..sources.load import FundLoad
from ..sources.tables import Lake
from .registry import Bank, dbl, query, sql_over

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# --- Spark side -----------------------------------------------------------------------------------


def checked(bank: Bank) -> DataFrame:
    return feed.checked_prices(bank.fx_raw_nav)


def prices(bank: Bank) -> DataFrame:
    return feed.clean_prices(checked(bank), LINE)


def first_load(bank: Bank) -> DataFrame:
    """The first three lines of every order are one load of the feed, the others a second one."""
    return feed.clean_prices(checked(bank).where("l_linenumber <= 3"), LINE)


def second_load(bank: Bank) -> DataFrame:
    return feed.clean_prices(checked(bank).where("l_linenumber > 3"), LINE)


def schemes(bank: Bank) -> DataFrame:
    return feed.scheme_rows(bank.fx_scheme_meta)


def payloads(bank: Bank, raw: DataFrame | None = None) -> DataFrame:
    """One feed response per scheme and order: an order has a handful of lines, so the lists stay short."""
    raw = bank.fx_raw_nav if raw is None else raw
    # Dealt by order alone, lines lie as the grouping and the join with their order both need them.
    entries = raw.repartition("l_orderkey").groupBy("scheme_code", "l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "date", "nav"))).alias("_lines")
    )
    body = F.to_json(F.struct(
        F.struct("scheme_code").alias("meta"),
        F.transform("_lines", lambda e: F.struct(e["date"].alias("date"), e["nav"].alias("nav"))).alias("data"),
        F.lit("SUCCESS").alias("status"),
    ))
    fetched = bank.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("fetched_at"))
    return entries.select("scheme_code", "l_orderkey", body.alias("payload")).join(fetched, "l_orderkey")


def bronze(bank: Bank) -> DataFrame:
    return feed.raw_rows(payloads(bank), "mf_scheme")


# --- SQL side -------------------------------------------------------------------------------------

CAST_SQL = """
nav_cast AS (SELECT r.*, CAST(try_strptime(date, '%d-%m-%Y') AS DATE) AS nav_date, TRY_CAST(nav AS DECIMAL(14,5)) AS v FROM fx_raw_nav r)
"""


def clean_sql(name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (SELECT scheme_code || ':' || CAST(nav_date AS VARCHAR) AS nav_id, scheme_code, nav_date, v AS nav_value FROM (
  SELECT *, row_number() OVER (PARTITION BY scheme_code, nav_date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM nav_cast WHERE nav_date IS NOT NULL AND v > 0 AND {where}) WHERE rn = 1)
"""


NAV_SQL = CAST_SQL + "," + clean_sql("nav_clean")
LOADS_SQL = CAST_SQL + "," + clean_sql("nav_first", "l_linenumber <= 3") + "," + clean_sql("nav_second", "l_linenumber > 3")
SILVER_SQL = LOADS_SQL + """,
silver AS (SELECT * FROM nav_first UNION ALL SELECT * FROM nav_second s WHERE NOT EXISTS (SELECT 1 FROM nav_first f WHERE f.scheme_code = s.scheme_code AND f.nav_date = s.nav_date)),
mirror AS (SELECT * FROM nav_second UNION ALL SELECT * FROM nav_first s WHERE NOT EXISTS (SELECT 1 FROM nav_second f WHERE f.scheme_code = s.scheme_code AND f.nav_date = s.nav_date))
"""
SCHEME_SQL = """
schemes AS (
  SELECT scheme_code, scheme_name, fund_house AS amc_name,
    CASE WHEN regexp_matches(scheme_name, '(?i)\\bDIRECT\\b') THEN 'Direct' WHEN regexp_matches(scheme_name, '(?i)\\bREGULAR\\b') THEN 'Regular' END AS plan,
    CASE WHEN regexp_matches(scheme_name, '(?i)\\bGROWTH\\b') THEN 'Growth' WHEN regexp_matches(scheme_name, '(?i)\\b(DIVIDEND|IDCW)\\b') THEN 'Dividend' END AS "option",
    CASE WHEN isin_growth <> '' THEN isin_growth ELSE NULLIF(isin_div_reinvestment, '') END AS isin
  FROM fx_scheme_meta WHERE scheme_code <> '' AND scheme_name <> '' AND fund_house <> '')
"""
PAYLOAD_SQL = """
payload_rows AS (
  SELECT r.scheme_code, r.l_orderkey, o.o_orderdate AS fetched_at,
    '{"meta":{"scheme_code":"' || r.scheme_code || '"},"data":[' ||
    string_agg('{"date":"' || r.date || '","nav":"' || r.nav || '"}', ',' ORDER BY r.l_linenumber, r.l_partkey, r.l_suppkey, r.date, r.nav) ||
    '],"status":"SUCCESS"}' AS payload
  FROM fx_raw_nav r JOIN orders o ON o.o_orderkey = r.l_orderkey GROUP BY r.scheme_code, r.l_orderkey, o.o_orderdate),
bronze AS (
  SELECT sha256('mf_scheme|' || scheme_code || '|' || strftime(fetched_at, '%Y-%m-%d %H:%M:%S') || '|' || payload) AS raw_id,
    'mf_scheme' AS endpoint, scheme_code, payload, fetched_at FROM payload_rows)
"""


# --- bronze ---------------------------------------------------------------------------------------


@query("bronze_land_raw", sql_over("fx_raw_nav", PAYLOAD_SQL + "SELECT * FROM bronze"))
def _land_raw(bank):
    lake = Lake(bank.spark, new_folder(bank.spark, "land"))
    lake.append("mf_api_raw", bronze(bank))
    return lake.read("mf_api_raw")


@query("bronze_latest_payload", sql_over("fx_raw_nav", PAYLOAD_SQL + """
SELECT raw_id, scheme_code, payload, fetched_at FROM (
  SELECT *, row_number() OVER (PARTITION BY scheme_code ORDER BY fetched_at DESC, raw_id DESC) AS rn FROM bronze) WHERE rn = 1"""))
def _latest_payload(bank):
    return feed.latest_raw(bronze(bank)).select("raw_id", "scheme_code", "payload", "fetched_at")


@query("bronze_parse_payload", sql_over("fx_raw_nav", """
SELECT r.scheme_code, o.o_orderdate AS fetched_at, r.scheme_code AS meta_code,
  CAST(row_number() OVER (PARTITION BY r.scheme_code, r.l_orderkey ORDER BY r.l_linenumber, r.l_partkey, r.l_suppkey, r.date, r.nav) - 1 AS INTEGER) AS pos, r.date, r.nav
FROM fx_raw_nav r JOIN orders o ON o.o_orderkey = r.l_orderkey""".strip()))
def _parse_payload(bank):
    return feed.parse_raw(bronze(bank)).select(
        "scheme_code", "fetched_at", F.col("meta.scheme_code").alias("meta_code"), "pos", "date", "nav"
    )


# Responses of which some are cut off, some empty, some a list, and all of one scheme unusable. The scheme of a price
# list is known by its meta; one lacks its fund house.
_CUT, _EMPTY, _LIST = "(l_orderkey % 97 = 0 OR scheme_code = '5')", "l_orderkey % 89 = 0", "l_orderkey % 83 = 0"


def real_bronze(bank: Bank) -> DataFrame:
    """One response per scheme and order as a feed would really send them, landed at the order's date."""
    told = bank.fx_scheme_meta.select(
        F.col("scheme_code").alias("_code"), "scheme_name", F.when(F.col("scheme_code") != "3", F.col("fund_house")).alias("fund_house"), "isin_growth", "isin_div_reinvestment")
    rows = payloads(bank).join(told, F.col("scheme_code") == F.col("_code"), "left")
    meta = F.to_json(F.struct("scheme_code", "scheme_name", "fund_house", "isin_growth", "isin_div_reinvestment"))
    data = F.get_json_object("payload", "$.data")
    body = F.concat(F.lit('{"meta":'), meta, F.lit(',"data":'), F.when(F.expr(_EMPTY), F.lit("[]")).otherwise(data), F.lit("}"))
    sent = F.when(F.expr(_CUT), F.expr("substring(payload, 1, length(payload) - 5)")).when(F.expr(_LIST), data).otherwise(body)
    landed = rows.withColumn("payload", sent)
    return feed.raw_rows(landed, "mf_scheme", keep=["l_orderkey"])


REAL_SQL = PAYLOAD_SQL + f""",
sent AS (SELECT scheme_code, l_orderkey, fetched_at, CASE WHEN {_CUT} OR {_LIST} THEN 'malformed' WHEN {_EMPTY} THEN 'empty' ELSE 'parsed' END AS outcome FROM payload_rows)
"""


@query("payload_outcomes", sql_over("fx_raw_nav", REAL_SQL + """
SELECT s.scheme_code, s.outcome, count(*) AS n_responses, CAST(coalesce(sum(n.n) FILTER (WHERE s.outcome = 'parsed'), 0) AS BIGINT) AS n_entries,
  count(*) FILTER (WHERE s.outcome <> 'parsed') AS n_quarantined
FROM sent s JOIN (SELECT scheme_code, l_orderkey, count(*) AS n FROM fx_raw_nav GROUP BY ALL) n ON n.scheme_code = s.scheme_code AND n.l_orderkey = s.l_orderkey
GROUP BY s.scheme_code, s.outcome"""))
def _payload_outcomes(bank):
    """What became of every response: those in equal those parsed, empty and malformed, and what is not parsed is in quarantine."""
    lake = Lake(bank.spark, new_folder(bank.spark, "outcomes"))
    raw = lake.staged("bronze", real_bronze(bank))
    found = responses.outcomes(raw).groupBy("scheme_code", "outcome").agg(F.count(F.lit(1)).alias("n_responses"))
    told = responses.price_rows(raw).groupBy("scheme_code").agg(F.count(F.lit(1)).alias("_entries")).withColumn("outcome", F.lit("parsed"))
    lost = responses.quarantined_responses(raw)
    kind = F.when(F.col("reason").startswith("response holds"), "empty").otherwise("malformed")
    shut = lost.groupBy(F.get_json_object("raw_payload", "$.scheme_code").alias("scheme_code"), kind.alias("outcome")).agg(F.count(F.lit(1)).alias("_shut"))
    keys = ["scheme_code", "outcome"]
    return found.join(told, keys, "left").join(shut, keys, "left").select(
        *keys, "n_responses", F.coalesce("_entries", F.lit(0)).alias("n_entries"), F.coalesce("_shut", F.lit(0)).alias("n_quarantined"))


# Prices of the usable responses, by first load (even orders) and refresh (odd orders).
LOAD_SQL = REAL_SQL + "," + SCHEME_SQL.replace("FROM fx_scheme_meta WHERE", "FROM (SELECT * REPLACE (CASE WHEN scheme_code <> '3' THEN fund_house END AS fund_house) FROM fx_scheme_meta) m WHERE") + "," + CAST_SQL + """,
curated AS (SELECT DISTINCT scheme_code FROM fx_scheme_meta WHERE scheme_code <> '' AND scheme_name <> ''),
usable AS (SELECT n.*, n.nav_date IS NOT NULL AND n.v > 0 AS good, n.l_orderkey % 2 = 0 AS first FROM nav_cast n JOIN sent s ON s.scheme_code = n.scheme_code AND s.l_orderkey = n.l_orderkey AND s.outcome = 'parsed'),
told AS (SELECT DISTINCT scheme_code FROM sent WHERE outcome <> 'malformed' AND l_orderkey % 2 = 0),
dims AS (SELECT s.scheme_code FROM schemes s JOIN curated c USING (scheme_code) JOIN told USING (scheme_code)),
one AS (SELECT DISTINCT scheme_code, nav_date FROM usable JOIN curated USING (scheme_code) WHERE good AND first),
stored AS (SELECT * FROM one JOIN dims USING (scheme_code)),
marks AS (SELECT scheme_code, max(nav_date) AS mark FROM stored GROUP BY scheme_code),
two AS (SELECT DISTINCT u.scheme_code, u.nav_date FROM usable u JOIN dims USING (scheme_code) LEFT JOIN marks m ON m.scheme_code = u.scheme_code WHERE u.good AND NOT u.first AND (m.mark IS NULL OR u.nav_date > m.mark)),
-- An empty response that is landed twice at one time is one response.
heard AS (SELECT DISTINCT scheme_code FROM sent WHERE outcome <> 'malformed' AND l_orderkey % 2 <> 0)
"""
FULL_SQL = LOAD_SQL + """
SELECT 'universe_size' AS metric, count(*) AS value FROM fx_scheme_meta
UNION ALL SELECT 'curated_schemes', count(*) FROM curated
UNION ALL SELECT 'schemes_succeeded', count(*) FROM curated JOIN told USING (scheme_code)
UNION ALL SELECT 'schemes_failed', (SELECT count(*) FROM curated) - (SELECT count(*) FROM curated JOIN told USING (scheme_code))
UNION ALL SELECT 'dim_rows_upserted', count(*) FROM dims
UNION ALL SELECT 'nav_rows_attempted', count(*) FROM one
UNION ALL SELECT 'nav_rows_orphaned_anti_join', (SELECT count(*) FROM one) - (SELECT count(*) FROM stored)
UNION ALL SELECT 'nav_rows_upserted', count(*) FROM stored
UNION ALL SELECT 'quarantine_rows_written', (SELECT count(*) FROM usable JOIN curated USING (scheme_code) WHERE first AND NOT coalesce(good, FALSE))
  + (SELECT count(*) FROM one) - (SELECT count(*) FROM stored) + (SELECT count(*) FROM told JOIN curated USING (scheme_code)) - (SELECT count(*) FROM dims)
  + (SELECT count(DISTINCT scheme_code || CASE WHEN outcome = 'empty' THEN CAST(fetched_at AS VARCHAR) ELSE CAST(l_orderkey AS VARCHAR) END) FROM sent JOIN curated USING (scheme_code) WHERE outcome <> 'parsed' AND l_orderkey % 2 = 0)
UNION ALL SELECT 'core_mf_nav_ref_synced', count(*) FROM stored"""


def _loaded(bank: Bank) -> tuple[FundLoad, DataFrame, DataFrame]:
    load = FundLoad(Lake(bank.spark, new_folder(bank.spark, "load")))
    raw = load.lake.staged("landing", real_bronze(bank))
    catalogue = bank.fx_scheme_meta.select(F.col("scheme_code").alias("schemeCode"), F.col("scheme_name").alias("schemeName"))
    first = raw.where("l_orderkey % 2 = 0").drop("l_orderkey")
    # The limit lies above the number of schemes: a choice of some is what seeded_sample shows.
    return load, load.full_load(catalogue, first, dt.datetime(2002, 1, 1), 42, 1_000_000), raw.where("l_orderkey % 2 <> 0").drop("l_orderkey")


@query("full_load_run", sql_over("fx_raw_nav fx_scheme_meta", FULL_SQL))
def _full_load(bank):
    """The first load as one flow: what its run reports."""
    return _loaded(bank)[1]


@query("daily_refresh_run", sql_over("fx_raw_nav fx_scheme_meta", LOAD_SQL + """
SELECT 'schemes_checked' AS metric, CAST(NULL AS VARCHAR) AS scheme_code, count(*) AS value FROM dims
UNION ALL SELECT 'schemes_with_new_rows', NULL, count(DISTINCT scheme_code) FROM two
UNION ALL SELECT 'schemes_no_new_rows', NULL, (SELECT count(*) FROM dims JOIN heard USING (scheme_code)) - (SELECT count(DISTINCT scheme_code) FROM two)
UNION ALL SELECT 'schemes_failed', NULL, (SELECT count(*) FROM dims) - (SELECT count(*) FROM dims JOIN heard USING (scheme_code))
UNION ALL SELECT 'nav_rows_upserted', NULL, count(*) FROM two
UNION ALL SELECT 'quarantine_rows_written', NULL, (SELECT count(*) FROM usable JOIN dims USING (scheme_code) WHERE NOT first AND NOT coalesce(good, FALSE))
  + (SELECT count(DISTINCT scheme_code || CASE WHEN outcome = 'empty' THEN CAST(fetched_at AS VARCHAR) ELSE CAST(l_orderkey AS VARCHAR) END) FROM sent JOIN dims USING (scheme_code) WHERE outcome <> 'parsed' AND l_orderkey % 2 <> 0
    AND NOT (outcome = 'empty' AND EXISTS (SELECT 1 FROM sent b WHERE b.outcome = 'empty' AND b.l_orderkey % 2 = 0 AND b.scheme_code = sent.scheme_code AND b.fetched_at = sent.fetched_at)))
UNION ALL SELECT 'core_mf_nav_ref_synced', NULL, count(*) FROM two
UNION ALL SELECT 'mark ' || max(d), scheme_code, count(*) FROM (SELECT scheme_code, nav_date, max(nav_date) OVER (PARTITION BY scheme_code) AS d FROM (SELECT * FROM stored UNION ALL SELECT * FROM two)) GROUP BY scheme_code"""))
def _daily_refresh(bank):
    """A refresh after the first load: what its run reports, and each scheme's mark with the prices then on file."""
    load, _, later = _loaded(bank)
    summary = load.daily_refresh(later, dt.datetime(2002, 1, 2))
    on_file = load.lake.read("fact_mf_nav").groupBy("scheme_code").agg(F.count(F.lit(1)).alias("value"))
    marks = load.lake.read("nav_marks").join(on_file, "scheme_code").select(
        F.concat(F.lit("mark "), F.date_format("watermark", "yyyy-MM-dd")).alias("metric"), "scheme_code", "value")
    return summary.select("metric", F.lit(None).cast("string").alias("scheme_code"), "value").unionByName(marks)


# --- silver ---------------------------------------------------------------------------------------


@query("silver_nav_clean", sql_over("fx_raw_nav", NAV_SQL + """
SELECT nav_id, scheme_code, nav_date, CAST(nav_value AS DOUBLE) AS nav_value FROM nav_clean"""))
def _nav_clean(bank):
    return prices(bank).withColumn("nav_value", dbl("nav_value"))


@query("silver_nav_quarantine", sql_over("fx_raw_nav", CAST_SQL + """
SELECT sha256('silver.fact_mf_nav|' || scheme_code || '|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey) AS quarantine_id,
  'silver.fact_mf_nav' AS source_table, '{"date":"' || date || '","nav":"' || nav || '"}' AS raw_payload,
  CASE WHEN nav_date IS NULL THEN 'unparseable nav_date ''' || date || ''' for scheme ' || scheme_code
       ELSE 'invalid nav_value ''' || nav || ''' for scheme ' || scheme_code || ' on ' || date END AS reason
FROM nav_cast WHERE nav_date IS NULL OR v IS NULL OR v <= 0"""))
def _nav_quarantine(bank):
    return feed.quarantined_prices(checked(bank), LINE)


@query("silver_dim_scheme", sql_over("fx_scheme_meta", SCHEME_SQL + "SELECT * FROM schemes"))
def _dim_scheme(bank):
    return schemes(bank).drop("scheme_category", "scheme_type")


@query("orphan_split", sql_over("fx_raw_nav fx_scheme_meta", NAV_SQL + "," + SCHEME_SQL + """
SELECT n.scheme_code, n.nav_date, s.scheme_code IS NULL AS is_orphan FROM nav_clean n LEFT JOIN schemes s ON s.scheme_code = n.scheme_code"""))
def _orphan_split(bank):
    return feed.orphan_flag(prices(bank), schemes(bank)).select("scheme_code", "nav_date", "is_orphan")


@query("schemes_by_amc", sql_over("fx_scheme_meta", SCHEME_SQL + """
SELECT amc_name, scheme_code, CAST(count(*) OVER (PARTITION BY amc_name) AS BIGINT) AS n_schemes FROM schemes"""))
def _schemes_by_amc(bank):
    # Long form: a list per fund house would put a large house into one cell.
    listed = schemes(bank).select("amc_name", "scheme_code").distinct()
    sizes = listed.groupBy("amc_name").agg(F.count(F.lit(1)).alias("n_schemes"))
    return listed.join(sizes, "amc_name")


@query("seeded_sample", sql_over("fx_scheme_meta", """
SELECT scheme_code FROM (SELECT DISTINCT scheme_code FROM fx_scheme_meta WHERE scheme_name <> '')
ORDER BY md5('42:' || scheme_code), scheme_code LIMIT 50""".strip()))
def _seeded_sample(bank):
    return feed.seeded_sample(bank.fx_scheme_meta.where("scheme_name <> ''"), 42, 50)


@query("load_run_summary", sql_over("fx_raw_nav fx_scheme_meta", NAV_SQL + "," + SCHEME_SQL + """
SELECT 'bad_date' AS outcome, count(*) AS n_rows FROM nav_cast WHERE nav_date IS NULL
UNION ALL SELECT 'bad_nav', count(*) FROM nav_cast WHERE nav_date IS NOT NULL AND (v IS NULL OR v <= 0)
UNION ALL SELECT 'superseded', (SELECT count(*) FROM nav_cast WHERE nav_date IS NOT NULL AND v > 0) - (SELECT count(*) FROM nav_clean)
UNION ALL SELECT 'orphaned', count(*) FROM nav_clean n WHERE NOT EXISTS (SELECT 1 FROM schemes s WHERE s.scheme_code = n.scheme_code)
UNION ALL SELECT 'loaded', count(*) FROM nav_clean n WHERE EXISTS (SELECT 1 FROM schemes s WHERE s.scheme_code = n.scheme_code)"""))
def _load_run_summary(bank):
    return merge_summary(checked(bank), schemes(bank))


def merge_summary(rows: DataFrame, dims: DataFrame) -> DataFrame:
    """Rows of a load by what became of them, from one grouping of the feed."""
    by_date = rows.groupBy("scheme_code", "nav_date", "problem").agg(F.count(F.lit(1)).alias("n"))
    flagged = feed.orphan_flag(by_date, dims)
    good = F.col("problem").isNull()
    total = flagged.agg(
        F.sum(F.when(F.col("problem") == "bad_date", F.col("n"))).alias("bad_date"),
        F.sum(F.when(F.col("problem") == "bad_nav", F.col("n"))).alias("bad_nav"),
        F.sum(F.when(good, F.col("n") - 1)).alias("superseded"),
        F.count_if(good & F.col("is_orphan")).alias("orphaned"),
        F.count_if(good & ~F.col("is_orphan")).alias("loaded"),
    )
    names = ["bad_date", "bad_nav", "superseded", "orphaned", "loaded"]
    pairs = F.array(*[F.struct(F.lit(n).alias("outcome"), F.coalesce(n, F.lit(0)).alias("n_rows")) for n in names])
    return total.select(F.inline(pairs))


@query("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
  dayofweek(d) IN (0, 6) AS is_weekend, d = last_day(d) AS is_month_end
FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)""")
def _dim_date(bank):
    return dim_date(bank.orders, "o_orderdate", "o_orderdate")


# --- merges ---------------------------------------------------------------------------------------


def loaded_lake(bank: Bank, keep_existing: bool) -> Lake:
    lake = Lake(bank.spark, new_folder(bank.spark, "nav"))
    for load in (first_load(bank), second_load(bank)):
        lake.merge("fact_mf_nav", load, ["scheme_code", "nav_date"], keep_existing)
    return lake


def _priced(df: DataFrame) -> DataFrame:
    return df.select("scheme_code", "nav_date", dbl("nav_value"))


@query("upsert_ignore", sql_over("fx_raw_nav", SILVER_SQL + "SELECT scheme_code, nav_date, CAST(nav_value AS DOUBLE) AS nav_value FROM silver"))
def _upsert_ignore(bank):
    return _priced(loaded_lake(bank, keep_existing=True).read("fact_mf_nav"))


@query("upsert_replace", sql_over("fx_raw_nav", SILVER_SQL + "SELECT scheme_code, nav_date, CAST(nav_value AS DOUBLE) AS nav_value FROM mirror"))
def _upsert_replace(bank):
    return _priced(loaded_lake(bank, keep_existing=False).read("fact_mf_nav"))


@query("nav_mirror_sync", sql_over("fx_raw_nav", SILVER_SQL + """
SELECT scheme_code, nav_date, CAST(nav_value AS DOUBLE) AS nav_value FROM mirror"""))
def _mirror_sync(bank):
    """The mirror takes three columns of every load and lets the newest value win."""
    lake = Lake(bank.spark, new_folder(bank.spark, "mirror"))
    for load in (first_load(bank), second_load(bank)):
        lake.merge("mf_nav_ref", load.select("scheme_code", "nav_date", "nav_value"), ["scheme_code", "nav_date"], False)
    return _priced(lake.read("mf_nav_ref"))


def silver_and_mirror(bank: Bank) -> tuple[DataFrame, DataFrame]:
    first, second, keys = first_load(bank), second_load(bank), ["scheme_code", "nav_date"]
    return first.unionByName(merge.upsert_ignore(first, second, keys)), merge.upsert_replace(first, second, keys)


@query("gate_mirror_sync", sql_over("fx_raw_nav", SILVER_SQL + """
SELECT CASE WHEN s.nav_value <> m.nav_value THEN 'value_differs' WHEN m.scheme_code IS NULL THEN 'missing_in_mirror' WHEN s.scheme_code IS NULL THEN 'missing_in_silver' ELSE 'in_sync' END AS state,
  count(*) AS n_keys
FROM silver s FULL JOIN mirror m ON m.scheme_code = s.scheme_code AND m.nav_date = s.nav_date GROUP BY 1"""))
def _mirror_gate(bank):
    silver, mirror = silver_and_mirror(bank)
    changes = merge.mirror_changes(silver, mirror, ["scheme_code", "nav_date"], "nav_value")
    return changes.groupBy("state").agg(F.count(F.lit(1)).alias("n_keys"))


@query("apply_status_changes", sql_over("fx_card fx_account fx_loan", """
changes AS (
  SELECT account_id, CASE WHEN bool_or(s = 'closed') THEN 'closed' ELSE 'written_off' END AS s FROM (
    SELECT account_id, 'closed' AS s FROM fx_account WHERE status = 'closed'
    UNION ALL SELECT customer_id, 'written_off' FROM fx_loan WHERE status = 'written_off') GROUP BY account_id)
SELECT c.card_id, c.status AS old_status, CASE WHEN h.s = 'closed' THEN 'blocked' WHEN h.s IS NOT NULL THEN 'expired' ELSE c.status END AS status
FROM fx_card c LEFT JOIN changes h ON h.account_id = c.account_id"""))
def _status_changes(bank):
    ended = bank.fx_account.where("status <> 'active'").select("account_id", "status").unionByName(
        bank.fx_loan.where("status = 'written_off'").select(F.col("customer_id").alias("account_id"), "status")
    )
    changes = ended.groupBy("account_id").agg(F.min("status").alias("status"))
    changes = changes.select("account_id", merge.card_status_after(F.col("status")).alias("new_status"))
    cards = bank.fx_card.withColumn("old_status", F.col("status"))
    return merge.apply_status_changes(cards, changes, "account_id").select("card_id", "old_status", "status")


@query("finalize_statuses", sql_over("fx_account fx_card fx_loan fx_folio fx_order_deposit", """
last_seen AS (SELECT account_id, max(CAST(txn_datetime AS DATE)) AS d FROM fx_order_deposit GROUP BY account_id)
SELECT 'dim_account' AS table_name, a.account_id AS id, a.status, CASE WHEN a.status = 'closed' THEN l.d END AS close_date FROM fx_account a LEFT JOIN last_seen l ON l.account_id = a.account_id
UNION ALL SELECT 'card_master', c.card_id, CASE WHEN a.status = 'closed' THEN 'blocked' WHEN a.status <> 'active' THEN 'expired' ELSE 'active' END, NULL FROM fx_card c LEFT JOIN fx_account a ON a.account_id = c.account_id
UNION ALL SELECT 'loan_account', loan_id, status, NULL FROM fx_loan
UNION ALL SELECT 'mf_folio', folio_id, status, NULL FROM fx_folio"""))
def _finalize(bank):
    """Tables whose rows are all active get the status that each is meant to end with."""
    active, no_date = F.lit("active").alias("status"), F.lit(None).cast("date").alias("close_date")
    ended = bank.fx_account.where("status <> 'active'")
    last = bank.fx_order_deposit.groupBy("account_id").agg(F.max(F.col("txn_datetime").cast("date")).alias("_d"))
    closing = ended.join(last, "account_id", "left").select("account_id", "status", F.when(F.col("status") == "closed", F.col("_d")).alias("close_date"))
    cards = bank.fx_card.join(ended.select("account_id", F.col("status").alias("_s")), "account_id").select(
        "card_id", merge.card_status_after(F.col("_s")).alias("status"))
    done = {
        "dim_account": (merge.finalize(bank.fx_account.select("account_id", active, no_date), closing, "account_id"), "account_id"),
        "card_master": (merge.finalize(bank.fx_card.select("card_id", active), cards, "card_id"), "card_id"),
        "loan_account": (merge.finalize(bank.fx_loan.select("loan_id", active), bank.fx_loan.where("status <> 'active'").select("loan_id", "status"), "loan_id"), "loan_id"),
        "mf_folio": (merge.finalize(bank.fx_folio.select("folio_id", active), bank.fx_folio.where("status <> 'active'").select("folio_id", "status"), "folio_id"), "folio_id"),
    }
    parts = [rows.select(F.lit(name).alias("table_name"), F.col(key).alias("id"), "status", "close_date" if "close_date" in rows.columns else no_date)
             for name, (rows, key) in done.items()]
    return stacked(parts)


# --- incremental ----------------------------------------------------------------------------------

# On file: the first load up to the end of 1998, one scheme complete, one scheme not at all.
_ON_FILE = "scheme_code <> '5' AND (nav_date <= DATE'1998-12-31' OR scheme_code = '2')"
INCREMENTAL_SQL = LOADS_SQL + "," + clean_sql("nav_clean") + f""",
on_file AS (SELECT * FROM (SELECT * FROM nav_first UNION ALL SELECT * FROM nav_clean WHERE scheme_code = '2' AND NOT EXISTS (
  SELECT 1 FROM nav_first f WHERE f.scheme_code = nav_clean.scheme_code AND f.nav_date = nav_clean.nav_date)) WHERE {_ON_FILE}),
marks AS (SELECT scheme_code, max(nav_date) AS watermark FROM on_file GROUP BY scheme_code),
flagged AS (SELECT n.*, m.watermark, m.watermark IS NULL OR n.nav_date > m.watermark AS is_new FROM nav_clean n LEFT JOIN marks m ON m.scheme_code = n.scheme_code)
"""


def on_file(bank: Bank) -> DataFrame:
    complete = prices(bank).where("scheme_code = '2'")
    first = first_load(bank)
    facts = first.unionByName(merge.upsert_ignore(first, complete, ["scheme_code", "nav_date"]))
    return facts.where(_ON_FILE)


@query("nav_watermarks", sql_over("fx_raw_nav", INCREMENTAL_SQL + "SELECT * FROM marks"))
def _watermarks(bank):
    return merge.watermarks(on_file(bank), "scheme_code", "nav_date")


@query("incremental_new_rows", sql_over("fx_raw_nav", INCREMENTAL_SQL + """
SELECT scheme_code, nav_date, CAST(nav_value AS DOUBLE) AS nav_value FROM flagged WHERE is_new"""))
def _new_rows(bank):
    return _priced(merge.new_rows(prices(bank), on_file(bank), "scheme_code", "nav_date"))


@query("late_rows", sql_over("fx_raw_nav", INCREMENTAL_SQL + """
SELECT f.scheme_code, f.nav_date, CAST(f.nav_value AS DOUBLE) AS nav_value, CAST(o.nav_value AS DOUBLE) AS on_file,
  CASE WHEN o.scheme_code IS NULL THEN 'backfilled' ELSE 'restated' END AS late_kind
FROM flagged f LEFT JOIN on_file o ON o.scheme_code = f.scheme_code AND o.nav_date = f.nav_date
WHERE NOT f.is_new AND (o.scheme_code IS NULL OR o.nav_value <> f.nav_value)"""))
def _late_rows(bank):
    late = merge.late_rows(prices(bank), on_file(bank), "scheme_code", "nav_date", "nav_value")
    return late.select("scheme_code", "nav_date", dbl("nav_value"), dbl("on_file"), "late_kind")


@query("refresh_status", sql_over("fx_raw_nav fx_scheme_meta", INCREMENTAL_SQL + "," + SCHEME_SQL + """
SELECT s.scheme_code, CASE WHEN NOT EXISTS (SELECT 1 FROM fx_raw_nav r WHERE r.scheme_code = s.scheme_code) THEN 'FAILED'
    WHEN count(f.scheme_code) > 0 THEN 'OK' ELSE 'NO_NEW_ROWS' END AS status, count(f.scheme_code) AS n_new
FROM schemes s LEFT JOIN flagged f ON f.scheme_code = s.scheme_code AND f.is_new GROUP BY s.scheme_code"""))
def _refresh_status(bank):
    fresh = merge.new_rows(prices(bank), on_file(bank), "scheme_code", "nav_date")
    return merge.refresh_status(schemes(bank), bank.fx_raw_nav, fresh, "scheme_code")


# --- gates ----------------------------------------------------------------------------------------


@query("gate_duplicates", sql_over("fx_raw_nav", CAST_SQL + """
SELECT scheme_code, nav_date, count(*) AS n_rows FROM nav_cast WHERE nav_date IS NOT NULL AND v > 0 GROUP BY ALL HAVING count(*) > 1"""))
def _gate_duplicates(bank):
    return duplicate_keys(checked(bank).where("problem is null"), ["scheme_code", "nav_date"])


@query("gate_invalid_values", sql_over("fx_raw_nav", """
SELECT scheme_code, date, nav, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM fx_raw_nav WHERE TRY_CAST(nav AS DECIMAL(14,5)) IS NULL OR TRY_CAST(nav AS DECIMAL(14,5)) <= 0"""))
def _gate_invalid(bank):
    return checked(bank).where("nav_value is null").select("scheme_code", "date", "nav", *LINE)


@query("gate_scheme_without_nav", sql_over("fx_raw_nav fx_scheme_meta", NAV_SQL + "," + SCHEME_SQL + """
SELECT s.scheme_code FROM schemes s WHERE NOT EXISTS (SELECT 1 FROM nav_clean n WHERE n.scheme_code = s.scheme_code)"""))
def _gate_without_nav(bank):
    return schemes(bank).join(prices(bank), "scheme_code", "left_anti").select("scheme_code")


@query("apply_corrections", sql_over("fx_raw_nav", CAST_SQL + """,
bad AS (SELECT n.*, n.nav_date IS NULL AS is_bad_date FROM nav_cast n WHERE nav_date IS NULL OR v IS NULL OR v <= 0),
fixed AS (SELECT b.scheme_code, b.l_orderkey, b.l_linenumber, b.l_partkey, b.l_suppkey,
    CASE WHEN b.is_bad_date THEN strftime(l.l_shipdate, '%d-%m-%Y') ELSE b.date END AS date,
    CASE WHEN b.nav = 'N.A.' AND NOT b.is_bad_date THEN CAST(10 + l.l_linenumber AS VARCHAR) || '.25' ELSE b.nav END AS nav
  FROM bad b JOIN lineitem l ON l.l_orderkey = b.l_orderkey AND l.l_linenumber = b.l_linenumber AND l.l_partkey = b.l_partkey AND l.l_suppkey = b.l_suppkey)
SELECT scheme_code, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(try_strptime(date, '%d-%m-%Y') AS DATE) AS nav_date,
  CAST(CASE WHEN TRY_CAST(nav AS DECIMAL(14,5)) > 0 THEN TRY_CAST(nav AS DECIMAL(14,5)) END AS DOUBLE) AS nav_value,
  CASE WHEN try_strptime(date, '%d-%m-%Y') IS NULL THEN 'bad_date' WHEN TRY_CAST(nav AS DECIMAL(14,5)) > 0 THEN NULL ELSE 'bad_nav' END AS problem
FROM fixed"""))
def _apply_corrections(bank):
    """Bad dates get the ship date back, missing prices a value; zero prices stay in quarantine."""
    mended, _ = feed.apply_corrections(*_bad_and_fixes(bank))
    return mended.select("scheme_code", *LINE, "nav_date", dbl("nav_value"), "problem")


def _bad_and_fixes(bank: Bank) -> tuple[DataFrame, DataFrame]:
    bad = checked(bank).where("problem is not null")
    bad = bad.withColumn("quarantine_id", F.sha2(F.concat_ws("|", "scheme_code", *LINE), 256))
    true_date = bank.lineitem.select(*LINE, F.date_format("l_shipdate", "dd-MM-yyyy").alias("_ship"))
    known = bad.join(true_date, LINE)
    fix = F.when(F.col("problem") == "bad_date", F.struct(F.lit("date").alias("f"), F.col("_ship").alias("v"))).when(
        F.col("nav") == "N.A.",
        F.struct(F.lit("nav").alias("f"), F.concat((F.col("l_linenumber") + 10).cast("string"), F.lit(".25")).alias("v")),
    )
    corrections = known.withColumn("_fix", fix).where("_fix is not null").select(
        "quarantine_id", F.col("_fix.f").alias("field_corrected"), F.col("_fix.v").alias("new_value"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("corrected_at"), F.lit("steward").alias("corrected_by"),
    )
    return bad.drop("nav_date", "nav_value", "problem"), corrections


@query("corrections_to_silver", sql_over("fx_raw_nav", NAV_SQL + """,
bad AS (SELECT n.*, n.nav_date IS NULL AS is_bad_date FROM nav_cast n WHERE nav_date IS NULL OR v IS NULL OR v <= 0),
fixed AS (SELECT b.scheme_code, b.l_orderkey, b.l_linenumber, b.l_partkey, b.l_suppkey, is_bad_date, b.nav AS old_nav,
    CASE WHEN b.is_bad_date THEN CAST(l.l_shipdate AS DATE) ELSE b.nav_date END AS nav_date,
    TRY_CAST(CASE WHEN b.nav = 'N.A.' AND NOT b.is_bad_date THEN CAST(10 + l.l_linenumber AS VARCHAR) || '.25' ELSE b.nav END AS DECIMAL(14,5)) AS v
  FROM bad b JOIN lineitem l ON l.l_orderkey = b.l_orderkey AND l.l_linenumber = b.l_linenumber AND l.l_partkey = b.l_partkey AND l.l_suppkey = b.l_suppkey),
sound AS (SELECT scheme_code, nav_date, v FROM (SELECT *, row_number() OVER (PARTITION BY scheme_code, nav_date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM fixed WHERE v > 0 AND nav_date IS NOT NULL) WHERE rn = 1)
SELECT 'silver' AS kind, scheme_code, nav_date, CAST(nav_value AS DOUBLE) AS nav_value FROM nav_clean
UNION ALL SELECT 'silver', scheme_code, nav_date, CAST(v AS DOUBLE) FROM sound s WHERE NOT EXISTS (SELECT 1 FROM nav_clean n WHERE n.scheme_code = s.scheme_code AND n.nav_date = s.nav_date)
UNION ALL SELECT 'log ' || CASE WHEN is_bad_date THEN 'date' ELSE 'nav' END, scheme_code, NULL, CAST(count(*) AS DOUBLE) FROM fixed WHERE is_bad_date OR old_nav = 'N.A.' GROUP BY 1, 2"""))
def _corrections_to_silver(bank):
    """Silver after the corrected rows have been taken in, and how many corrections the log holds per scheme."""
    lake = Lake(bank.spark, new_folder(bank.spark, "corrections"))
    lake.merge("fact_mf_nav", prices(bank), ["scheme_code", "nav_date"], keep_existing=True)
    bad, fixes = _bad_and_fixes(bank)
    bad, fixes = lake.staged("bad", bad), lake.staged("fixes", fixes)
    for _ in range(2):  # a second run adds nothing
        feed.store_corrections(lake, bad, fixes, LINE)
    silver = lake.read("fact_mf_nav").select(F.lit("silver").alias("kind"), "scheme_code", "nav_date", dbl("nav_value"))
    log = lake.read("dq_correction_log").join(bad.select("quarantine_id", "scheme_code"), "quarantine_id")
    counts = log.groupBy("scheme_code", "field_corrected").agg(F.count(F.lit(1)).cast("double").alias("nav_value"))
    return silver.unionByName(counts.select(
        F.concat(F.lit("log "), "field_corrected").alias("kind"), "scheme_code", F.lit(None).cast("date").alias("nav_date"), "nav_value"))
