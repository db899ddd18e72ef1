"""URL filter by redirect equivalence: block decisions reach every alias of a page, explicit allow rules come first.

Rules name a host (with its subdomains) and a path prefix; the longest that fits decides. Pages tie urls together:
a canonical link or a meta refresh makes its page and its target aliases. Aliases form the connected components of
these edges. A url that no rule fits is blocked if an alias is blocked by a rule and no alias is explicitly allowed.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; a null or
empty html has no edges; equal urls are one node; of rules of equal length, allow wins, then the smaller text; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, read, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path) of the query.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _behind_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_behind_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What makes two urls the same place: host, path and query; neither scheme nor fragment."""
    query = F.regexp_extract(_behind_scheme(url), r"^[^?#]*(\?[^#]*)?", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path_of(url), query))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): nodes of a page and of what its canonical link or its meta refresh names."""
    attribute = r"""\s*=\s*["']?([^"'\s>]+)"""
    canonical = F.filter(F.regexp_extract_all("html", F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)), lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?canonical\b"""))
    refresh = F.filter(F.regexp_extract_all("html", F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b"""))
    named = F.concat(
        F.transform(canonical, lambda t: F.regexp_extract(t, r"(?is)\bhref" + attribute, 1)),
        F.transform(refresh, lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?([^"'\s>;]+)""", 1)))
    links = pages.where(F.instr("url", "://") > 0).select("url", F.explode(F.array_distinct(named)).alias("to")).where("to <> ''")
    base = F.concat(F.lit("x://"), host_of(F.col("url")))
    folder = F.regexp_extract(path_of(F.col("url")), r"^(.*/)?", 1)
    target = (
        F.when(F.col("to").contains("://"), F.col("to")).when(F.col("to").startswith("//"), F.concat(F.lit("x:"), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(base, F.col("to")))
        .otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), F.col("to"))))
    return links.select(node_of(F.col("url")).alias("a"), node_of(target).alias("b")).where("a <> b").distinct()


def fitting_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict): the longest rule for each place that has one.

    A place asks for each of its host's suffixes and each path length in use, so that a rule is found by equality
    and a host with many rules does not multiply its pages.
    """
    rules = rules.select((F.concat("host", "path")).alias("rule"), "host", "path", "verdict").distinct()
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    if not lengths:
        return places.where("false").select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    parts = F.split("host", r"\.")
    suffixes = F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."))
    asked = (
        places.where("host <> ''").withColumn("_host", F.explode(suffixes))
        .withColumn("_n", F.explode(F.array(*[F.lit(n) for n in lengths]))).where(F.length("path") >= F.col("_n"))
        .withColumn("_path", F.expr("substring(path, 1, _n)")))
    known = rules.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "rule", "verdict")
    best = F.max(F.struct(F.length("rule"), (F.col("verdict") == "allow").alias("allow"), F.col("rule"), F.col("verdict"))).alias("best")
    return asked.join(known, ["_host", "_path"]).groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, aliases (urls in its component, 1 if none is known)."""
    url = F.col("url")
    places = written(pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")), "url-places")
    edges = written(alias_edges(pages), "url-edges")
    member = components(edges)
    at = F.concat(F.lit("x://"), F.col("node"))
    of_members = member.withColumns({"host": host_of(at), "path": path_of(at)})
    ruled = fitting_rules(places.select("host", "path").unionAll(of_members.select("host", "path")).distinct(), rules)
    ruled = written(ruled, "url-rules")
    groups = of_members.join(ruled, ["host", "path"], "left").groupBy("root").agg(
        F.count("*").alias("aliases"), F.bool_or(F.col("verdict") == "allow").alias("allowed"), F.bool_or(F.col("verdict") == "block").alias("blocked"))
    spread = member.join(groups, "root").select("node", "aliases", (F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False))).alias("alias_blocked"))
    judged = places.join(ruled, ["host", "path"], "left").join(spread, "node", "left")
    verdict = F.coalesce("verdict", F.when(F.col("alias_blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("aliases", F.lit(1)).cast("long").alias("aliases"))


def op3_redirect_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url under the five rules."""
    return judge(read(spark, folder, "pages"), rule_table(spark, RULES))


ORACLE = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
split_ AS (
  SELECT page_id, url, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages),
places AS (
  SELECT page_id, url, html, rest, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS query FROM split_),
links AS (
  SELECT host, path, host || path || query AS a, unnest(list_distinct(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?canonical\b')), lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1))
    || list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')), lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)))) AS too
  FROM places WHERE rest IS NOT NULL),
resolved AS (
  SELECT a, CASE WHEN contains(too, '://') THEN substr(too, position('://' IN too) + 3) WHEN starts_with(too, '//') THEN substr(too, 3)
    WHEN starts_with(too, '/') THEN host || too ELSE host || coalesce(nullif(regexp_extract(path, '^(.*/)?', 1), ''), '/') || too END AS rest
  FROM links WHERE too <> ''),
edges AS (
  SELECT DISTINCT a, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) || regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS b FROM resolved),
both_ AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (SELECT a AS node, a AS other FROM both_ UNION SELECT r.node, e.b FROM reach r JOIN both_ e ON r.other = e.a),
nodes AS (
  SELECT DISTINCT node, regexp_extract(node, '^([^/?#]*)', 1) AS host, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
spots AS (SELECT host, path FROM places UNION SELECT host, path FROM nodes),
ruled AS (
  SELECT s.host, s.path, r.host || r.path AS rule, r.verdict FROM spots s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY s.host, s.path ORDER BY length(r.host || r.path) DESC, r.verdict, r.host || r.path DESC) = 1),
spread AS (
  SELECT r.node, count(*) AS aliases, coalesce(bool_or(u.verdict = 'block'), false) AND NOT coalesce(bool_or(u.verdict = 'allow'), false) AS alias_blocked
  FROM reach r JOIN nodes n ON r.other = n.node LEFT JOIN ruled u ON n.host = u.host AND n.path = u.path GROUP BY r.node)
SELECT p.page_id, p.host, p.path, u.rule, coalesce(u.verdict, CASE WHEN s.alias_blocked THEN 'block' ELSE 'allow' END) AS verdict, coalesce(s.aliases, 1) AS aliases
FROM places p LEFT JOIN ruled u ON p.host = u.host AND p.path = u.path LEFT JOIN spread s ON s.node = p.host || p.path || p.query
"""
