"""Document fingerprints by SpotSigs: a common word anchors a chain of the content words that follow it.

Every anchor gives one signature (anchor, next three content words); a fingerprint is the sorted set of signatures, 8
hex digits each. Texts whose sets differ too much in length cannot be alike, so the comparison is partitioned by set
length and pruned by it before sets are intersected.

Defined cases: a null text counts as empty and has an empty fingerprint; a text with words but no full spot uses every
word as an anchor (or all its words, if under four); a text without words uses itself; two empty fingerprints are
alike (1.0), an empty and another are not (0.0); equal rows follow each other; a null doc_id comes first; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import read, text_key, written

# Common words of four languages.
ANCHORS = (
    "a an and are as at be been but by can did do for from had has have he her his i if in is it its no not of on or she so that the "
    "their them then there they this to was we were what when which who will with would you "
    "au aux avec ce ces dans de des du elle en est et il ils la le les leur mais ne nous ou par pas plus pour que qui sa se ses son sur un une vous "
    "aber als am auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht noch nur oder sich sie sind so und von war wie wir zu zum zur "
    "al como con del el en es esta este la las lo los más me no para pero por que se sin su sus un una y ya").split()
CHAIN = 3
ROWS_PER_PART = 100_000


def _hash(*words: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(" ", *words).cast("binary")), 1, 8)


def with_signatures(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the sorted set of signatures of ``text``.

    Before the a-th anchor, at word p, stand p - a content words: its chain begins at that content word.
    """
    anchors = list(dict.fromkeys(ANCHORS))
    split = F.filter(F.split(F.lower(F.col(text)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    placed = docs.withColumn("_words", split).withColumns({
        "_at": F.filter(F.transform("_words", lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull()),
        "_content": F.filter("_words", lambda w: ~w.isin(anchors))})
    words, content = F.col("_words"), F.col("_content")
    spots = F.filter(F.transform("_at", lambda p, a: F.when(
        p - a + CHAIN <= F.size(content), _hash(F.get(words, p), *[F.get(content, p - a + j) for j in range(CHAIN)]))), lambda s: s.isNotNull())
    chains = F.transform(F.sequence(F.lit(0), F.size(words) - CHAIN - 1), lambda i: _hash(*[F.get(words, i + j) for j in range(CHAIN + 1)]))
    placed = placed.withColumn("_spots", spots)
    chosen = (
        F.when(F.size("_spots") > 0, F.col("_spots")).when(F.size(words) > CHAIN, chains)
        .when(F.size(words) > 0, F.array(_hash(F.array_join(words, " ")))).when(F.col(text) != "", F.array(_hash(F.col(text))))
        .otherwise(F.array().cast("array<string>")))
    return placed.withColumn(name, F.array_sort(F.array_distinct(chosen))).drop("_words", "_at", "_content", "_spots")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two signature sets."""
    shared = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def similar_pairs(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(key_a, key_b, likeness) of different texts at ``least`` or above, by pruned Jaccard; copies are one text.

    Sets are dealt into partitions of lengths [least^-i, least^-(i+1)); only neighbouring partitions can match. Within
    them only the rarest signatures of a set need be looked up: a match shares one of the first n - ceil(least n) + 1.
    """
    texts = docs.select(text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["key"])
    sets = written(with_signatures(texts, "text", "sigs").select("key", "sigs", F.size("sigs").alias("n")).where("n > 0"), "spot-sets")
    single = sets.select("key", "n", F.explode("sigs").alias("sig"))
    often = single.groupBy("sig").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("often", "sig"))
    head = single.join(often, "sig").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
    head = head.withColumn("level", F.floor(F.log("n") / F.lit(-math.log(least)) + 1e-9))
    left = head.select(F.col("key").alias("key_a"), F.col("n").alias("n_a"), "sig", F.explode(F.array(F.col("level"), F.col("level") + 1)).alias("level"))
    right = head.select(F.col("key").alias("key_b"), F.col("n").alias("n_b"), "sig", "level")
    pairs = left.join(right, ["level", "sig"]).where(
        ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("key_a") < F.col("key_b")))) & (F.col("n_a") >= F.col("n_b") * least - 1e-9))
    pairs = pairs.select("key_a", "key_b").distinct()
    a, b = sets.select(F.col("key").alias("key_a"), F.col("sigs").alias("a")), sets.select(F.col("key").alias("key_b"), F.col("sigs").alias("b"))
    alike = likeness(F.col("a"), F.col("b"))
    return pairs.join(a, "key_a").join(b, "key_b").withColumn("likeness", alike).where(F.col("likeness") >= least - 1e-9).select("key_a", "key_b", "likeness")


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, key, next_key): each row's text and that of the next row by doc_id; the first follows the last.

    Narrow rows are dealt by range and kept with their part's number, so the order is settled part by part and parts
    are tied together over one row each.
    """
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key")).withColumn("salt", F.spark_partition_id())
    rows = written(rows, "doc-keys")
    parts = rows.count() // ROWS_PER_PART + 1
    ranged = rows.repartitionByRange(int(parts), F.col("doc_id").asc_nulls_first(), "key", "salt").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "doc-order")
    order = [F.col("doc_id").asc_nulls_first(), F.col("key"), F.col("salt")]
    first = ranged.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "key")).alias("first"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = first.select(F.col("part").alias("_part"), F.coalesce(F.lead("first.key").over(Window.orderBy("part")), F.first("first.key").over(whole)).alias("_next"))
    ahead = F.lead("key").over(Window.partitionBy("part").orderBy(*order))
    return ranged.withColumn("ahead", ahead).join(first, F.col("part") == F.col("_part")).select("doc_id", "key", F.coalesce("ahead", "_next").alias("next_key"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited copy, and how alike they and the next document's are.

    Each text is shuffled once, under its hash; what the row before needs of it (the first quarter of that row's
    length, and the signatures) goes there in a second, smaller shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # Signatures are made where they are needed, on both sides of the second shuffle, so that the first moves texts alone.
    known = docs.select(text_key(F.col("text")).alias("key"), text.alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    lengths = docs.select(text_key(F.col("text")).alias("key"), F.char_length(text).alias("n_chars")).groupBy("key").agg(F.first("n_chars").alias("n_chars"))
    order = successors(docs).join(lengths, "key").withColumn("need", F.floor(F.col("n_chars") / 4).cast("int"))
    signed = with_signatures(known, "text", "sigs")
    ahead = signed.select(F.col("key").alias("next_key"), F.col("text").alias("next_text"), F.unhex(F.array_join("sigs", "")).alias("next_packed"))
    fetched = order.join(ahead, "next_key").select("doc_id", "key", "n_chars", "need", F.expr("substring(next_text, 1, need)").alias("patch"), "next_packed")
    both = fetched.join(signed, "key")
    edited = F.concat(F.expr("substring(text, 1, n_chars - need)"), F.col("patch"))
    both = with_signatures(both.withColumn("edited", edited), "edited", "edited_sigs")
    each = F.when(F.octet_length("next_packed") > 0, F.sequence(F.lit(1), F.octet_length("next_packed"), F.lit(4))).otherwise(F.array().cast("array<int>"))
    both = both.withColumn("next_sigs", F.transform(each, lambda i: F.lower(F.hex(F.substring("next_packed", i, F.lit(4))))))
    return both.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("sigs", ",").alias("fingerprint"), F.array_join("edited_sigs", ",").alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def op1_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, its edited text and the next document."""
    return fingerprint(read(spark, folder, "documents"))


_STOP = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(ANCHORS)) + "]"


def _sql_sets(source: str, text: str, name: str) -> str:
    short = lambda x: f"substr(md5({x}), 1, 8)"
    return f"""
{name}_words AS (SELECT *, list_filter(string_split_regex(lower({text}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM {source}),
{name}_parts AS (SELECT *, list_filter(range(len(w)), lambda i: list_contains({_STOP}, w[i + 1])) AS at_, list_filter(w, lambda x: NOT list_contains({_STOP}, x)) AS c FROM {name}_words),
{name}_spots AS (SELECT * EXCLUDE (at_), list_filter(list_transform(at_, lambda p, a: CASE WHEN p - (a - 1) + 3 <= len(c)
    THEN {short("w[p + 1] || ' ' || c[p - a + 2] || ' ' || c[p - a + 3] || ' ' || c[p - a + 4]")} END), lambda s: s IS NOT NULL) AS s FROM {name}_parts),
{name} AS (SELECT * EXCLUDE (w, c, s), list_sort(list_distinct(CASE WHEN len(s) > 0 THEN s
    WHEN len(w) > 3 THEN list_transform(range(len(w) - 3), lambda i: {short("w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]")})
    WHEN len(w) > 0 THEN [{short("array_to_string(w, ' ')")}] WHEN {text} <> '' THEN [{short(text)}] ELSE [] END)) AS {name}_sigs FROM {name}_spots)"""


_ALIKE = "CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"
ORACLE = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars, md5(coalesce(text, '')) AS key FROM documents),
ordered AS (SELECT *, coalesce(lead(text) OVER o, first_value(text) OVER (ORDER BY doc_id NULLS FIRST, key)) AS next_text
  FROM docs WINDOW o AS (ORDER BY doc_id NULLS FIRST, key)),
edits AS (SELECT *, substr(text, 1, n_chars - n_chars // 4) || substr(next_text, 1, n_chars // 4) AS edited FROM ordered),
{_sql_sets("edits", "text", "own").lstrip()},
{_sql_sets("own", "edited", "changed").lstrip()},
{_sql_sets("changed", "next_text", "following").lstrip()}
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, coalesce(array_to_string(own_sigs, ','), '') AS fingerprint, coalesce(array_to_string(changed_sigs, ','), '') AS edited_fingerprint,
  {_ALIKE.format(a="own_sigs", b="changed_sigs")} AS near_edited, {_ALIKE.format(a="own_sigs", b="following_sigs")} AS near_next
FROM following
"""
