"""License scan by diagonal voting: hashes of all k words in a row vote for places in license templates.

A document gram at word p that equals a template gram at word t votes for diagonal p - t. A diagonal with every gram
of a short phrase is a place of that phrase. Neighbouring diagonals of a longer template are merged (words put in or
left out shift the diagonal), and the merged span counts if it holds enough of the template's grams at about the
template's length.

Templates are given as a list, so their grams are bounded by their words (here under 1,000 grams of 40 bytes) and go
to every task; documents are read once and only votes are shuffled. Votes are counted once per text, so copies add
nothing.

Defined cases: a null text counts as empty: no words, no places, score 0; equal rows get equal results; a text shorter
than k words has no grams; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import read, text_key, written

K = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and labels of the query.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

# Wording of well-known license notices.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                 "with the License. You may obtain a copy of the License at"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("proprietary", "All rights reserved."),
]

#: Diagonals this close belong together; share of a notice's grams that a span must hold; its length against the notice's.
MERGE, HELD, SHORTEST, LONGEST = 4, 0.7, 0.5, 2.0


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _grams(words: Column, k: int) -> Column:
    """Hashes of every k words in a row; the first item (index 0, null) stands for the document itself."""
    at = F.sequence(F.lit(0), F.size(words) - k)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.concat(F.array(F.lit(None).cast("long")), F.when(F.size(words) >= k, hashes).otherwise(F.array()))


def template_grams(spark: SparkSession, phrases: list[tuple[str, str]], notices: list[tuple[str, str]], k: int) -> DataFrame:
    """(template, label, exact, length, t, gram); phrases must have k words or more."""
    rows = [(label, True, text) for label, text in phrases] + [(label, False, text) for label, text in notices]
    if not rows:
        return spark.createDataFrame([], "template int, label string, exact boolean, length int, t int, gram long")
    literal = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(l).alias("label"), F.lit(e).alias("exact"), F.lit(t).alias("text")) for i, (l, e, t) in enumerate(rows)])
    words = spark.range(1).select(F.inline(literal)).withColumn("words", words_of(F.col("text")))
    grams = words.select("template", "label", "exact", F.size("words").alias("length"), F.posexplode(_grams(F.col("words"), k)).alias("t", "gram"))
    return grams.where("t > 0").withColumn("t", F.col("t") - 1)


def votes(docs: DataFrame, templates: DataFrame, k: int) -> DataFrame:
    """A row per document (template -1) and per vote: doc_id, key, n_words, template, label, exact, length, t, p."""
    counted = docs.select("doc_id", text_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("words"))
    each = counted.select("doc_id", "key", F.size("words").alias("n_words"), F.posexplode(_grams(F.col("words"), k)).alias("p", "gram"))
    itself = docs.sparkSession.range(1).select(F.lit(-1).alias("template"), F.lit("").alias("label"), F.lit(False).alias("exact"),
                                       F.lit(0).alias("length"), F.lit(0).alias("t"), F.lit(None).cast("long").alias("gram"))
    known = F.broadcast(templates.unionByName(itself))
    return each.withColumn("gram", F.coalesce("gram", F.lit(0).cast("long"))).join(
        known.withColumn("gram", F.coalesce("gram", F.lit(0).cast("long"))), "gram").select(
        "doc_id", "key", "n_words", "template", "label", "exact", "length", "t", (F.col("p") - 1).alias("p"))


def scan(docs: DataFrame, phrases: list[tuple[str, str]], notices: list[tuple[str, str]], k: int = K) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A phrase shorter than ``k`` words makes all grams as short as it is; one without words is nowhere.
    """
    phrases = [(label, text) for label, text in phrases if re.search(WORD, text)]
    k = min([k, *[len(re.findall(WORD, text)) for _, text in phrases]])
    found = written(votes(docs, template_grams(docs.sparkSession, phrases, notices, k), k), "license-votes")
    # Once per text: a place that copies vote for again is the same place.
    voted = found.where("template >= 0").groupBy("key", "template", "label", "exact", "length", "t", "p").agg(F.lit(1).alias("n"))
    diagonals = voted.groupBy("key", "template", "label", "exact", "length", (F.col("p") - F.col("t")).alias("d")).agg(
        F.collect_set("t").alias("held"), F.min("p").alias("first"), F.max("p").alias("last"))
    whole = F.size("held") == F.col("length") - (k - 1)
    base = diagonals.where(F.col("exact") & whole).groupBy("key").agg(
        F.count("*").alias("n_base"), F.min("first").alias("first_word"), F.max("first").alias("last_word"), F.collect_set("label").alias("base"))
    line = Window.partitionBy("key", "template").orderBy("d")
    apart = (F.col("d") - F.lag("d").over(line) > MERGE).cast("int")
    merged = diagonals.where("not exact").withColumn("run", F.sum(F.coalesce(apart, F.lit(0))).over(line)).groupBy(
        "key", "template", "label", "length", "run").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"), F.min("first").alias("first"), F.max("last").alias("last"))
    share = F.col("held") / (F.col("length") - (k - 1))
    long_enough = (F.col("last") - F.col("first") + k).between(F.col("length") * SHORTEST, F.col("length") * LONGEST)
    spans = merged.where(long_enough & (share >= HELD)).groupBy("key").agg(F.collect_set("label").alias("more"), F.max(share).alias("share"))
    result = base.join(spans, "key", "full").withColumnRenamed("key", "_key")
    none = F.array().cast("array<string>")
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.where("template = -1").select("doc_id", "key", "n_words").join(result, F.col("key") == F.col("_key"), "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        listed(F.coalesce("base", none)).alias("base_labels"), listed(F.concat(F.coalesce("base", none), F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def op6_diagonal_voting(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against three phrases and the notices."""
    return scan(read(spark, folder, "documents"), PHRASES, NOTICES)


def _sql() -> str:
    rows = [(i, label, exact, text.replace("'", "''")) for i, (label, exact, text) in enumerate(
        [(a, "true", b) for a, b in PHRASES] + [(a, "false", b) for a, b in NOTICES])]
    values = ", ".join(f"({i}, '{label}', {exact}, '{text}')" for i, label, exact, text in rows)
    words = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    grams = "list_transform(range(0, greatest(len(words) - 2, 0)), lambda i: {'p': i, 'gram': words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3]})"
    return f"""
WITH given(template, label, exact, text) AS (VALUES {values}),
templates AS (SELECT template, label, exact, len(words) AS length, unnest({grams}) AS g FROM (SELECT *, {words.format('text')} AS words FROM given)),
docs AS (SELECT row_number() OVER () AS id, doc_id, {words.format("coalesce(text, '')")} AS words FROM documents),
grams AS (SELECT id, unnest({grams}) AS g FROM docs),
voted AS (SELECT DISTINCT id, template, label, exact, length, t.g.p AS t, d.g.p AS p FROM grams d JOIN templates t ON d.g.gram = t.g.gram),
diagonals AS (SELECT id, template, label, exact, length, p - t AS d, list(DISTINCT t) AS held, min(p) AS first_, max(p) AS last_ FROM voted GROUP BY ALL),
base AS (SELECT id, count(*) AS n_base, min(first_) AS first_word, max(first_) AS last_word, list(DISTINCT label) AS base FROM diagonals
  WHERE exact AND len(held) = length - 2 GROUP BY id),
apart AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY id, template ORDER BY d) > {MERGE} THEN 1 ELSE 0 END AS gap FROM diagonals WHERE NOT exact),
runs AS (SELECT *, sum(gap) OVER (PARTITION BY id, template ORDER BY d) AS run FROM apart),
merged AS (SELECT id, template, label, length, run, len(list_distinct(flatten(list(held)))) AS n, min(first_) AS first_, max(last_) AS last_ FROM runs GROUP BY ALL),
spans AS (SELECT id, list(DISTINCT label) AS more, max(n::DOUBLE / (length - 2)) AS share FROM merged
  WHERE last_ - first_ + {K} BETWEEN length * {SHORTEST} AND length * {LONGEST} AND n::DOUBLE / (length - 2) >= {HELD} GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(coalesce(base, []) || coalesce(more, []))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM docs LEFT JOIN base USING (id) LEFT JOIN spans USING (id)
"""


ORACLE = _sql()
