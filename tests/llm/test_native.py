"""Sharding, mixing, url filter, license scan and fingerprints: SQL on whole tables, edge cases on small ones."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from check import compare, database
from ledgerlake.llm import common, op1_fingerprint, op3_url_filter, op4_mixing, op6_license_scan, op8_sharding
from ledgerlake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, shard string, size long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows and clashing extra columns."""
    rows = [(1, "", "en", "a", 0, "k", "s", 1), (2, None, None, None, None, None, None, None), (None, "the cat sat on the mat today", "en", "b", 1, "k", "s", 1),
            (3, "word " * 30_000, "en", "b", 1, "k", "s", 1), (3, "word " * 30_000, "en", "b", 1, "k", "s", 1), (4, "under the mit license", "en", "b", 1, "k", "s", 1),
            (4, "under the mit license", "en", "b", 1, "k", "s", 1), (5, "!!! ???", "en", "c", 7, "k", "s", 1), (-6, "a b c é", "en", "c", 7, "k", "s", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert compare(name, got, database(FOLDER).execute(ORACLES[name]).df()) == []


def jump(key: int, shards: int) -> int:
    key &= (1 << 64) - 1
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        to = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 24, 500])
def test_jump_walk(spark, shards):
    keys = [0, 1, 2, 7, 10**12, -1, -(2**63), 2**63 - 1, *range(100, 140)]
    docs = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for row in op8_sharding.assign(docs, F.col("doc_id"), shards).collect():
        assert (row.shard, row.grown_shard) == (jump(row.doc_id, shards), jump(row.doc_id, shards + 1))


def test_long_walks_are_finished(spark, monkeypatch):
    monkeypatch.setattr(op8_sharding, "USUAL_JUMPS", 2)
    for row in op8_sharding.assign(spark.range(50).withColumnRenamed("id", "doc_id"), F.col("doc_id"), 24).collect():
        assert row.shard == jump(row.doc_id, 24)


def test_sharding_odd_rows(spark, odd):
    rows = op8_sharding.layout(odd, 4).collect()
    assert len(rows) == odd.count()
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert op8_sharding.layout(odd.limit(0), 4).count() == 0


def test_sainte_lague_by_brute_force(spark):
    sizes = {"a": 900, "b": 5, "c": 333, "d": 1, None: 77}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r for r in op4_mixing.quotas(op4_mixing.targets(frame, [5, 2, 1], 1.5, 2.0), 4).collect()}
    left, capped = 1.5 * sum(sizes.values()), {}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    while True:
        open_ = [s for s in sizes if s not in capped]
        level = (left - sum(capped.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            break
        capped.update({s: 2.0 * sizes[s] for s in over})
    target = {s: capped.get(s, level * weight[s]) for s in sizes}
    seats = dict.fromkeys(sizes, 0)
    for _ in range(round(sum(target.values()) / 4)):
        best = max(sizes, key=lambda s: (target[s] / (2 * seats[s] + 1), s is not None, [-ord(c) for c in s or ""]))
        seats[best] += 1
    assert {s: r.blocks for s, r in got.items()} == seats
    assert all(math.isclose(got[s].target, target[s]) for s in sizes)
    per = op4_mixing.shard_quotas(op4_mixing.quotas(op4_mixing.targets(frame, [5, 2, 1], 1.5, 2.0), 4), 3).collect()
    totals = [sum(r.blocks for r in per if r.shard == k) for k in range(3)]
    assert max(totals) - min(totals) <= 1 and sum(totals) == sum(seats.values())


def test_mix_odd_rows(spark, odd):
    rows = op4_mixing.mix(odd, **op4_mixing.PRODUCTION).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert op4_mixing.mix(odd.limit(0), **op4_mixing.PRODUCTION).count() == 0
    mixed = op4_mixing.mixed_rows(odd, **op4_mixing.PRODUCTION)
    assert mixed.columns == odd.columns and {r.text for r in mixed.collect()} <= {r.text for r in odd.collect()}


def test_blocks_of_shards(spark):
    """Every shard takes its quota of every source; each word of a document as often as a walk over the runs does."""
    sizes = {"a": [70, 3, 0, 41, 5], "b": [9, 9, 200], None: [33], "c": [2], "d": [0]}
    rows = [(i, " ".join(["word"] * n), source) for i, (source, n) in enumerate((s, n) for s, all_ in sizes.items() for n in all_)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    how = {**op4_mixing.PRODUCTION, "block": 4, "shards": 3}
    sized = spark.createDataFrame([(s, sum(all_)) for s, all_ in sizes.items()], "source string, source_size long")
    quota = op4_mixing.quotas(op4_mixing.targets(sized, how["weights"], how["share"], how["most"]), 4)
    won = {(r.source, r.shard): r.blocks for r in op4_mixing.shard_quotas(quota, 3).collect()}
    cut = {r.source: r.segments for r in op4_mixing.segments(quota, 3, 4, 2.0, "mix").collect()}
    got = op4_mixing.mix(docs, **how).collect()
    place = lambda r: (int(hashlib.md5(f"mix/{r.doc_id}".encode()).hexdigest()[:15], 16), r.doc_id)
    for source, all_ in sizes.items():
        times = [dict() for _ in range(sum(all_))]
        assert [s.low for s in cut[source]] == [sum(x.size for x in cut[source][:i]) for i in range(len(cut[source]))]
        for s in cut[source]:
            words = s.rounds * s.size + s.left
            assert words == min(won[source, s.shard] * 4, 2 * s.size) and words >= won[source, s.shard] * 4 - 4
            for k in range(words):
                word = times[s.low + (s.run + k) % s.size]
                word[s.shard] = word.get(s.shard, 0) + 1
        at = 0
        for r in sorted((r for r in got if r.source == source), key=place):
            want: dict = {}
            for word in times[at:at + r.size]:
                for shard, n in word.items():
                    want[shard] = want.get(shard, 0) + n
            assert {s.shard: s.words for s in r.shards} == want and r.taken == sum(want.values()) <= 2 * r.size
            at += r.size


def test_aliases_and_precedence(spark):
    link = '<link href="{}" rel="canonical">'
    pages = spark.createDataFrame([
        (1, "http://a.org/x", link.format("https://bad.com/en/1")), (2, "http://b.org/y", '<meta http-equiv=refresh content="0; url=http://a.org/x">'),
        (3, "http://c.org/z#top", link.format("/w")), (4, "http://c.org/w", ""), (5, "http://ok.com/", link.format("http://c.org/w")), (6, None, None), (7, "nourl", link.format("http://bad.com/en/1")),
        (8, "http://d.org/", link.format("http://bad.com/en/1?q") + link.format("http://ok.com/")), (1, "http://a.org/x", link.format("https://bad.com/en/1"))],
        "page_id long, url string, html string")
    rules = op3_url_filter.rule_table(spark, [("block", "bad.com", "/en/"), ("allow", "ok.com", "/"), ("block", "c.org", "/zz")])
    got = {r.page_id: (r.rule, r.verdict) for r in op3_url_filter.judge(pages, rules).collect()}
    assert got == {1: (None, "block"), 2: (None, "block"), 3: (None, "allow"), 4: (None, "allow"), 5: ("ok.com/", "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow")}
    assert op3_url_filter.judge(pages.limit(0), rules).count() == 0


def test_components_by_brute_force(spark):
    edges = [(f"{i}", f"{i // 2}") for i in range(2, 40)] + [("x1", "x2"), ("x2", "x3"), ("y", "y")] + [("hub", f"h{i}") for i in range(60)]
    root: dict = {}
    for a, b in edges:
        for n in (a, b):
            root.setdefault(n, n)
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {n: r for n, r in root.items() if n != "y"}


def test_license_spans(spark, odd):
    got = {r.doc_id: r for r in op6_license_scan.scan(odd, op6_license_scan.PHRASES, op6_license_scan.NOTICES).collect()}
    assert (got[4].n_base, got[4].first_word, got[4].base_labels, got[4].score) == (1, 0, "mit", 1.0)
    assert (got[2].n_words, got[2].n_base, got[2].first_word, got[2].labels) == (0, 0, None, "")
    notice = op6_license_scan.NOTICES[0][1].split()
    edited = " ".join(["Intro", *notice[:20], "really", *notice[20:]])
    more = spark.createDataFrame([(1, edited), (2, "cc by nc cc by nc"), (3, "Permission is hereby granted")], "doc_id long, text string")
    got = {r.doc_id: r for r in op6_license_scan.scan(more, op6_license_scan.PHRASES, op6_license_scan.NOTICES).collect()}
    assert got[1].labels == "mit" and got[1].n_base == 0 and 0.7 <= got[1].score < 1
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 0, 3) and got[3].labels == ""
    assert op6_license_scan.scan(odd.limit(0), op6_license_scan.PHRASES, op6_license_scan.NOTICES).count() == 0


def test_fingerprints_odd_rows(spark, odd):
    rows = op1_fingerprint.fingerprint(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert op1_fingerprint.fingerprint(odd.limit(0)).count() == 0
    one = op1_fingerprint.fingerprint(odd.where("doc_id = 5")).first()
    assert one.near_next == 1.0


def test_similar_pairs(spark):
    base = "the cat of a house is in the old garden with a new friend and they play for the whole long summer day at home by night".split()
    texts = [" ".join(base), " ".join(base + ["truly"]), "entirely other words stand here the quick fox jumps over all dogs", None, "", " ".join(base)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = op1_fingerprint.similar_pairs(docs, 0.8).collect()
    assert len(pairs) == 1 and pairs[0].likeness >= 0.8


def test_shards_of_text_keys(spark):
    docs = spark.createDataFrame([(f"a-{i}", "x") for i in range(400)] + [(None, "y")], "doc_id string, text string")
    rows = op8_sharding.layout(docs, 7).collect()
    assert len(rows) == 401 and {r.shard for r in rows} == set(range(7))
    assert all(r.grown_shard in (r.shard, 7) for r in rows)
    for shard in range(7):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_license_lists_without_or_with_short_phrases(spark):
    docs = spark.createDataFrame([(1, "Under the MIT license, all of it"), (2, None)], "doc_id long, text string")
    assert [(r.doc_id, r.n_base, r.labels) for r in op6_license_scan.scan(docs, [], []).orderBy("doc_id").collect()] == [(1, 0, ""), (2, 0, "")]
    short = op6_license_scan.scan(docs, [("mit", "mit"), ("none", "..."), ("two", "the mit")], []).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in short] == [(7, 2, 1, 2, "mit,two"), (0, 0, None, None, "")]
    assert op6_license_scan.scan(docs, [], [("x", "one")]).count() == 2
