"""Near copies, decontamination, extraction, passage dedup and quality against brute force, and the pipeline."""

import collections
import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import op2_ngram_join, op5_decontaminate, op7_html, op9_suffix_dedup, op10_quality
from ledgerlake.llm.common import written

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, copies long, weight double"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "", "en", "a", 0, "k", 1, 1.0), (2, None, None, None, None, None, None, None), (None, "one two three four five six", "en", "b", 1, "k", 1, 1.0),
            (3, "very long text " * 9_000, "en", "b", 1, "k", 1, 1.0), (3, "very long text " * 9_000, "en", "b", 1, "k", 1, 1.0),
            (4, "short one", "en", "b", 1, "k", 1, 1.0), (5, "short one", "en", "b", 1, "k", 1, 1.0), (6, "?", "en", "c", 7, "k", 1, 1.0), (7, "é à", "en", "c", 7, "k", 1, 1.0)]
    return spark.createDataFrame(rows, COLUMNS)


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def linked(texts):
    """ids -> ids at 0.8 or above, and each id's class."""
    sets = {i: shingles(t) for i, t in texts.items()}
    near = {i: {j for j in sets if j != i and (texts[i] == texts[j] or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9)} for i in sets}
    name = {}
    for i in sorted(sets):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in name:
                name[j] = i
                todo += near[j]
    return near, name


@pytest.mark.parametrize("block", [512, 3])
def test_links_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(op2_ngram_join, "BLOCK", block)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    base = [r.text for r in docs.orderBy("doc_id").limit(12).collect()]
    noise = random.Random(2)
    made = [(10_000 + i, " ".join(w if noise.random() > 0.01 else "zz" + w for w in base[i % 12].split(" ")) if i % 4 else base[i % 12].upper()) for i in range(60)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    near, name = linked(texts)
    for row in op2_ngram_join.link(docs).collect():
        assert row.class_id == name[row.doc_id] and row.n_partners == len(near[row.doc_id])
        assert row.n_links == len({texts[j] for j in near[row.doc_id]} - {texts[row.doc_id]})
    assert {r.doc_id for r in op2_ngram_join.representatives(docs).collect()} == set(name.values())


def test_candidates_of_known_likeness(spark, monkeypatch):
    """Windows that slide over one long text: neighbours at 0.5 chain nothing together, neighbours at 0.8 are all tied."""
    noise = random.Random(5)
    count, size = 250, 304
    for step, near in ((100, 0), (33, count - 1)):
        line = [f"w{noise.randrange(10**9)}" for _ in range(step * count + size)]
        rows = [(i, " ".join(line[i * step:i * step + size])) for i in range(count)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.encode(F.col("doc_id").cast("string"), "utf-8"))
        _, texts = op2_ngram_join.signed_texts(docs)
        found = [{int(r.a), int(r.b)} for r in op2_ngram_join.candidates(texts).collect()]
        assert len([p for p in found if max(p) - min(p) == 1]) >= near
        assert near or not found
    # A bucket that is not gathered ties all its texts.
    monkeypatch.setattr(op2_ngram_join, "BUCKET", 1)
    assert len(op2_ngram_join.candidates(texts).collect()) >= near


def test_bucket_roots():
    a, b = np.zeros(160, np.uint8), np.ones(160, np.uint8)
    half = np.where(np.arange(160) < 50, b, a).astype(np.uint8)  # alike to a, not to b
    more = np.where(np.arange(160) < 105, b, a).astype(np.uint8)  # alike to half, not to a
    got = op2_ngram_join.bucket_roots(np.array([1, 1, 2, 2, 2, 2, 3]), np.stack([a, b, a, b, more, half, a]))
    assert got.tolist() == [0, 1, 2, 2, 2, 2, 6]


def test_links_odd_rows(spark, odd):
    rows = op2_ngram_join.link(odd).collect()
    assert len(rows) == odd.count()
    assert {r.class_id for r in rows if r.doc_id in (4, 5)} == {4}
    stays = op2_ngram_join.representatives(odd)
    assert stays.columns == odd.columns and stays.count() == 6
    assert op2_ngram_join.link(odd.limit(0)).count() == 0 and op2_ngram_join.representatives(odd.limit(0)).count() == 0


def worth(item, text):
    """Plain Smith-Waterman."""
    best, above = 0, [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, above[j] + (1 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment_by_brute_force():
    noise = np.random.default_rng(5)
    for _ in range(50):
        a, b = noise.integers(0, 5, 12).astype(np.uint64), noise.integers(0, 5, 20).astype(np.uint64)
        assert op5_decontaminate.align(a, b)[0] == worth(a.tolist(), b.tolist())


def test_leaks_by_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    noise = random.Random(3)
    made = []
    for i, text in items.items():
        changed = [w if noise.random() > 0.12 else "changed" for w in text.split(" ")]
        made.append((20_000 + i, "before it " + " ".join(changed) + " after it"))
    extra = spark.createDataFrame(made + [(None, None), (1, ""), (30_000, items[0]), (30_000, items[0])], "doc_id long, text string")
    docs = docs.unionByName(extra)
    want = collections.Counter()
    for row in docs.collect():
        for i, text in items.items():
            need = op5_decontaminate.least_worth(len(words(text)))
            own = words(row.text)
            if set(words(text)) & set(own) and worth(words(text), own) >= need:
                want[row.doc_id, i] += 1
    got = op5_decontaminate.matches(docs, bench)
    assert collections.Counter((r.doc_id, r.item_id) for r in got.collect()) == want
    dirty = {d for d, _ in want}
    assert sorted(r.doc_id for r in op5_decontaminate.clean(docs.where("doc_id is not null"), bench).collect()) == sorted(
        r.doc_id for r in docs.collect() if r.doc_id is not None and r.doc_id not in dirty)
    # Items in several blocks give the same rows.
    monkeypatch.setattr(op5_decontaminate, "BLOCK_BYTES", 2000)
    assert collections.Counter((r.doc_id, r.item_id) for r in op5_decontaminate.matches(docs, bench).collect()) == want


def test_leaks_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, None), (None, ""), (2, "short one"), (3, "?"), (2, "short one"), (4, "à")], "item_id long, text string")
    rows = op5_decontaminate.matches(odd, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(4, 2), (4, 2), (5, 2), (5, 2), (7, 4)]
    stays = op5_decontaminate.clean(odd, bench)
    assert stays.columns == odd.columns and stays.count() == 6
    assert op5_decontaminate.matches(odd.limit(0), bench).count() == 0 and op5_decontaminate.clean(odd, bench.limit(0)).count() == 9


def test_loser_tree_by_sorting():
    noise = random.Random(4)
    runs = [sorted(bytes(noise.choices(b"ab", k=noise.randint(0, 9))) for _ in range(noise.randint(1, 40))) for _ in range(7)]
    coded = []
    for run in runs:
        shared, rest = op9_suffix_dedup.front_code(run)
        coded.append(op9_suffix_dedup.Run(shared, np.array([len(x) for x in run]), rest))
    out = list(op9_suffix_dedup.merged(coded))
    assert [x for _, _, x in out] == sorted(sum(runs, []))
    before = b""
    for _, shared, item in out:
        assert shared == op9_suffix_dedup.common_prefix(before, item)
        before = item


@pytest.mark.parametrize("crowd", [10**9, 1])
def test_passages_by_brute_force(spark, odd, crowd):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    noise = random.Random(6)
    passage = "".join(noise.choices("abcdefgh ", k=700))
    made = [(100_000 + i, "".join(noise.choices("xyz é", k=500)) + passage[i * 37:i * 37 + 399 + i] + "".join(noise.choices("uvw", k=300))) for i in range(8)]
    docs = docs.unionByName(spark.createDataFrame([*made, (200_000, "a" * 1500), (200_001, passage + passage)], "doc_id long, text string")).unionByName(odd.select("doc_id", "text"))
    bodies = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = collections.Counter(b[i:i + 400] for _, b in bodies for i in range(len(b) - 399))
    want = []
    for i, body in bodies:
        gone = np.zeros(len(body), bool)
        for at in range(len(body) - 399):
            if seen[body[at:at + 400]] > 1:
                gone[at:at + 400] = True
        keep = np.frombuffer(body, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]]))
        want.append((str(i), len(body), int(gone.sum()), spans, hashlib.sha256(keep).hexdigest()))
    got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op9_suffix_dedup.repeats(docs, crowd).collect()]
    assert sorted(got) == sorted(want)
    assert op9_suffix_dedup.repeats(docs.limit(0), crowd).count() == 0


def test_passages_of_the_query_by_brute_force(spark):
    """The whole table of sf0.01 by the contract, window by window."""
    folder = "/root/testdata/sf0.01"
    bodies = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    seen = collections.Counter(hashlib.blake2b(b[i:i + 400], digest_size=12).digest() for _, b in bodies for i in range(len(b) - 399))
    want = {}
    for doc_id, body in bodies:
        gone = np.zeros(len(body) + 1, np.int32)
        for at in range(len(body) - 399):
            if seen[hashlib.blake2b(body[at:at + 400], digest_size=12).digest()] > 1:
                gone[at] += 1
                gone[at + 400] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        keep = np.frombuffer(body, np.uint8)[~gone].tobytes()
        want[doc_id] = (len(body), int(gone.sum()), int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]])), hashlib.sha256(keep).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op9_suffix_dedup.op9_suffix_runs(spark, folder).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0


def plain_match(a, b):
    """Size of the largest match, by the recursion itself."""
    if a[0] != b[0]:
        return 0
    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), best(x[1:], y[1:]) + plain_match(x[0], y[0]))
    return 1 + best(a[2], b[2])


def test_tree_matching_by_brute_force():
    noise = random.Random(7)
    def grow(depth):
        return [noise.choice("ab"), 0, [grow(depth - 1) for _ in range(noise.randint(0, 3))] if depth else []]
    for _ in range(60):
        a, b = ["r", 0, [grow(2), grow(1)]], ["r", 0, [grow(2), grow(1), grow(1)]]
        assert len(op7_html.match(a, b)) == plain_match(a, b)


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li>menu</ul></nav>
<script>var x = "</p><p>no";</script><article><h1>{title}</h1><p>We use cookies everywhere.</p><div class="ad">buy</div><p>First &amp;  <b>bold{n}
<br><p>Second&nbsp;one<ul><li>item {n}<li>more</ul><section class="comments"><p>nice</p></section><form><p>mail</p></form></article>
<aside>side</aside><footer>foot</footer></body></html>"""


def test_extraction(spark, odd):
    rows = [(i, f"http://h.org/{i}", PAGE.format(title=f"Title {i}", n=i)) for i in range(8)]
    rows += [(8, None, None), (9, "http://one.org/", ""), (10, "http://one.org/", "<p>plain"), (10, "http://one.org/", "<p>plain"), (11, "x", "no markup &lt;here&gt;")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in op7_html.extract(pages).collect()}
    for i in range(8):
        # The cookie line stands in one run of leaves with what differs, so only the slots around it vary.
        assert got[i].text.replace("We use cookies everywhere.\n\n", "") == f"Title {i}\n\nFirst & bold{i}\n\nSecond one\n\nitem {i}\n\nmore"
        assert got[i].n_chars == len(got[i].text)
    assert (got[8].text, got[9].text, got[10].text, got[11].text) == ("", "", "plain", "no markup <here>")
    assert op7_html.extract(pages.limit(0)).count() == 0


def test_template_slots(spark):
    page = "<body><div id=top>Always the same</div><div id=main><p>own {0}</p></div><div id=end>Imprint</div></body>"
    pages = spark.createDataFrame([(i, f"http://h.org/{i}", page.format(i)) for i in range(6)], "page_id long, url string, html string")
    assert {r.text for r in op7_html.extract(pages).collect()} == {f"own {i}" for i in range(6)}


@pytest.mark.parametrize("page", [
    '<body class="no-sidebar"><article><p>The text</p></article></body>', '<div class="content with-sidebar"><article><p>The text</p></article><nav>x</nav></div>',
    '<article class="review"><p>The text</p></article><div class="sidebar">s</div>', '<article title="the hidden valley"><p>The text</p></article>',
    "<article></article><main>The text</main>", '<form id="all"><nav>menu</nav><article>The text</article></form>', '<div class="comments-layout"><article>The text</article></div>',
    '<article>The text</article><section class="comments"><article>nice</article></section>', "<article>The text<p hidden>no</p><div style='color:red; display : none'>no</div></article>",
    '<body><div aria-hidden="true">no</div><p data-x="hidden">The text</p></body>',
])
def test_articles_are_found(page):
    assert op7_html.main_text(page, None, set()) == "The text"


def test_two_articles_and_text_beside_them():
    page = "<main><p>before</p><article>one</article><article>two</article></main><article>three</article>"
    assert op7_html.main_text(page, None, set()) == "before\n\none\n\ntwo"


def test_deep_and_wide_pages():
    deep = "<div>" * 10_000 + "<p>inside</p>" + "</div>" * 10_000
    wide = "<article><table>" + "".join(f"<tr><td>{i}<td>x{i % 7}" for i in range(20_000)) + "</table></article>"
    other = "<article><table>" + "".join(f"<tr><td>{i * 3}<td>{'y' * (i % 5)}" for i in range(19_000)) + "</table></article>"
    assert op7_html.main_text(deep, op7_html.tree(op7_html.parse(deep)), {0}) == "inside"
    trees = [op7_html.tree(op7_html.parse(t)) for t in (wide, other)]
    assert len(op7_html.match(*trees)) > 19_000 * 3
    assert op7_html.main_text("word " * 500_000, None, set()).count("word") == 500_000


def best_match(a, b):
    """(nodes, equal texts) of the best match of two nested trees, by the recursion itself."""
    if a[0] != b[0]:
        return (0, 0)
    best = [[(0, 0)] * (len(b[2]) + 1) for _ in range(len(a[2]) + 1)]
    for i in reversed(range(len(a[2]))):
        for j in reversed(range(len(b[2]))):
            got = best_match(a[2][i], b[2][j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], (best[i + 1][j + 1][0] + got[0], best[i + 1][j + 1][1] + got[1]))
    return (1 + best[0][0][0], (a[1] == b[1]) + best[0][0][1])


def test_matching_does_not_depend_on_size(monkeypatch):
    """Long lists of children are matched as short ones are: the best sum, and the same pairs."""
    noise = random.Random(11)
    def grow(depth):
        return [noise.choice("aab"), noise.choice([0, 1, 2, noise.randint(3, 40)]), [grow(depth - 1) for _ in range(noise.randint(0, 4))] if depth else []]
    for _ in range(40):
        a, b = (["r", 0, [grow(noise.randint(0, 3)) for _ in range(noise.randint(1, 9))]] for _ in "ab")
        got = []
        for cells, kept in ((10 ** 9, 10 ** 9), (0, 10 ** 9), (0, 10), (12, 40)):
            monkeypatch.setattr(op7_html, "CELLS", cells)
            monkeypatch.setattr(op7_html, "KEPT", kept)
            got.append(op7_html.match(a, b))
        assert got.count(got[0]) == 4
        marks = [op7_html._flat(t)["m"] for t in (a, b)]
        assert (len(got[0]), sum(marks[0][x] == marks[1][y] for x, y in got[0])) == best_match(a, b)


def test_long_lists_are_matched_best():
    """The second list starts with rows that the first lacks, so rows taken as they come share no text."""
    first, second = (["r", 0, [["tr", 0, [["td", n, []], ["td", -n, []]]] for n in numbers]] for numbers in ([*range(101, 401), 5000], [*range(1, 401), 6000]))
    got = op7_html.match(first, second)
    marks = [op7_html._flat(t)["m"] for t in (first, second)]
    assert (len(got), sum(marks[0][x] == marks[1][y] for x, y in got)) == best_match(first, second) == (1 + 3 * 301, 1 + 301 + 600)
    mixed = [["r", 0, [[kind, n, []] for n, kind in enumerate(kinds, 1)]] for kinds in ("p" * 250 + "hp" * 150, "hp" * 150 + "q" * 300)]
    assert len(op7_html.match(*mixed)) == best_match(*mixed)[0] == 301


def test_unnamed_boilerplate_goes(spark):
    """Given pages with lines added that stand on every page and name no role: the wrapper takes those and nothing else."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").withColumn("url", F.concat(F.lit("http://one.org/"), "page_id"))
    before = {r.page_id: r.text for r in op7_html.extract(pages).collect()}
    line = "<p>Read by everyone, every day.</p>"
    told = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "<article>", f"<article>{line}"), "</article>", "<div>All rights kept</div></article>"))
    alone = {r.page_id: op7_html.main_text(r.html, None, set()) for r in told.select("page_id", "html").collect()}
    after = {r.page_id: r.text for r in op7_html.extract(told).collect()}
    changed = [i for i in alone if "Read by everyone" in alone[i] and len(before[i]) > 200]
    assert len(changed) > 20
    for i in changed:
        assert after[i] == before[i]


def test_item_ids_of_other_types(spark):
    text = "it was a bright cold day in april and the clocks were striking thirteen"
    docs = spark.createDataFrame([("d-1", "so " + text + " so"), ("d-2", "nothing of it")], "doc_id string, text string")
    items = spark.createDataFrame([(7, text)], "item_id int, text string")
    assert [(r.doc_id, r.item_id) for r in op5_decontaminate.matches(docs, items).collect()] == [("d-1", 7)]


def test_limit_in_whole_numbers():
    """Sets at exactly the limit and one shingle below it, far above what single precision holds apart."""
    for scale in (1, 4_001, 60_000):
        sizes, shared = 9 * scale, 8 * scale
        union = 2 * sizes - shared
        assert (10 * shared >= round(10 * op2_ngram_join.LEAST) * union) and not (10 * (shared - 1) >= round(10 * op2_ngram_join.LEAST) * (union + 2))


def test_votes_by_brute_force(spark):
    noise = random.Random(12)
    made = [[("p", noise.choice(["same", f"own {i}"])) for _ in range(3)] + [("h2", "Always"), ("div", f"only {i}")] for i in range(9)]
    pages = spark.createDataFrame([(i, "http://h.org/x", "<body>" + "".join(f"<{t}>{x}</{t}>" for t, x in page) + "</body>") for i, page in enumerate(made)], "page_id long, url string, html string")
    row = op7_html.templates(pages).first()
    reference = json.loads(row.reference)
    trees = {json.dumps(op7_html.tree(op7_html.parse(r.html))) for r in pages.collect()}
    same = collections.Counter(r for t in trees for r, p in op7_html.match(reference, json.loads(t)) if reference["m"][r] == json.loads(t)["m"][p])
    assert set(row.template) == {r for r, n in same.items() if n >= op7_html.SHARE * len(trees) and reference["m"][r]}


def test_quality_held_out(spark):
    """Fit on one half of the labels, judged on the other."""
    noise = random.Random(8)
    vocabulary = ["".join(noise.choices("abcdefghij", k=noise.randint(2, 7))) for _ in range(400)]
    def text(kind):
        w = noise.choices(vocabulary, k=noise.randint(20, 200))
        if kind == "toxic":
            w = [noise.choice(["idiot", "moron"]) if noise.random() < 0.05 else x for x in w] + ["idiot"]
        return "!! ".join(x.upper() for x in w) if kind == "junk" else " ".join(w)
    kinds = [noise.choices(["good", "toxic", "junk"], [8, 1, 1])[0] for _ in range(3000)]
    docs = spark.createDataFrame([(i, text(k), "x") for i, k in enumerate(kinds)], "doc_id long, text string, log_weight string")
    labels = spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, k in enumerate(kinds) if i % 2], "doc_id long, quality int, toxic int")
    kept = op10_quality.kept(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    held = [(i in ids, k) for i, k in enumerate(kinds) if i % 2 == 0]
    assert sum(stays for stays, k in held if k == "good") >= 0.98 * sum(k == "good" for _, k in held)
    assert sum(stays for stays, k in held if k != "good") <= 0.03 * sum(k != "good" for _, k in held)
    assert op10_quality.kept(docs, labels, k=1000).count() == 1000


def test_kth_key(spark):
    keys = [1.0, 5.0, 5.0, -2.0, 0.5, float(10**6)]
    frame = written(spark.createDataFrame([(k,) for k in keys], "key double"), "keys")
    for k in range(1, 6):
        assert op10_quality.kth_key(frame, k) == sorted(keys, reverse=True)[k - 1]
    assert op10_quality.kth_key(frame, 6) == -np.inf and op10_quality.kth_key(frame, 0) == np.inf


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (4, None, None), (None, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        stays = op10_quality.kept(odd, some)
        assert stays.columns == odd.columns and stays.count() == odd.count()
    assert op10_quality.kept(odd.limit(0), labels).count() == 0


def test_quality_models_by_brute_force(spark, odd):
    """Counts, ratios and weights against loops over Python sets."""
    noise = random.Random(4)
    texts = [" ".join(noise.choices(["aa", "bb", "toxicword", "dd", "Eeeee", "é!"], [9, 9, 2, 9, 3, 1], k=noise.randint(0, 30))) for _ in range(150)] + [None, ""]
    docs = spark.createDataFrame([(f"id-{i}", t) for i, t in enumerate(texts)], "doc_id string, text string").repartition(3)
    labels = spark.createDataFrame([(f"id-{i}", int("toxicword" not in (t or "")), 0) for i, t in enumerate(texts) if i % 2], "doc_id string, quality int, toxic int")
    good, bad = op10_quality.labelled(labels)
    assert (len(good), len(bad)) == (sum("toxicword" not in (t or "") for t in texts[1::2]), sum("toxicword" in (t or "") for t in texts[1::2]))

    def buckets(text):
        import pyarrow as pa

        for _, _, found in op10_quality.chunks(pa.array([text]), marks=True):
            return set(op10_quality.ngrams(found)[1].tolist())
        return set()

    sets = [buckets(t) for t in texts]
    target = [s for i, s in enumerate(sets) if i % 2 and "toxicword" not in (texts[i] or "")]
    raw_count, target_count = collections.Counter(b for s in sets for b in s), collections.Counter(b for s in target for b in s)
    raw, hit, documents, targets = op10_quality.models(docs, good)
    assert (documents, targets) == (len(texts), len(target))
    for b, n in raw_count.items():
        assert (raw[b], hit[b]) == ((n, target_count[b]) if n >= op10_quality.SURE ** 2 else (0, 0))
    ratio = op10_quality.ratios(raw, hit, documents, targets)
    for b in np.flatnonzero(raw):
        expected = raw[b] * targets / documents
        certain = expected - hit[b] >= op10_quality.SURE * expected ** 0.5 and hit[b] <= op10_quality.LESS * expected
        assert ratio[b] == pytest.approx(np.log((hit[b] + 1) / (expected + 1)) if certain else 0.0, abs=1e-6)
    assert (ratio < 0).any()
    for row in op10_quality.weights(docs, ratio).collect():
        mine = buckets(row.text)
        assert row.log_weight == pytest.approx(sum(float(ratio[b]) for b in mine) / max(len(mine), 1) ** 0.5, abs=1e-5)


def test_pipeline_stages(spark, odd):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before, at = at, written(stage(spark, at, FOLDER), f"test-{name}")
        if name != "sharding":
            assert at.columns == docs.columns
        if name != "source_mixing":
            assert at.count() <= before.count()
    assert at.where("shard between 0 and 23 and (grown_shard = shard or grown_shard = 24)").count() == at.count() > 0
    assert corpus_pipeline.run(spark, FOLDER).count() == at.count()
    sizes = {r.doc_id for r in at.select(F.col("doc_id")).collect()}
    assert sizes <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_odd_rows(spark, odd):
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, FOLDER), "odd")
        assert set(odd.columns) - {"shard"} <= set(docs.columns)
