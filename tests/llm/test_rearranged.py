"""Fill-in-middle, packing and the prefix trie against brute force and exact round trips."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import op11_fill_middle, op12_packing, op13_prefix_trie

COLUMNS = "doc_id long, text string, form string, length long, rank long, part int, h1 string"
ODD = ["", None, "a", " ", " \n", "one", "é", "日本 語\tx ", "é é x̸.", "a <P> b", "<S>", "x <M", "P> y", "𝄞𝄞 𝄞", "a　b c", "don't, stop. 12,5.",
       "word " * 30_000, "é" * 5_000, "<|endoftext|> A<|ENDOFTEXT|>.", "\x0b\x0c\r z\x1c."]


def fuzz(seed, n):
    rng = random.Random(seed)
    letters = "ab é日𝄞 \n\t.,<>PSM'"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    texts = ODD + fuzz(1, 60)
    rows = [(i, t, "clash", 7, 8, 9, "mine") for i, t in enumerate(texts)] + [(None, "no key here", None, 1, 1, 1, None), (3, ODD[3], "x", 1, 1, 1, None), (3, ODD[3], "x", 1, 1, 1, None)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


# --- fill in the middle ---------------------------------------------------------------------------


def filled(doc_id, text, unit="word"):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text) if unit == "word" else list(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", ["word", "char"])
def test_fill_middle_by_brute_force(spark, docs, unit):
    made = op11_fill_middle.transform(docs, unit=unit)
    rows = made.select("*", op11_fill_middle.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(rows) == docs.count() and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == filled(r.doc_id, r.text, unit)
        assert r.back == (r.text or "") and r.h1 in ("mine", None)
    assert op11_fill_middle.transform(docs.limit(0), unit=unit).collect() == []


def test_fill_middle_keys_and_units(spark):
    named = spark.createDataFrame([("a-b", "one two three four", 5)], "doc_id string, text string, n int")
    assert op11_fill_middle.transform(named).first().n == 4
    with pytest.raises(ValueError):
        op11_fill_middle.transform(named, unit="line")


def test_exception_index():
    text = "aé日𝄞b" * 50
    data = np.frombuffer(text.encode(), np.uint8)
    index = op11_fill_middle.Exceptions(data)
    cuts = np.arange(len(text) + 1)
    there = np.array([len(text[:c].encode()) for c in cuts])
    assert len(index.at) == 150
    assert (index.bytes(cuts) == there).all() and (index.chars(there) == cuts).all()
    assert len(op11_fill_middle.Exceptions(np.frombuffer(b"plain", np.uint8)).at) == 0


# --- packing --------------------------------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Best fit, longest first, piece by piece: how many sequences have how much room left."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_best_fit_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 17, 64])
    lengths = [min(capacity, 1 + int(rng.expovariate(1 / rng.choice([2, 9, 40])))) for _ in range(rng.choice([1, 40, 700]))]
    counts = collections.Counter(lengths)
    segments = op12_packing.plan(dict(counts), capacity)
    used, seen = collections.defaultdict(list), collections.Counter()
    for at, (length, first, per, sequence, place) in enumerate(segments):
        later = [s[1] for s in segments if s[0] == length and s[1] > first]
        assert seen[length] == first
        many = (min(later) if later else counts[length]) - first
        seen[length] += many
        for i in range(many):
            used[sequence + i // per].append((place + i % per * length, length))
    assert seen == counts
    for parts in used.values():
        edge = 0
        for offset, length in sorted(parts):
            assert offset == edge
            edge += length
        assert edge <= capacity
    assert sorted(capacity - sum(x for _, x in p) for p in used.values()) == one_by_one(lengths, capacity)


def test_packing_round_trip(spark, docs):
    tokenizer = Tokenizer.from_file(WORDS)
    placed = op12_packing.pack(docs, WORDS, 64)
    rows = [r.asDict() for r in placed.collect()]
    got = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in rows:
        assert r["length"] * 4 == len(r["ids"]) and r["start"] == r["piece"] * 64
        got[r["doc_id"]][r["piece"]].append(np.frombuffer(r["ids"], "<u4").tolist())
    want = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    for doc_id, ids in want.items():
        copies = 3 if doc_id == 3 else 1
        cut = {i // 64: ids[i:i + 64] for i in range(0, len(ids), 64)}
        assert {p: v for p, v in got[doc_id].items()} == {p: [v] * copies for p, v in cut.items()}
    whole = {r.sequence_id: r for r in op12_packing.sequences(placed).collect()}
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["ids"]))
    for sequence, parts in by.items():
        assert bytes(whole[sequence].ids) == b"".join(bytes(i) for _, i in sorted(parts)) and whole[sequence].length <= 64
    assert len(by) == len(one_by_one([r["length"] for r in rows], 64))
    assert op12_packing.pack(docs.limit(0), WORDS).collect() == []


def test_words_keep_their_ids():
    """Whole texts through the tokenizer give what the words alone give, also when it starts to remember anew."""
    texts = ODD + fuzz(3, 400)
    encoder = op12_packing._Encoder(WORDS)
    for _, _, data, offsets in op12_packing._texts(pa.array(texts)):
        ids, begin = encoder.encode(data, offsets)
        for i, text in enumerate(texts):
            assert ids[begin[i]:begin[i + 1]].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_packing_remembers_a_bounded_number(monkeypatch):
    monkeypatch.setattr(op12_packing, "REMEMBERED", 20)
    test_words_keep_their_ids()


def test_pieces_must_fit(spark):
    with pytest.raises(ValueError):
        op12_packing.place(spark.createDataFrame([(1, 9)], "doc_id long, length long"), 8)


# --- prefix trie ----------------------------------------------------------------------------------


def nodes_of(convs):
    """conv_id -> list of turns; all nodes by brute force."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = set()
    for p, who in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p))
        out.add((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], sum(children[q] == 0 for q in below),
                 sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def borrowed(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def table(spark, convs, seed=0):
    rows = [(c, i, r, t, "x", 5) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tid string, block int").repartition(5)


def made(seed, n):
    rng = random.Random(seed)
    starts = [[("system", "s" * rng.randint(1, 9)), ("user", rng.choice(["", "é", "hello"]))] for _ in range(2)]
    convs = {}
    for i in range(n):
        c = rng.choice([i, 100 + i, 200 + 7 * i])
        turns = rng.choice(starts)[:rng.randint(0, 2)] if rng.random() < 0.7 else []
        convs[c] = turns + [(rng.choice(["user", "bot"]), rng.choice(["a", "bb", "", "日本"])) for _ in range(rng.choice([1, 2, 6, 9, 16, 17, 40]))]
    return convs


@pytest.mark.parametrize("rebuild", ["none", "heads"])
def test_trie_by_brute_force(spark, monkeypatch, rebuild):
    monkeypatch.setattr(op13_prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(op13_prefix_trie, "BLOCKS_PER_BUCKET", 2)
    monkeypatch.setattr(op13_prefix_trie, "ROWS_PER_RANGE", 30)
    convs = made(4, 60)
    copy = min(convs)
    convs |= {300 + i: convs[copy] for i in range(12)}
    change = op13_prefix_trie.as_they_are if rebuild == "none" else op13_prefix_trie.with_borrowed_heads(100, 6)
    got = [tuple(r) for r in op13_prefix_trie.trie(table(spark, convs), change).collect()]
    assert len(got) == len(set(got)) and set(got) == nodes_of(convs if rebuild == "none" else borrowed(convs))


def test_trie_odd_rows(spark):
    rows = [(1, None, None, None), (1, 2, "user", "x"), (2, 0, "", ""), (2, 5, "user", "x"), (None, 0, "user", "x"), (3, 0, "user", "long " * 9_000)]
    got = {tuple(r) for r in op13_prefix_trie.trie(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()}
    assert got == nodes_of({1: [("", ""), ("user", "x")], 2: [("", ""), ("user", "x")], 3: [("user", "long " * 9_000)]})
    twice = [(1, 0, "user", "x")] * 2 + [(2, 0, "user", "x")]
    got = {tuple(r) for r in op13_prefix_trie.trie(spark.createDataFrame(twice, "conv_id int, turn int, role string, text string")).collect()}
    assert got == nodes_of({1: [("user", "x")] * 2, 2: [("user", "x")]})
    empty = spark.createDataFrame([], "conv_id int, turn int, role string, text string")
    assert op13_prefix_trie.trie(empty).collect() == [] == op13_prefix_trie.trie(empty, op13_prefix_trie.with_borrowed_heads(100, 6)).collect()
