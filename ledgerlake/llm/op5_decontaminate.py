"""Benchmark decontamination: rare n-grams of test items seed places in documents, Smith-Waterman scores them.

How many documents hold each three-word gram of the items is counted over the whole corpus. An item's seeds are the
rarer half of its grams that occur at all (``SEEDS`` at least): the ranking is its own, so an item that leaked into very many documents
keeps its seeds. Where seeds lie on neighbouring diagonals, the document's words around them are aligned with the
item's: a match is worth 1, a mismatch or a gap costs 1. A document is contaminated by an item if the best local
alignment is worth ``LEAST`` of the item's words (all of them for items of up to ``WHOLE`` words).

Items are a query set that is matched with all documents in blocks of at most ``BLOCK_BYTES`` of text, so what goes to
every task is bounded; each block reads the documents twice (counts, then matches) and shuffles only counts.

Defined cases: a null or empty document matches nothing and is clean; an item without words matches nothing; items of
one or two words use grams of their own length; equal documents and equal items get equal rows each; null ids are
kept; an empty table of either kind gives no matches; extra columns are ignored by ``matches`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.llm.common import read
from ledgerlake.llm.words import Words, chunks

GRAM, SEEDS = 3, 8
LEAST, WHOLE = 0.5, 8
BLOCK_BYTES = 4 << 20
_FILTER_BITS = 20


class Items:
    """Word codes of the items of one block and where their grams stand."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids: list = []
        self.codes: list[np.ndarray] = []
        hashes, items, places = {}, {}, {}
        for start, end, words in chunks(pa.array(texts, pa.string())):
            counts = words.counts()
            first = np.r_[0, np.cumsum(counts)]
            for t in range(end - start):
                if counts[t]:
                    self.ids.append(ids[start + t])
                    self.codes.append(words.code[first[t]:first[t + 1]])
            for n in range(1, GRAM + 1):
                at, grams = words.grams(n)
                own = np.minimum(counts[words.of[at]], GRAM) == n
                base = len(self.ids) - np.count_nonzero(counts)
                number = base + np.cumsum(counts > 0) - 1
                hashes.setdefault(n, []).append(grams[own])
                items.setdefault(n, []).append(number[words.of[at[own]]])
                places.setdefault(n, []).append(at[own] - first[words.of[at[own]]])
        self.sizes = [n for n in hashes if sum(map(len, hashes[n]))]
        #: Per gram length: sorted different grams, then (gram number, item, place) of every occurrence.
        self.grams, self.where = {}, {}
        for n in self.sizes:
            self.grams[n], number = np.unique(np.concatenate(hashes[n]), return_inverse=True)
            self.where[n] = (number, np.concatenate(items[n]), np.concatenate(places[n]))
        self.filters = {n: self._filter(g) for n, g in self.grams.items()}

    @staticmethod
    def _filter(grams: np.ndarray) -> np.ndarray:
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[grams >> np.uint64(64 - _FILTER_BITS)] = True
        return seen

    def hits(self, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, gram number) of every gram of the texts that an item has."""
        at, grams = words.grams(n)
        near = np.flatnonzero(self.filters[n][grams >> np.uint64(64 - _FILTER_BITS)])
        at, grams = at[near], grams[near]
        number = np.minimum(np.searchsorted(self.grams[n], grams), len(self.grams[n]) - 1)
        same = self.grams[n][number] == grams
        return at[same], number[same]

    def keep_rare(self, often: dict[int, np.ndarray]) -> None:
        """Leave only the seeds: of each item the rarer half of its grams."""
        for n in self.sizes:
            number, item, place = self.where[n]
            pair = np.unique(item * len(self.grams[n]) + number)
            # A gram that no document holds seeds nothing, and must not take the place of one that does.
            pair = pair[often[n][pair % len(self.grams[n])] > 0]
            of, gram = pair // len(self.grams[n]), pair % len(self.grams[n])
            order = np.lexsort((gram, often[n][gram], of))
            of, gram = of[order], gram[order]
            rank = np.arange(len(of)) - np.searchsorted(of, of)
            total = np.bincount(of, minlength=len(self.ids))[of]
            seed = rank < np.maximum((total + 1) // 2, SEEDS)
            chosen = np.isin(item * len(self.grams[n]) + number, of[seed] * len(self.grams[n]) + gram[seed])
            number, item, place = number[chosen], item[chosen], place[chosen]
            order = np.argsort(number, kind="stable")
            self.where[n] = (number[order], item[order], place[order])
            self.filters[n] = self._filter(self.grams[n][np.unique(number)])


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (worth, end in the item, end in the text), ends exclusive."""
    steps = np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1, np.int64)
    best, ends = 0, (0, 0)
    for i, word in enumerate(item):
        row = np.zeros_like(above)
        row[1:] = np.maximum(np.maximum(above[:-1] + np.where(text == word, 1, -1), above[1:] - 1), 0)
        # A gap in the item costs one for each word passed: the running maximum of worth + position, less position.
        row = np.maximum.accumulate(row + steps) - steps
        j = int(row.argmax())
        if row[j] > best:
            best, ends = int(row[j]), (i + 1, j)
        above = row
    return best, *ends


def least_worth(words: int) -> float:
    return max(LEAST * words, min(words, WHOLE))


def find(items: Items, words: Words) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, first word, last word) of the best place of each item in each contaminated text."""
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    first = np.searchsorted(words.of, np.arange(len(words.offsets)))
    for n in items.sizes:
        at, number = items.hits(words, n)
        gram, item, place = items.where[n]
        low, high = np.searchsorted(gram, number), np.searchsorted(gram, number, "right")
        reps = high - low
        each = np.repeat(np.arange(len(at)), reps)
        post = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(low, reps)
        of, to, diagonal = words.of[at[each]], item[post], at[each] - place[post]
        order = np.lexsort((diagonal, to, of))
        of, to, diagonal = of[order], to[order], diagonal[order]
        if not len(of):
            continue
        length = np.array([len(c) for c in items.codes])
        slack = length[to] // 2 + 2
        new = np.r_[True, (of[1:] != of[:-1]) | (to[1:] != to[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])]
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], len(of)] - 1
        for a, b in zip(starts, ends):
            text, which = int(of[a]), int(to[a])
            codes = items.codes[which]
            left = max(int(diagonal[a] - slack[a]), int(first[text]))
            right = min(int(diagonal[b] + len(codes) + slack[a]), int(first[text + 1]))
            part = words.code[left:right]
            worth, i, j = align(codes, part)
            if worth < least_worth(len(codes)):
                continue
            _, _, back = align(codes[:i][::-1], part[:j][::-1])
            score = worth / len(codes)
            start = left + j - back - int(first[text])
            if (text, which) not in found or score > found[text, which][0]:
                found[text, which] = (score, start, start + back - 1)
    return [(text, which, *what) for (text, which), what in sorted(found.items())]


def blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Items]:
    """The items block by block, each with its seeds, chosen by counts over all documents."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = int(size // BLOCK_BYTES) + 1
    for block in range(many):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(many)) == block).orderBy("item_id", "text").collect()
        held = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        if not held.sizes:
            continue
        known = docs.sparkSession.sparkContext.broadcast(held)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            often = {n: np.zeros(len(known.value.grams[n]), np.int64) for n in known.value.sizes}
            for batch in batches:
                for _, _, words in chunks(batch.column("text")):
                    for n in often:
                        at, number = known.value.hits(words, n)
                        once = np.unique(words.of[at] * len(often[n]) + number) % len(often[n])
                        often[n] += np.bincount(once, minlength=len(often[n]))
            for n, counts in often.items():
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), n, np.int32)), pa.array(some), pa.array(counts[some])], ["n", "gram", "often"])

        counted = docs.select("text").mapInArrow(count, "n int, gram long, often long").groupBy("n", "gram").agg(F.sum("often").alias("often")).toPandas()
        often = {n: np.zeros(len(held.grams[n]), np.int64) for n in held.sizes}
        for n in held.sizes:
            own = counted[counted["n"] == n]
            often[n][own["gram"].to_numpy(np.int64)] = own["often"]
        held.keep_rare(often)
        yield held


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every contaminated document and item."""
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType
    kept_as = to_arrow_type(kind)
    schema = docs.select("doc_id").schema.add("item_id", kind).add("score", "double").add("first_word", "long").add("last_word", "long")
    result = None
    for held in blocks(docs, benchmark):
        known = spark.sparkContext.broadcast(held)

        def search(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, _, words in chunks(batch.column("text")):
                    rows = find(known.value, words)
                    if rows:
                        of, item, score, first, last = zip(*rows)
                        ids = batch.column("doc_id").take(pa.array(np.array(of) + start))
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array([known.value.ids[i] for i in item], kept_as), pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                            ["doc_id", "item_id", "score", "first_word", "last_word"])

        part = docs.select("doc_id", "text").mapInArrow(search, schema)
        result = part if result is None else result.unionByName(part)
    return result if result is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item has contaminated, unchanged."""
    result = docs
    for held in blocks(docs, benchmark):
        known = docs.sparkSession.sparkContext.broadcast(held)

        def drop(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stay = np.ones(batch.num_rows, bool)
                for start, _, words in chunks(batch.column("text")):
                    for text, *_ in find(known.value, words):
                        stay[start + text] = False
                yield batch.filter(pa.array(stay))

        result = result.mapInArrow(drop, docs.schema)
    return result


def op5_seed_and_align(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against every benchmark item."""
    return matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
