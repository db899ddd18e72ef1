"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets verify them.

A text's set are the hashes of its five-word shingles. ``BANDS`` bands of ``ROWS`` minima meet a pair at Jaccard 0.8
with probability 1 - (1 - 0.8^5)^32 = 0.999997. Texts are shuffled on band hashes (narrow rows). Bands also meet two of
three pairs at 0.5, which would chain unlike texts into one group, so a bucket ties only texts that agree in ``AGREE`` of
all ``BANDS * ROWS`` minima (one byte of each): 4.7 standard deviations below 0.8, so one link in a million is lost, and
3.7 above 0.5. Tied texts form candidate groups; then every text of a group comes once, with its full set, to where
the group is verified. There the shared shingles of all texts of a group are counted block by block, so every link is
found and counted, but only one row per text leaves: no list of pairs is made, however large a group of near copies is.
A bucket above ``BUCKET`` texts is never gathered: its texts are all tied to its first, which can only add candidates.

A copy is one text: it is verified once and shares its result. Groups above ``BLOCK`` texts are split into pairs of
blocks which different tasks verify.

Defined cases: a null text counts as empty; a text of one to four words has one shingle, all its words; texts without
words are alike only if they are equal; a null doc_id is kept and never names a class if another id can; equal rows
fall into one class; an empty table gives an empty result; extra columns are ignored by ``link`` and kept by
``representatives``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ledgerlake.llm.common import components, fresh, read, text_key, written
from ledgerlake.llm.words import Words, chunks, scatter

N, LEAST = 5, 0.8
BANDS, ROWS = 32, 5
AGREE = 0.65
BLOCK, BUCKET = 512, 1024
#: Columns of the shingle matrix multiplied at a time.
WIDTH = 4096

_FACTORS = scatter(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(words: Words, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle, by text, repeats included."""
    first, grams = words.grams(n)
    of = words.of[first]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        start = np.searchsorted(words.of, short)
        whole = np.zeros(len(short), np.uint64)
        for j in range(n - 1):
            more = counts[short] > j
            at = np.where(more, start + j, 0)
            whole = np.where(more, scatter(whole + words.code[at]), whole)
        of, grams = np.concatenate([of, short]), np.concatenate([grams, whole])
        order = np.argsort(of, kind="stable")
        of, grams = of[order], grams[order]
    return of, grams


def band_hashes(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts with shingles, their BANDS hashes, a byte of each of their BANDS * ROWS minima)."""
    of, grams = shingles(words)
    if not len(of):
        return np.zeros(0, np.int64), np.zeros((0, BANDS), np.int64), np.zeros((0, BANDS * ROWS), np.uint8)
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    out = np.zeros((len(starts), BANDS), np.uint64)
    minima = np.zeros((len(starts), BANDS * ROWS), np.uint8)
    for band in range(BANDS):
        mixed = np.full(len(starts), band + 1, np.uint64)
        for row in range(ROWS):
            # Multiplying by an odd number permutes 64-bit values; minima of well-spread hashes are MinHash values.
            least = np.minimum.reduceat(grams * _FACTORS[band * ROWS + row], starts)
            mixed = scatter(mixed + least)
            minima[:, band * ROWS + row] = least & np.uint64(255)
        out[:, band] = mixed
    return of[starts], out.view(np.int64), minima


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, words in chunks(batch.column("text")):
            has, bands, minima = band_hashes(words)
            lists: list = [None] * (end - start)
            signs: list = [None] * (end - start)
            for i, row, sign in zip(has, bands, minima):
                lists[i], signs[i] = row, sign.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(start, end - start), batch.column("key").slice(start, end - start),
                 pa.array(lists, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                ["doc_id", "key", "bands", "minima"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full shingle sets, as bytes of sorted 64-bit hashes."""
    for batch in batches:
        for start, end, words in chunks(batch.column("text")):
            of, grams = shingles(words)
            edges = np.searchsorted(of, np.arange(end - start + 1))
            packed = [np.unique(grams[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])]
            columns = [c.slice(start, end - start) for name, c in zip(batch.schema.names, batch.columns) if name != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], [*[n for n in batch.schema.names if n != "text"], "shingles"])


def bucket_roots(bucket: np.ndarray, minima: np.ndarray) -> np.ndarray:
    """For each row the first row of its bucket that it is tied to, through others if need be; rows come by bucket."""
    rows = np.arange(len(bucket))
    start = np.searchsorted(bucket, bucket)
    need = AGREE * minima.shape[1]
    # Most buckets hold copies of one text, alike to their first; only the others are compared among themselves.
    root = np.where((minima == minima[start]).sum(axis=1) >= need, start, rows)
    for first in np.unique(start[root != start]):
        end = np.searchsorted(bucket, bucket[first], "right")
        own = minima[first:end]
        alike = np.stack([(own == row).sum(axis=1) >= need for row in own])
        root[first:end] = first + _roots(alike)
    return root


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, key, minima) come sorted by band; a bucket is held until its last row is seen."""
    def tied(table: pa.Table) -> pa.RecordBatch:
        minima = np.frombuffer(b"".join(table.column("minima").to_pylist()), np.uint8).reshape(len(table), BANDS * ROWS)
        root = bucket_roots(table.column("band").to_numpy(), minima)
        others = np.flatnonzero(root != np.arange(len(root)))
        keys = table.column("key").combine_chunks()
        return pa.RecordBatch.from_arrays([keys.take(pa.array(others)), keys.take(pa.array(root[others]))], ["a", "b"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        bands = held.column("band").to_numpy()
        cut = int(np.searchsorted(bands, bands[-1]))
        if cut:
            yield tied(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None:
        yield tied(held)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of how many shingles each two sets share, by products of narrow 0/1 matrices."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    use = often[column] > 1  # a shingle of one text is shared with none
    column = (np.cumsum(often > 1) - 1)[column[use]]
    row = row[use]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    if len(column):
        for low in range(0, int(column[-1]) + 1, WIDTH):
            a, b = np.searchsorted(column, [low, low + WIDTH])
            part = np.zeros((len(sets), WIDTH), np.float32)
            part[row[a:b], column[a:b] - low] = 1
            shared += part @ part.T
    return shared


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each member's connected part."""
    root = np.arange(len(linked))
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], len(linked)).min(axis=1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def verify(keys: list[bytes], blocks: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], across: bool) -> Iterator[tuple[bytes, bytes, int, int]]:
    """(text, root, links, linked documents) of one group or of two of its blocks.

    ``across``: only links between the two blocks count, the others are counted where a block meets itself.
    """
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
    sets, blocks, copies = [sets[i] for i in order], blocks[order], copies[order]
    sizes = np.array([len(s) for s in sets], np.float32)
    shared = shared_counts(sets)
    # In whole numbers: shared / union >= LEAST, whose tenths are whole.
    both = np.rint(shared).astype(np.int64)
    linked = 10 * both >= round(10 * LEAST) * (sizes[:, None].astype(np.int64) + sizes[None, :].astype(np.int64) - both)
    np.fill_diagonal(linked, False)
    root = _roots(linked)
    if across:
        linked &= blocks[:, None] != blocks[None, :]
    for i, at in enumerate(order):
        yield keys[at], keys[order[root[i]]], int(linked[i].sum()), int(linked[i] @ copies)


RESULT = pa.schema([("key", pa.binary()), ("root", pa.binary()), ("links", pa.int64()), ("partners", pa.int64())])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (group, low, high); one group or pair of blocks is held at a time."""
    def flush(held: list) -> list:
        unique = {row["key"]: row for row in held}
        rows = list(unique.values())
        return list(verify([r["key"] for r in rows], np.array([r["block"] for r in rows]), np.array([r["copies"] for r in rows]),
                           [np.frombuffer(r["shingles"], np.uint64) for r in rows], rows[0]["low"] != rows[0]["high"]))

    at, held, out = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            mark = (row["group"], row["low"], row["high"])
            if mark != at and held:
                out += flush(held)
                held = []
            at = mark
            held.append(row)
        if len(out) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), RESULT.types)], schema=RESULT)
            out = []
    if held:
        out += flush(held)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), RESULT.types)], schema=RESULT)


def signed_texts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, bands, minima) of every document of ``rows(doc_id, key, text)``, and the same of every text with its copies."""
    schema = rows.select("doc_id").schema.add("key", "binary").add("bands", ArrayType(LongType())).add("minima", "binary")
    signed = written(rows.mapInArrow(_signatures, schema), "ngram-bands")
    texts = signed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("minima").alias("minima"))
    return signed, written(texts, "ngram-texts")


def candidates(texts: DataFrame) -> DataFrame:
    """(a, b): ties of texts that share a band and look alike by all their minima."""
    each = texts.select("key", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    met = written(each.join(shared, "band"), "ngram-buckets")
    starred = met.where((F.col("n") > BUCKET) & (F.col("key") != F.col("first"))).select(F.col("key").alias("a"), F.col("first").alias("b"))
    # A text brings its minima once; its buckets leave from there.
    small = met.where(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_list("band").alias("bands"))
    known = small.join(texts.select("key", "minima"), "key").select(F.explode("bands").alias("band"), "key", "minima")
    dealt = known.repartition("band").sortWithinPartitions("band")
    return starred.unionAll(dealt.mapInArrow(_ties, "a binary, b binary")).distinct()


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) of every document, and (key, root, links, partners) of every text that has a candidate."""
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.col("text"))
    signed, texts = signed_texts(rows)
    member = written(components(candidates(texts)).withColumnRenamed("root", "group"), "ngram-groups")
    sized = member.groupBy("group").agg(F.count("*").alias("size")).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    one = member.withColumnRenamed("node", "key").join(sized, "group").join(texts.select("key", F.col("doc_id").alias("first_id"), "copies"), "key").drop("size")
    # One document of each text brings its words; a text's other copies do not match its id.
    found = rows.select("doc_id", "key", F.coalesce("text", F.lit("")).alias("text")).join(one, "key").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    found = found.select("key", "text", "group", "blocks", "copies")
    full = found.mapInArrow(_sets, "key binary, group binary, blocks int, copies long, shingles binary")
    full = full.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    full = full.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    dealt = full.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
    checked = dealt.select("group", "low", "high", "block", "key", "copies", "shingles").mapInArrow(_verified, "key binary, root binary, links long, partners long")
    checked = written(checked, "ngram-links")
    split = checked.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    summed = checked.groupBy("key").agg(F.min("root").alias("root"), F.sum("links").alias("links"), F.sum("partners").alias("partners"))
    if split:
        # Parts of a group that different tasks saw meet in the texts they share.
        joined = components(checked.select(F.col("key").alias("a"), F.col("root").alias("b")))
        summed = summed.drop("root").join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    linked = texts.select("key", "doc_id", "copies").join(summed, "key", "left").select(
        "key", "doc_id", "copies", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links"),
        (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("partners"))
    return signed.select("doc_id", "key"), written(linked, "ngram-classes")


def link(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), copy_id (smallest id with the same text),
    n_links (other texts at 0.8 or above), n_partners (other documents at 0.8 or above, copies included)."""
    each, texts = classes(docs)
    named = texts.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    known = texts.join(named, "root").select("key", "class_id", F.col("doc_id").alias("copy_id"), F.col("links").alias("n_links"), F.col("partners").alias("n_partners"))
    return each.join(known, "key").select("doc_id", "class_id", "copy_id", "n_links", "n_partners")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class does: the one with the smallest id."""
    _, texts = classes(docs)
    # Ids may repeat: among equal ids the smaller text key decides, among equal rows any one.
    first = texts.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    own, key, least = fresh(docs, "own"), fresh(docs, "key"), fresh(docs, "least")
    chosen = first.select(F.col("first.key").alias(key), F.col("first.doc_id").alias(least))
    rows = docs.withColumn(own, text_key(F.col("text")))
    return rows.join(chosen, (F.col(own) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(least))).dropDuplicates([own]).select(*docs.columns)


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, linked at a Jaccard index of 0.8 over five-word shingles."""
    return link(read(spark, folder, "documents"))
