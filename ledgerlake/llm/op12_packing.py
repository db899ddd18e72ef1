"""Best-fit packing: a histogram of lengths is planned, then documents take the planned slots.

1. Documents become token ids and are cut into pieces no longer than a sequence. Words repeat, so the tokenizer sees
   each distinct word of a piece of text once; white space separates words for it, which keeps its ids the same.
   While a task writes its pieces it numbers them within their length.
2. The plan works on counts, one for each possible length: longest first, pieces go to the sequences with the least
   room that still holds them, as many of one length at once as fit. Sequences with the same room are one range, so
   the plan's size hangs on the sequence length alone. With C tokens a sequence: every length splits at most two
   ranges and opens two, and a range takes up fewer than sqrt(2 C) different lengths, hence at most
   4 C sqrt(2 C) segments (524288 for 2048 tokens, 20 MB; some thousands in practice).
3. A piece's rank within its length is its task's first rank plus its number in the task. Ranks meet the plan's
   segments of that length by binary search; a segment says which sequence and which place a rank has.

Defined cases: a null or empty text is the closing id alone; a null key passes through; equal rows are packed one by
one; an empty table gives an empty result; extra columns do not matter, whatever their names.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import read, written
from ledgerlake.llm.words import IS_SPACE, LOWER

CAPACITY = 2048
CLOSING_ID = 0
#: Bytes of text handled at once; memory follows this or the longest text.
CHUNK_BYTES = 4 << 20
#: Words a worker remembers the ids of (some 200 bytes each); past that it starts anew.
REMEMBERED = 500_000
#: Words given to the tokenizer at once.
TOGETHER = 2_000

_byte = np.arange(256)
_ALNUM = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122))
_STOP = (_byte == 44) | (_byte == 46)


# --- token ids ------------------------------------------------------------------------------------


class _Encoder:
    """Token ids of texts, word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _ids(self, words: list[bytes]) -> list[bytes]:
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, words
        for at in range(0, len(fresh), TOGETHER):
            some = [w.decode() for w in fresh[at:at + TOGETHER]]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            # An id belongs to the word in which its first character stands.
            begin = np.cumsum([0, *[len(w) + 1 for w in some]])
            of_word = np.searchsorted(begin, np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0], "right")
            cuts = np.searchsorted(of_word, np.arange(1, len(some) + 2)) * 4
            ids = np.array(found.ids, "<u4").tobytes()
            for word, a, b in zip(fresh[at:at + TOGETHER], cuts[:-1].tolist(), cuts[1:].tolist()):
                self.known[word] = ids[a:b]
        return [self.known[w] for w in words]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start (one more entry for the end).

        Words end at ASCII white space. A full stop or comma between an ASCII letter or digit and white space is a
        word of its own: the tokenizer never joins it with what stands before.
        """
        space = IS_SPACE[data]
        first = ~space
        first[1:] &= space[:-1]
        starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[starts] = ~space[starts]
        ends = np.append(space[1:], True)
        ends[offsets[1:][offsets[1:] > 0] - 1] = True
        mark = np.flatnonzero(_STOP[data] & ends & ~first)
        first[mark[_ALNUM[data[mark - 1]]]] = True
        begin = np.flatnonzero(first)
        owner = np.searchsorted(offsets, begin, "right") - 1
        gaps = np.flatnonzero(space)
        edges = np.append(begin - np.searchsorted(gaps, begin), len(data) - len(gaps))
        # The tokenizer takes capitals as small letters; only its marks, which hold a "<", are told apart by case.
        letters = data if (data == 60).any() else LOWER[data]
        words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(letters[~space])])
        distinct = words.dictionary_encode()
        ids = self._ids(_slices(distinct.dictionary))
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.array([len(i) for i in ids], np.int64) // 4
        place = np.append(0, np.cumsum(size))
        which = distinct.indices.to_numpy(zero_copy_only=False)
        count = size[which]
        end = np.cumsum(count)
        total = int(end[-1]) if len(end) else 0
        out = flat[np.repeat(place[which] - (end - count), count) + np.arange(total)] if total else flat[:0]
        of_text = np.bincount(owner, weights=count, minlength=len(offsets) - 1).astype(np.int64)
        return out, np.append(0, np.cumsum(of_text))


def _slices(values: pa.LargeBinaryArray) -> list[bytes]:
    _, where, body = values.buffers()
    cuts = np.frombuffer(where, np.int64)[values.offset:values.offset + len(values) + 1].tolist()
    whole = body.to_pybytes() if body is not None else b""
    return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of a string column of about CHUNK_BYTES."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = min(max(int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1, at + 1), len(column))
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def _cut(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for at, end, data, offsets in _texts(batch.column(1)):
                ids, begin = encoder.encode(data, offsets)
                size = np.diff(begin) + 1
                closed = np.full(int(size.sum()), CLOSING_ID, "<u4")
                edge = np.append(0, np.cumsum(size))
                inside = np.ones(len(closed), bool)
                inside[edge[1:] - 1] = False
                closed[inside] = ids
                pieces = -(-size // capacity)
                doc = np.repeat(np.arange(end - at), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                # Pieces stand one after the other, so their bytes are one buffer.
                where = np.append(0, np.cumsum(length)) * 4
                packed = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(where.astype(np.int64)), pa.py_buffer(closed)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), packed.cast(pa.binary()) if where[-1] < 1 << 31 else packed],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return cut


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids (binary, little-endian 32-bit) of every document cut to ``capacity``."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, capacity), schema)


# --- the plan -------------------------------------------------------------------------------------


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Segments (length, first rank, pieces per sequence, first sequence, place), best fit over counts.

    Rank r of a segment goes to sequence ``first sequence + (r - first rank) // per``, at
    ``place + (r - first rank) % per * length``; a segment ends where the next one of its length begins.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    segments, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for room in sorted(r for r in rooms if r >= length):
            per = room // length
            ranges = rooms.pop(room)
            while ranges and left:
                first, many = ranges.pop()
                full = min(many, left // per)
                rest = min(left - full * per, per - 1) if full < many else 0
                for seqs, each in ((full, per), (1 if rest else 0, rest)):
                    if seqs:
                        segments.append((length, rank, each, first, capacity - room))
                        rooms.setdefault(room - each * length, []).append((first, seqs))
                        first, many, rank, left = first + seqs, many - seqs, rank + seqs * each, left - seqs * each
                if many:
                    ranges.append((first, many))
            if ranges:
                rooms.setdefault(room, []).extend(ranges)
            if not left:
                break
        per = capacity // length
        for seqs, each in ((left // per, per), (1 if left % per else 0, left % per)):
            if seqs:
                segments.append((length, rank, each, opened, 0))
                rooms.setdefault(capacity - each * length, []).append((opened, seqs))
                opened, rank, left = opened + seqs, rank + seqs * each, left - seqs * each
    return segments


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the task's number and each row's number among the task's rows of its length."""
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), np.zeros(1, np.int64)
    for batch in batches:
        length = batch.column(batch.schema.get_field_index("length")).to_numpy()
        if not len(length):
            continue
        if int(length.max()) >= len(seen):
            seen = np.append(seen, np.zeros(int(length.max()) + 1 - len(seen), np.int64))
        order = np.argsort(length, kind="stable")
        kinds, first, many = np.unique(length[order], return_index=True, return_counts=True)
        within = np.empty(len(length), np.int64)
        within[order] = np.arange(len(length)) - np.repeat(first, many) + np.repeat(seen[kinds], many)
        seen[kinds] += many
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(within)],
                                         names=[*batch.schema.names, "part", "within"])


def _slots(segments: Sequence[tuple[int, int, int, int, int]]):
    length, first, per, sequence, place = (np.array(c, np.int64) for c in zip(*sorted(segments)))
    edges = np.searchsorted(length, np.arange(int(length.max()) + 2))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def column(name, batch=batch):
                return batch.column(batch.schema.get_field_index(name))
            mine, rank = column("length").to_numpy(), column("rank").to_numpy()
            at = np.empty(len(mine), np.int64)
            order = np.argsort(mine, kind="stable")
            kinds, starts = np.unique(mine[order], return_index=True)
            for kind, rows in zip(kinds, np.split(order, starts[1:])):
                low, high = edges[kind], edges[kind + 1]
                at[rows] = low + np.searchsorted(first[low:high], rank[rows], "right") - 1
            step = rank - first[at]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[column(n) for n in names], pa.array(sequence[at] + step // per[at]), pa.array(place[at] + step % per[at] * mine)],
                names=[*names, "sequence_id", "offset"])

    return take


def place(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` (1 to ``capacity``). ``rows`` is computed once."""
    extra = [T.StructField("part", T.IntegerType()), T.StructField("within", T.LongType())]
    stored = written(rows.mapInArrow(_numbered, T.StructType([*rows.schema.fields, *extra])), "pack-pieces")
    dealt = written(stored.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in dealt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    fields = [*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    if not histogram:
        return rows.sparkSession.createDataFrame([], T.StructType(fields))
    if min(histogram) < 1 or max(histogram) > capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    segments = plan(histogram, capacity)
    if len(segments) > 4 * capacity * math.sqrt(2 * capacity):
        raise AssertionError("the plan is larger than its bound")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    # Both sides grow with the input: the counts are not to be broadcast, however small they look at first.
    ranked = stored.join(starts.hint("merge"), ["length", "part"]).select(*rows.columns, (F.col("_start") + F.col("within")).alias("rank"))
    return ranked.mapInArrow(_slots(segments), T.StructType(fields))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, length and ids of every packed sequence; one holds ``capacity`` ids at most."""
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"), F.sum("length").alias("length"))
    joined = F.aggregate("_parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their ids and places."""
    return place(pieces(docs, tokenizer, capacity), capacity)


def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens; a checksum stands for the ids."""
    import public_tokenizers

    cut = pieces(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return place(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
