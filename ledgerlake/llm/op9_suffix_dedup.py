"""Exact dedup of long passages by sorted suffix runs that are merged by common prefixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Suffixes are taken at anchors:
in every window of ``LENGTH`` bytes, the place whose ``GRAM`` bytes hash lowest. A window's anchor depends on its bytes
alone, so two equal windows have anchors at equal offsets, and every window belongs to exactly one anchor.

1. Texts are hashed; copies are one text from here on. Anchors are found text by text, and an anchor whose gram occurs
   once in the corpus is settled: none of its windows repeats.
2. The suffixes at the other anchors are sorted inside each task and sent as front-coded runs (bytes shared with the
   suffix before are not sent again), dealt by the hash of the gram, so that equal grams meet.
3. A receiving task merges its runs with a loser tree that knows how far each run's head agrees with the last winner:
   heads that agree less far lose without looking at a byte, known prefixes are never compared again. The merge yields
   the order and the common prefixes, whose breaks part the suffixes into groups of one gram.
4. Inside the groups every window of every anchor is looked up by the rolling hash of its ``LENGTH`` bytes at its offset,
   and the two halves of a match must agree in a second hash. Repeated windows go back as ranges, and a text's ranges
   are united.

Anchors of a gram that is found more than ``CROWD`` times do not meet in one task: their windows' hashes are counted by
Spark, with map-side sums, which gives the same answer for any number.

Defined cases: a null text counts as empty: nothing removed, hash of no bytes; texts under ``LENGTH`` bytes keep all;
of equal texts all copies go, none is the first; equal rows get equal results; an empty table gives an empty result;
extra columns are ignored by ``repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import read, text_key, written
from ledgerlake.llm.words import powers, prefix_sums, scatter

LENGTH, GRAM = 400, 32
CROWD = 20_000
ANCHORS_PER_TASK = 60_000
RUN_BYTES = 48 << 20
SALTS = 16


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes at every place."""
    sums = prefix_sums(data)
    _, down = powers(len(data) + 1)
    return scatter((sums[width:] - sums[:-width]) * down[: len(data) - width + 1])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window, hash): each window start in [first, last] has its lowest gram at place."""
    windows = len(data) - length + 1
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    hashes = _hashes(data, gram)
    span = length - gram + 1
    # Minimum of each span, from running minima inside blocks of one span's size, forwards and backwards.
    padded = np.full(-(-len(hashes) // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(hashes)] = hashes
    block = padded.reshape(-1, span)
    forward = np.minimum.accumulate(block, axis=1).ravel()
    backward = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[:windows], forward[span - 1:span - 1 + windows])
    # The leftmost place of the minimum: the next place at or after the window's start that holds this value.
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    change = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    value = least[change]
    group = np.searchsorted(ranked, value)
    group_end = np.searchsorted(ranked, value, "right")
    ends = np.r_[change[1:], windows]
    single = group_end - group == 1
    place, first, last, code = [order[group[single]]], [change[single]], [ends[single] - 1], [value[single]]
    for i in np.flatnonzero(~single):
        spots = order[group[i]:group_end[i]]
        starts = np.arange(change[i], ends[i])
        at = spots[np.searchsorted(spots, starts)]
        cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        place.append(at[cut])
        first.append(starts[cut])
        last.append(np.r_[starts[cut][1:], starts[-1] + 1] - 1)
        code.append(np.full(len(cut), value[i]))
    place, first, last, code = map(np.concatenate, (place, first, last, code))
    return place, first, last, code


def _bytes(column: pa.Array) -> Iterator[np.ndarray]:
    for value in column:
        yield np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.zeros(0, np.uint8)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [anchors(data) for data in _bytes(batch.column("body"))]
        lengths = np.r_[0, np.cumsum([len(f[0]) for f in found])].astype(np.int32)
        joined = [np.concatenate([f[i] for f in found]) for i in range(4)]
        lists = [pa.ListArray.from_arrays(pa.array(lengths), pa.array(v)) for v in (
            joined[3].view(np.int64), joined[0].astype(np.int32), joined[1].astype(np.int32), joined[2].astype(np.int32))]
        yield pa.RecordBatch.from_arrays([batch.column("key"), *lists], ["key", "grams", "places", "firsts", "lasts"])


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low, high = known, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_code(run: list[bytes]) -> tuple[np.ndarray, bytes]:
    """(bytes shared with the one before, the rest of each joined together with its length)."""
    shared = np.zeros(len(run), np.uint16)
    rest = []
    before = b""
    for i, item in enumerate(run):
        n = common_prefix(before, item)
        shared[i] = n
        rest.append(item[n:])
        before = item
    return shared, b"".join(rest)


class Run:
    """A front-coded run, read item by item; ``shared`` tells how far the head agrees with the item before."""

    def __init__(self, shared: np.ndarray, lengths: np.ndarray, rest: bytes):
        self._shared, self._lengths, self._rest = shared.tolist(), lengths.tolist(), rest
        self._at, self._from = -1, 0
        self.head, self.shared = b"", 0
        self.step()

    def step(self) -> None:
        self._at += 1
        if self._at == len(self._shared):
            self.head = None
            return
        n, length = self._shared[self._at], self._lengths[self._at]
        self.head = self.head[:n] + self._rest[self._from:self._from + length - n]
        self._from += length - n
        self.shared = n


def merged(runs: list[Run]) -> Iterator[tuple[int, int, bytes]]:
    """(run, bytes shared with the item before, item) in order, by a loser tree over the runs' heads.

    Every loser keeps the length that it shares with the item it lost to. Against the same winner, the head that shares
    more comes first; only equal lengths are compared, from that length on. Ties go to the earlier run.
    """
    many = 1
    while many < len(runs):
        many *= 2
    heads = [r.head for r in runs] + [None] * (many - len(runs))
    shared = [0] * many  # of each run's head with the last winner
    losers = [0] * many

    def beats(a: int, b: int) -> bool:
        """Does a's head come before b's? Updates the loser's shared length to that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        n = common_prefix(x, y, shared[a])
        if x[n:n + 1] < y[n:n + 1] or (n == len(x) == len(y) and a < b):
            shared[b] = n
            return True
        shared[a] = n
        return False

    def build(node: int) -> int:
        if node >= many:
            return node - many
        a, b = build(2 * node), build(2 * node + 1)
        if beats(a, b):
            losers[node] = b
            return a
        losers[node] = a
        return b

    top = build(1) if many > 1 else 0
    while heads[top] is not None:
        yield top, shared[top], heads[top]
        run = runs[top]
        run.step()
        # Its next head agrees with the item just given out as far as it agrees with its predecessor: they are the same.
        heads[top], shared[top] = run.head, run.shared
        node = (top + many) // 2
        while node:
            if not beats(top, losers[node]):
                top, losers[node] = losers[node], top
            node //= 2


def _runs(tasks: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Front-coded sorted runs: one row per receiving task and run, with what belongs to each suffix beside it."""
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            held.sort(key=lambda r: (r[0], r[1]))
            columns: list[list] = [[] for _ in range(8)]
            start = 0
            while start < len(held):
                end = start
                while end < len(held) and held[end][0] == held[start][0]:
                    end += 1
                part = held[start:end]
                suffixes = [r[1] for r in part]
                shared, rest = front_code(suffixes)
                lengths = np.array([len(s) for s in suffixes], np.uint16)
                before = [r[2] for r in part]
                places = np.array([r[4:] for r in part], np.int32)
                for column, value in zip(columns, (part[0][0], shared.tobytes(), lengths.tobytes(), rest, b"".join(before),
                                                   np.array([len(b) for b in before], np.uint16).tobytes(), b"".join(r[3] for r in part), places.tobytes())):
                    column.append(value)
                start = end
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], RUN.names)

        for batch in batches:
            keys, bodies = batch.column("key").to_pylist(), batch.column("body").to_pylist()
            for key, body, picks in zip(keys, bodies, batch.column("picks").to_pylist()):
                for p in picks:
                    place = p["place"]
                    suffix, before = body[place:place + LENGTH], body[max(0, place - LENGTH + GRAM):place]
                    held.append((p["gram"] % tasks, suffix, before, key, place, p["first"], p["last"]))
                    size += len(suffix) + len(before)
                if size > RUN_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return cut


RUN = pa.schema([("task", pa.int32()), ("shared", pa.binary()), ("lengths", pa.binary()), ("rest", pa.binary()),
                 ("before", pa.binary()), ("before_lengths", pa.binary()), ("keys", pa.binary()), ("places", pa.binary())])
RUN_TYPES = "task int, shared binary, lengths binary, rest binary, before binary, before_lengths binary, keys binary, places binary"
FOUND = pa.schema([("key", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])


def repeated_windows(contexts: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Which (anchor, offset) windows repeat within their group.

    ``contexts`` holds the bytes from length - gram before each anchor to length after it; offsets run from 0 (the
    window starts at the anchor) to length - gram; an anchor has the windows low..high.
    """
    before = length - gram
    out = np.zeros((len(contexts), before + 1), bool)
    if len(contexts) < 2:
        return out
    up, down = powers(contexts.shape[1] + 1)
    odd = np.uint64(0x2545F4914F6CDD1D)
    step = np.uint64(1)
    with np.errstate(over="ignore"):
        for _ in range(length):
            step = step * odd
    columns = np.ascontiguousarray(contexts.T)
    # Two hashes of the bytes before a window's start and before its end; both move on column by column, so that what
    # is held does not grow with the width.
    begin, end = (np.zeros((2, len(contexts)), np.uint64) for _ in range(2))

    def take(sums: np.ndarray, i: int) -> None:
        column = columns[i].astype(np.uint64) + np.uint64(1)
        sums[0] += column * up[i]
        sums[1] *= odd
        sums[1] += column

    for i in range(length):
        take(end, i)
    for start in range(before + 1):
        if start:
            take(begin, start - 1)
            take(end, start + length - 1)
        offset = before - start
        use = np.flatnonzero((low <= offset) & (offset <= high))
        if len(use) < 2:
            continue
        one = scatter((end[0, use] - begin[0, use]) * down[start]) + group[use].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        two = end[1, use] - begin[1, use] * step
        both = scatter(one ^ scatter(two))
        order = np.argsort(both, kind="stable")
        ranked = both[order]
        same = ranked[1:] == ranked[:-1]
        hit = np.r_[same, False] | np.r_[False, same]
        out[use[order[hit]], offset] = True
    return out


def _settle(rows: list[dict]) -> list[tuple[bytes, int, int]]:
    """Merge the runs of one task and return (text, first, last) of repeated window starts."""
    runs, tails = [], []
    for row in rows:
        lengths = np.frombuffer(row["lengths"], np.uint16)
        runs.append(Run(np.frombuffer(row["shared"], np.uint16), lengths, row["rest"]))
        tails.append((np.r_[0, np.cumsum(np.frombuffer(row["before_lengths"], np.uint16).astype(np.int64))], row["before"], row["keys"],
                      np.frombuffer(row["places"], np.int32).reshape(-1, 3)))
    found: list[tuple[bytes, int, int]] = []
    before = LENGTH - GRAM
    used = [0] * len(runs)
    contexts, groups, who, places = bytearray(), [], [], []
    number = 0

    def flush() -> None:
        if not who:
            return
        matrix = np.frombuffer(bytes(contexts), np.uint8).reshape(len(who), before + LENGTH)
        place = np.array(places)
        low, high = place[:, 0] - place[:, 2], place[:, 0] - place[:, 1]
        hit = repeated_windows(matrix, np.array(groups), low, high)
        padded = np.zeros((len(who), before + 3), bool)
        padded[:, 1:-1] = hit
        edge = padded[:, 1:] != padded[:, :-1]
        row, at = np.nonzero(edge)
        for i, start, end in zip(row[::2], at[::2], at[1::2]):
            found.append((who[i], int(place[i, 0] - end + 1), int(place[i, 0] - start)))
        contexts.clear()
        groups.clear()
        who.clear()
        places.clear()

    for run, shared, suffix in merged(runs):
        if shared < GRAM:
            number += 1
            if len(who) > 8_000:
                flush()
        ends, body, keys, spots = tails[run]
        i = used[run]
        used[run] += 1
        left = body[ends[i]:ends[i + 1]]
        contexts.extend(b"\0" * (before - len(left)) + left + suffix + b"\0" * (LENGTH - len(suffix)))
        groups.append(number)
        who.append(keys[16 * i:16 * i + 16])
        places.append(spots[i])
    flush()
    return found


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["task"] != at and held:
                yield from _as_found(_settle(held))
                held = []
            at = row["task"]
            held.append(row)
    if held:
        yield from _as_found(_settle(held))


def _as_found(rows: list) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(rows), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[start:start + 50_000]), FOUND.types)], schema=FOUND)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash of the window, text, start) of every window of crowded anchors."""
    for batch in batches:
        for key, body, picks in zip(batch.column("key"), _bytes(batch.column("body")), batch.column("picks").to_pylist()):
            starts = np.concatenate([np.arange(p["first"], p["last"] + 1) for p in picks])
            low, high = int(starts.min()), int(starts.max()) + LENGTH
            codes = _hashes(body[low:high], LENGTH)[starts - low]
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array([key.as_py()] * len(starts), pa.binary()), pa.array(starts.astype(np.int32))], ["window", "key", "first"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
            mark = np.zeros(len(body) + 1, np.int32)
            for span in spans:
                mark[span["first"]] += 1
                mark[span["last"] + LENGTH] -= 1
            gone = np.cumsum(mark)[:-1] > 0
            keep = np.frombuffer(body, np.uint8)[~gone].tobytes()
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
            rows.append((len(body) - len(keep), runs, hashlib.sha256(keep).hexdigest()))
        yield pa.RecordBatch.from_arrays([batch.column("key"), *[pa.array(c) for c in zip(*rows)]], ["key", "cut", "runs", "rest_sha256"])


def repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    named = docs.select("doc_id", text_key(F.col("text")).alias("key"), body.alias("body"))
    texts = named.groupBy("key").agg(F.first("body").alias("body"), F.count("*").alias("copies"))
    texts = written(texts.withColumns({"n_bytes": F.octet_length("body").cast("long"), "sha256": F.sha2("body", 256)}), "suffix-texts")
    long_ = texts.where(F.col("n_bytes") >= LENGTH)
    shape = "key binary, grams array<long>, places array<int>, firsts array<int>, lasts array<int>"
    found = written(long_.select("key", "body").mapInArrow(_anchor_rows, shape), "suffix-anchors")
    each = found.select("key", F.explode(F.arrays_zip("grams", "places", "firsts", "lasts")).alias("a")).select(
        "key", F.col("a.grams").alias("gram"), F.col("a.places").alias("place"), F.col("a.firsts").alias("first"), F.col("a.lasts").alias("last"))
    # A gram may stand in a third of all texts: its anchors are told their number over SALTS parts, not in one task.
    each = each.withColumn("salt", F.pmod(F.hash("key"), F.lit(SALTS)))
    parts = each.groupBy("gram", "salt").agg(F.count("*").alias("n"))
    often = parts.groupBy("gram").agg(F.sum("n").alias("n"), F.collect_set("salt").alias("salts")).where("n > 1")
    open_ = each.join(often.select("gram", "n", F.explode("salts").alias("salt")), ["gram", "salt"])
    pick = F.struct("gram", "place", "first", "last")
    picked = written(open_.groupBy("key", (F.col("n") > crowd).alias("crowded")).agg(F.collect_list(pick).alias("picks"), F.count("*").alias("n")), "suffix-picks")
    total = picked.where("not crowded").agg(F.sum("n")).first()[0] or 0
    tasks = int(total // ANCHORS_PER_TASK) + 1
    # One exchange of the bodies serves the runs, the crowded windows and the cutting; the rest is settled without them.
    bodies = long_.select("key", "body")
    runs = picked.where("not crowded").select("key", "picks").join(bodies, "key").select("key", "body", "picks").mapInArrow(_runs(tasks), RUN_TYPES)
    spans = runs.repartition(tasks, "task").sortWithinPartitions("task").mapInArrow(_settled, "key binary, first int, last int")
    windows = picked.where("crowded").select("key", "picks").join(bodies, "key").select("key", "body", "picks").mapInArrow(_windows, "window long, key binary, first int")
    # A crowded window may be as common as its gram, so it is salted in the same way.
    windows = windows.withColumn("salt", F.pmod(F.hash("key"), F.lit(SALTS)))
    common = windows.groupBy("window", "salt").agg(F.count("*").alias("n")).groupBy("window").agg(
        F.sum("n").alias("n"), F.collect_set("salt").alias("salts")).where("n > 1").select("window", F.explode("salts").alias("salt"))
    spans = spans.unionByName(windows.join(common, ["window", "salt"]).select("key", "first", F.col("first").alias("last")))
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    cut = bodies.join(spans, "key").mapInArrow(_removed, "key binary, cut long, runs long, rest_sha256 string")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    done = texts.select("key", "n_bytes", "sha256", "copies").join(cut, "key", "left").select(
        "key", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("rest_sha256", "sha256")).alias("kept_sha256"))
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(written(done, "suffix-results"), "key").drop("key")


def op9_suffix_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, less what repeats anywhere."""
    return repeats(read(spark, folder, "documents"))
