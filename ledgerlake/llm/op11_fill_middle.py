"""Fill-in-middle transformation: a text is cut twice and its middle goes to the end, between marks.

Offsets live in two worlds, code points and UTF-8 bytes. They differ only behind characters of several bytes, so a
sparse index holds just those: where each one starts and how many bytes it has too many. A binary search in it turns
a byte cut into code points and back; stretches of ASCII need arithmetic only and texts without such characters have
no entry at all.

Cuts fall between units: words with the white space before them (``unit="word"``), found in bytes and reported in
code points, or single code points (``unit="char"``), drawn in code points and made in bytes. They are drawn from a
hash of the seed and the document's key, so every run makes the same ones.

Defined cases: a null or empty text is plain; a text that holds a mark is plain, so that :func:`restore` always finds
its way back; a null key draws as an empty one, a text key as its text; equal rows give equal results; an empty table
gives an empty one; extra columns pass through, those named like a result (``n``, ``form``, ``prefix_chars``,
``middle_chars``, ``output``) are replaced. Texts of any length are taken whole; memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import fresh, read
from ledgerlake.llm.words import IS_SPACE

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

SEED = "42"
#: Of 100 texts so many are cut; of 100 of these so many put the suffix first.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80
CHUNK_BYTES = 1 << 20


class Exceptions:
    """Sparse index of the characters of several bytes in ``data``: their byte offsets and excess bytes so far."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        self.excess = np.append(0, np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)))
        self.at_char = self.at - self.excess[:-1]

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte offsets that lie between characters."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before code point offsets."""
        return cuts + self.excess[np.searchsorted(self.at_char, cuts)]


def _unit_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which words end; white space at the end of a text is a unit of its own."""
    space = IS_SPACE[data]
    ends = ~space
    ends[:-1] &= space[1:]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    ends[last] = True
    # The last byte of a word that another text follows ends it too; it is among ``last`` already.
    return np.flatnonzero(ends) + 1


def _with_marks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a mark?"""
    held = np.zeros(len(offsets) - 1, bool)
    opens = np.flatnonzero(data[:-2] == ord("<")) if len(data) > 2 else np.zeros(0, np.int64)
    opens = opens[(data[opens + 2] == ord(">")) & np.isin(data[opens + 1], [ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)])]
    owner = np.searchsorted(offsets, opens, "right") - 1
    held[owner[opens + 3 <= offsets[owner + 1]]] = True
    return held


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = min(max(int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1, at + 1), len(texts))
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def _transform(text: str, draws: list[str], unit: str, cut_percent: int, suffix_first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def column(name, batch=batch):
                return batch.column(batch.schema.get_field_index(name))
            drawn = [column(d).to_numpy() for d in draws]
            kept = [n for n in batch.schema.names if n not in draws]
            for at, end, data, offsets in _pieces(column(text)):
                h1, h2, h3, h4 = (d[at:end] for d in drawn)
                index = Exceptions(data)
                begin, begin_chars = offsets[:-1], index.chars(offsets[:-1])
                if unit == "word":
                    ends = _unit_ends(data, offsets)
                    before = np.searchsorted(ends, offsets, "right")
                    n = np.diff(before)
                else:
                    n = index.chars(offsets[1:]) - begin_chars
                cuts = np.sort([h1 % (n + 1), h2 % (n + 1)], axis=0)
                if unit == "word":
                    spots = np.append(ends, 0)
                    a, b = (np.where(c > 0, spots[np.maximum(before[:-1] + c - 1, 0)], begin) for c in cuts)
                    a_chars, b_chars = index.chars(a), index.chars(b)
                else:
                    a_chars, b_chars = (begin_chars + c for c in cuts)
                    a, b = index.bytes(a_chars), index.bytes(b_chars)
                plain = (offsets[1:] == begin) | (h3 % 100 >= cut_percent) | _with_marks(data, offsets)
                form = np.where(plain, PLAIN, np.where(h4 % 100 < suffix_first, SPM, PSM))
                raw, out = data.tobytes(), []
                for i, kind in enumerate(form.tolist()):
                    low, x, y, high = int(begin[i]), int(a[i]), int(b[i]), int(offsets[i + 1])
                    if kind == PLAIN:
                        out.append(raw[low:high])
                    elif kind == PSM:
                        out.append(b"".join((PREFIX.encode(), raw[low:x], SUFFIX.encode(), raw[y:high], MIDDLE.encode(), raw[x:y])))
                    else:
                        out.append(b"".join((SUFFIX.encode(), raw[y:high], PREFIX.encode(), raw[low:x], MIDDLE.encode(), raw[x:y])))
                made = [pa.array(n.astype(np.int64)), pa.array(form.tolist(), pa.string()),
                        pa.array(a_chars - begin_chars, pa.int64(), mask=plain), pa.array(b_chars - a_chars, pa.int64(), mask=plain),
                        pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*[column(c).slice(at, end - at) for c in kept], *made], names=[*kept, *RESULTS])

    return run


RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(key: Column, seed: str) -> list[Column]:
    """Four whole numbers below 2^32 from a key: the first groups of eight hex digits of a hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, unit: str = "word",
              cut_percent: int = CUT_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """Add n (units), form, prefix_chars, middle_chars (null if plain) and output to every row. No shuffle."""
    if unit not in ("word", "char"):
        raise ValueError(f"unknown unit {unit}")
    docs = docs.drop(*RESULTS)
    names = []
    for i, column in enumerate(draws(F.col(key), seed)):
        names.append(fresh(docs, f"h{i + 1}"))
        docs = docs.withColumn(names[-1], column)
    made = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    schema = T.StructType([f for f in docs.schema.fields if f.name not in names] + made)
    return docs.mapInArrow(_transform(text, names, unit, cut_percent, suffix_first), schema)


def restore(output: Column, form: Column) -> Column:
    """The exact text, from the transformed one and its form alone: each mark stands in it once."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    # The output opens with one mark; the other one stands between the two outer parts.
    cut = F.when(form == PSM, F.locate(SUFFIX, head)).otherwise(F.locate(PREFIX, head))
    left, right = F.substring(head, F.lit(4), cut - 4), F.substring(head, cut + 3, F.length(head))
    return F.when(form == PLAIN, output).when(form == PSM, F.concat(left, middle, right)).otherwise(F.concat(right, middle, left))


def op11_exception_index(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; hashes stand for the transformed and the restored texts."""
    made = transform(read(spark, folder, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


#: The same in DuckDB, on lists of matched units.
ORACLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, [('0x' || substr(h, 8 * i + 1, 8))::UBIGINT::BIGINT FOR i IN [0, 1, 2, 3]] AS r FROM units),
cut AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
         WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
