"""Line dedup: winnowing over line hashes.

A window is the shortest run of lines that holds ``min_words`` words, from each line on and up to each
line; the least line hash in it is its fingerprint.  A run of lines that repeats anywhere holds the same
windows in both places, so at least one fingerprint of it is guaranteed to repeat.  Windows of repeated
fingerprints are joined by what their lines say; a window is a match of the first place that holds it, and
the matches around a fingerprint extend it both ways, window by window, as far as anything earlier agrees.
Together they cover exactly the runs of ``min_words`` or more words that occur at an earlier place, whichever
place that is; no pairs within a group of copies are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest, xxh64_intdigest

from tidewright.llm.common import columns_apart, in_batches, row_keys, stored, text_bytes

MIN_WORDS = 50

WINDOWS = T.StructType([
    T.StructField("_none", T.BooleanType()), T.StructField("__id", T.LongType()), T.StructField("__hash", T.LongType()),
    T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
    T.StructField("print", T.LongType()), T.StructField("leads", T.BooleanType()),
    T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
])


def least_in(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Position of the least of ``values[first:last + 1]`` for each window, the last one of ties."""
    best = np.empty(len(first), np.int64)
    table = np.arange(len(values))
    level = np.floor(np.log2(last - first + 1)).astype(np.int64)
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            a, b = table[: -(1 << (k - 1))], table[1 << (k - 1) :]
            table = np.where(values[a] < values[b], a, b)
        at = np.flatnonzero(level == k)
        a, b = table[first[at]], table[last[at] - (1 << k) + 1]
        best[at] = np.where(values[a] < values[b], a, b)
    return best


def windows_of(data: bytes, min_words: int) -> Iterator[tuple]:
    """(first, last, print, leads, h1, h2) of each window of a text; lines are counted from 0.

    Lines are compared without the white space around them; blank ones are passed over.  ``leads`` marks
    the first window of each selected position.
    """
    lines, at, words = [], [], []
    for i, line in enumerate(data.split(b"\n")):
        if n := len(line.split()):
            lines.append(line.strip())
            at.append(i)
            words.append(n)
    total = np.cumsum([0, *words])
    if total[-1] < min_words:
        return
    n = len(lines)
    ends = np.searchsorted(total, total[:-1] + min_words) - 1
    starts = np.searchsorted(total, total[1:] - min_words, "right") - 1
    forth = [(i, j) for i, j in enumerate(ends.tolist()) if j < n]
    back = [(i, j) for j, i in enumerate(starts.tolist()) if i >= 0]
    runs = np.array(sorted({*forth, *back}), np.int64)
    hashes = np.array([xxh64_intdigest(x) for x in lines], np.uint64).view(np.int64)
    seen = set()
    for (i, j), p in zip(runs.tolist(), least_in(hashes, runs[:, 0], runs[:, 1]).tolist(), strict=True):
        digest = xxh3_128_digest(lines[i] if i == j else b"\n".join(lines[i : j + 1]))
        h1, h2 = np.frombuffer(digest, ">i8").tolist()
        yield at[i], at[j], int(hashes[p]), p not in seen, h1, h2
        seen.add(p)


def windows(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    def work(rows: list[tuple]) -> Iterator[tuple]:
        for none, key, hashed, data in rows:
            for w in windows_of(data, min_words):
                yield none, key, hashed, *w

    keys = row_keys(docs, id_col)
    return in_batches(docs, [F.col(id_col).isNull(), keys["__id"], keys["__hash"], text_bytes(text_col)], work, WINDOWS)


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(__id, __hash, runs): for each document with such lines, the lines (first, last) that occur earlier.

    Earlier is by id (NULL last), then by a hash of the row, then by line.
    """
    found = stored(windows(docs, id_col, text_col, min_words), "windows")
    prints = found.where("leads").groupBy("print").count().where("count > 1").select("print")
    near = found.join(prints, "print", "left_semi")
    place = F.struct("_none", "__id", "__hash", "first")
    firsts = near.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count("*").alias("n")).where("n > 1")
    later = near.join(firsts, ["h1", "h2"]).where(place > F.col("place"))
    return later.groupBy("__id", "__hash").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def masks(runs: DataFrame) -> DataFrame:
    """(__id, __hash, _mask, _removed): a byte for each line up to the last one deleted, 1 where it goes."""
    schema = T.StructType([*runs.schema.fields[:2], T.StructField("_mask", T.BinaryType()), T.StructField("_removed", T.LongType())])

    def work(rows: list[tuple]) -> Iterator[tuple]:
        for key, hashed, spans in rows:
            mask = bytearray(max(s["last"] for s in spans) + 1)
            for s in spans:
                mask[s["first"] : s["last"] + 1] = b"\1" * (s["last"] - s["first"] + 1)
            yield key, hashed, bytes(mask), sum(mask)

    return in_batches(runs, [F.col(c) for c in runs.columns], work, schema)


def without(text: Column, mask: Column) -> Column:
    """``text`` without the lines that ``mask`` marks."""
    kept = F.filter(F.split(text, "\n", -1), lambda line, i: F.substring(mask, i + 1, F.lit(1)) != F.lit(b"\1"))
    return F.when(mask.isNull(), text).otherwise(F.array_join(kept, "\n"))


@columns_apart
def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the text, and ``lines_removed``.

    Of every line at least the first instance stays.  Blank lines within a deleted run go with it.  A
    NULL text stays NULL; texts of fewer than ``min_words`` words stay as they are.  Rows equal in every
    column are one document here and get the same text.  A document may be left with an empty text.
    """
    keyed = docs.withColumns(row_keys(docs, id_col))
    marked = keyed.join(masks(repeated_runs(docs, id_col, text_col, min_words)), ["__id", "__hash"], "left")
    names = [c for c in docs.columns if c != "lines_removed"]
    return marked.withColumn(text_col, without(F.col(text_col), F.col("_mask"))).select(
        *names, F.coalesce("_removed", F.lit(0)).alias("lines_removed"))
