"""Best-fit packing of token sequences with matching of large items.

Items over a third of the capacity fit at most twice into a sequence; they are matched
greedily, the largest with the largest that fits.  Smaller ones then go, largest first,
to the sequence with the smallest gap that holds them.  Both steps work on the counts of
each length, so what is planned on the driver is bounded by the capacity (2048 lengths)
whatever the corpus; documents meet the plan by their number within their length.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import in_batches, numbered, stored, text_bytes

CAPACITY = 2048
#: How the byte-level pre-tokenizer splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a worker keeps; when full it starts again.
CACHED_WORDS = 500_000

#: A group of equal sequences: how many, and the (length, items) in each.
Group = tuple[int, tuple[tuple[int, int], ...]]


#: Words whose characters are all below this (Latin letters) are split alike by either library.
PLAIN_BELOW = "\u0250"


def byte_of_letter() -> dict[str, int]:
    """Byte that each letter of a byte-level vocabulary stands for: printable ones are themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of a text as little-endian bytes, word by word from a cache.

    The pre-tokenizer splits before each single space between other characters, so the ids of a text are those
    of its parts between spaces; texts with a space beside other white space are encoded whole.  New words of
    Latin letters are merged by tiktoken from the vocabulary of the file, which is several times faster; it is
    used only if the ids of the file follow the order of its merges, so that both give the same ids.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes | None] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        model = json.loads(self.tokenizer.to_str())["model"]
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.special}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        letters = byte_of_letter()
        self.fast = None
        if merged == list(range(256, 256 + len(merged))):
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
            self.fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, part: str) -> None:
        """Cache the ids of a part; None where it cannot stand alone."""
        if len(part) > 1 and part[1].isspace() or part[-1].isspace() or any(s in part for s in self.special):
            self.cache[part] = None
        else:
            encode = self.fast if self.fast and max(part) < PLAIN_BELOW else self.ids
            self.cache[part] = array("I", encode(part)).tobytes()

    def __call__(self, text: str) -> bytes:
        first, *words = text.split(" ")
        parts = [first, *map(" ".__add__, words)] if first else list(map(" ".__add__, words))
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        for part in set(parts).difference(self.cache):
            self.learn(part)
        found = list(map(self.cache.__getitem__, parts))
        return np.array(self.ids(text), "<u4").tobytes() if None in found else b"".join(found)


@lru_cache(maxsize=2)
def word_tokenizer(path: str | None) -> WordTokenizer:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return WordTokenizer(path)


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer_path: str | None = None,
    capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document: its ids, then ``end_id``.

    Documents over the capacity are cut so that only the first piece is shorter than it.
    """
    schema = T.StructType([
        docs.schema[id_col], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))
    last = np.array([end_id], "<u4").tobytes()

    def work(rows: list[tuple]) -> Iterator[tuple]:
        encode = word_tokenizer(tokenizer_path)
        for key, data in rows:
            ids = encode(data.decode("utf-8", "replace")) + last
            n = len(ids) // 4
            stops = range((n - 1) % capacity + 1, n + 1, capacity)
            for piece, (start, stop) in enumerate(zip([0, *stops], stops, strict=False)):
                part = ids[4 * start : 4 * stop]
                row = key, piece, start, stop - start, zlib.crc32(part)
                yield (*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row

    return in_batches(docs, [F.col(id_col), text_bytes(text_col)], work, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups of equal sequences that hold ``counts`` items of each length."""
    gaps: dict[int, list[Group]] = defaultdict(list)

    def add(bins: int, items: tuple[tuple[int, int], ...]) -> None:
        if bins:
            gaps[capacity - sum(size * n for size, n in items)].append((bins, items))

    left = {size: n for size, n in counts.items() if 3 * size > capacity and n}
    order = sorted(left)
    while order:
        size = order[-1]
        at = bisect_right(order, capacity - size) - 1
        if at >= 0 and order[at] == size and left[size] == 1:
            at -= 1
        if at < 0:
            add(left[size], ((size, 1),))
            left[size] = 0
        elif order[at] == size:
            add(left[size] // 2, ((size, 2),))
            left[size] %= 2
        else:
            mate = order[at]
            both = min(left[size], left[mate])
            add(both, ((size, 1), (mate, 1)))
            left[size] -= both
            left[mate] -= both
            if not left[mate]:
                order.pop(at)
        if not left[size]:
            order.pop()

    known = sorted(gaps)
    for size in sorted((s for s, n in counts.items() if 3 * s <= capacity and n), reverse=True):
        n = counts[size]
        at = bisect_right(known, size - 1)
        while n:
            gap = known[at] if at < len(known) else capacity
            fit = gap // size
            bins, items = gaps[gap].pop() if at < len(known) else (-(-n // fit), ())
            full = min(bins, n // fit)
            n -= full * fit
            rest = bins - full
            for more, each in ((full, fit), (1, n) if rest and n else (0, 0)):
                if more:
                    add(more, (*items, (size, each)))
                    if (now := gap - size * each) not in known:
                        insort(known, now)
            if rest and n:
                rest, n = rest - 1, 0
            add(rest, items)
            at = bisect_right(known, size - 1)
            while at < len(known) and not gaps[known[at]]:
                known.pop(at)
    return [g for groups in gaps.values() for g in groups]


def slots(groups: list[Group]) -> dict[str, np.ndarray]:
    """Where the numbers of each length go: one entry for each group and length in it."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for bins, items in groups:
        offset = 0
        for size, each in items:
            rows.append((size, used[size], each, sequence, offset))
            used[size] += bins * each
            offset += size * each
        sequence += bins
    names = ("size", "first", "each", "sequence", "offset")
    table = np.array(sorted(rows), np.int64).reshape(-1, len(names))
    return dict(zip(names, table.T, strict=True))


def pack(cut: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (a stored table as of ``pieces``) with ``sequence_id`` and gapless ``offset``.

    Every row is placed, repeated ones each; NULL ids are kept.  An empty table gives no rows.
    """
    counts = {r[0]: r[1] for r in cut.groupBy("length").agg(F.count("*")).collect()}  # one row a length
    at = slots(plan(counts, capacity))
    keys = (at["size"] << 48) + at["first"]

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, number: pd.Series) -> pd.DataFrame:
        k = np.searchsorted(keys, (size.to_numpy() << 48) + number.to_numpy(), "right") - 1
        inside = number.to_numpy() - at["first"][k]
        return pd.DataFrame({
            "sequence_id": at["sequence"][k] + inside // at["each"][k],
            "offset": at["offset"][k] + inside % at["each"][k] * size.to_numpy(),
        })

    ranked = numbered(cut, ["length"], [id_col, "piece", "ids_crc32"], rows=sum(counts.values()))
    return ranked.withColumn("_at", place("length", "rank")).select(*cut.columns, "_at.*")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """Pieces of all documents with their sequence; a NULL or empty text is its end id alone."""
    capacity = options.get("capacity", CAPACITY)
    return pack(stored(pieces(docs, id_col, text_col, **options), "pieces"), id_col, capacity)
