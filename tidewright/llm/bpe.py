"""Encoding and decoding with a word-end BPE vocabulary, by a minimal acyclic transducer of the frequent words.

Words are counted over the whole corpus.  The most frequent ones, with their ids as outputs, are compiled into an acyclic
automaton that shares prefixes and suffixes, ids standing on its arcs as far to the front as they can.  It is
written as one file to the shared folder, handed to the executors as a file of the job and memory-mapped there, so all workers of
a machine read the same pages.  The words of a batch walk the automaton together, a letter at a time; a word that it does not
hold is merged by the ranks of the vocabulary, pair by pair.  The result does not depend on which words are in it.
"""

from __future__ import annotations

import gc
import heapq
import json
import os
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewright.llm.common import stored, text_bytes
from tidewright.session import discard, scratch_path

#: Most words of the automaton, and the least count of one.
LEXICON_WORDS = 65_536
LEAST_COUNT = 2
#: Longer words are merged.
LEXICON_LETTERS = 32
#: Different words that a task counts, and different parts of texts whose ids it keeps, before it starts again.
COUNTED_WORDS = 200_000
KEPT_PARTS = 200_000
#: Words that walk the automaton together.
TOGETHER = 100_000
#: Characters of a text that are split at a time, and of texts that are encoded together.
SLICE = 1_000_000
TEXTS_TOGETHER = 2_000_000
#: Words of more letters are merged with a heap.
HEAP_FROM = 40
#: Words that are merged together.
MERGED_TOGETHER = 10_000

# How a vocabulary file of this kind splits and normalizes text, and white space as it sees it.
NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Parts of characters below this (Latin letters) need no library: they have no other composed form, and lower case
#: is that of each letter by itself.
PLAIN_BELOW = "\u0250"
#: White space to Python's ``split`` only.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def letters() -> dict[str, int]:
    """Byte that each letter of a byte-level vocabulary stands for: printable ones are themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain_split() -> re.Pattern:
    """``SPLIT`` for lower-case text of characters below ``PLAIN_BELOW``, with the classes written out."""
    of = lambda kind: "".join(re.escape(c) for c in map(chr, range(ord(PLAIN_BELOW))) if unicodedata.category(c)[0] == kind)
    classes = SPLIT.replace(r"[\p{L}]", f"[{of('L')}]").replace(r"[\p{N}]", f"[{of('N')}]").replace(r"\p{L}\p{N}", of("L") + of("N"))
    return re.compile(classes.replace(r"\s", r"\t-\r \x85\xa0"))


def words_of(text: str) -> list[str]:
    """Parts of a text between white space."""
    return [w for w in WHITE.split(text) if w] if any(c in text for c in SEPARATORS) else text.split()


def slices(text: str) -> Iterator[str]:
    """A text in parts that end at white space, as far as there is any."""
    at = 0
    while len(text) - at > SLICE:
        cut = WHITE.search(text, at + SLICE)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


class Vocabulary:
    """Ids and merges of a vocabulary file; ``ValueError`` for files of another kind."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        said = json.loads(tokenizer.to_str())
        model = said["model"]
        added = said["added_tokens"]
        plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
        fits = (
            said["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS}
            and said["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": PRE_TOKENIZERS}
            and said["decoder"] is None and model["type"] == "BPE" and model["end_of_word_suffix"]
            and all(model[k] == v for k, v in plain.items())
            and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
            and not any(WHITE.search(t["content"]) for t in added)
        )
        byte_of, suffix, vocab = letters(), model["end_of_word_suffix"], model["vocab"]
        if not fits or not all(c in vocab and c + suffix in vocab for c in byte_of):
            raise ValueError(f"{path} is not a word-end byte-level BPE of the kind that this operator reads")
        self.normalize = tokenizer.normalizer.normalize_str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.find = plain_split().findall
        self.byte_of = byte_of
        self.special = {t["content"]: t["id"] for t in added}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.inner = [vocab[c] for c in sorted(byte_of, key=byte_of.get)]
        self.final = [vocab[c + suffix] for c in sorted(byte_of, key=byte_of.get)]
        self.merges = {}
        self.letters_only = not any(s.isalpha() for s in self.special)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[a] << 32 | vocab[b], rank << 32 | vocab[a + b])
        most = max([*vocab.values(), *self.special.values()])
        pairs = sorted(self.merges.items())
        self.pairs = np.array([p for p, _ in pairs] + [NONE], np.int64)
        self.merged = np.array([m for _, m in pairs] + [NONE], np.int64)
        self.letter_ids = np.array([self.inner, self.final], np.int64)
        self.tokens = [""] * (most + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token

    def has_special(self, text: str) -> bool:
        return self.at_special is not None and self.at_special.search(text) is not None

    def pieces(self, part: str, special: bool = True) -> list[bytes | int]:
        """Words, as bytes, of a part of a text without white space; ids of special tokens in it, unless ``special`` says there are none."""
        plain = part.isascii() or max(part) < PLAIN_BELOW
        low = part.lower() if plain else part
        if plain and self.letters_only and low.isalpha():
            return [low.encode()]
        if special and self.has_special(part):
            inner = [p for p in self.at_special.split(part) if p]
            return [x for p in inner for x in ([self.special[p]] if p in self.special else self.pieces(p, False))]
        if plain:
            return [p.encode() for p in self.find(low)]
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in self.split(self.normalize(part))]

    def pieces_of(self, parts: Iterable[str], special: bool = True) -> dict[str, list[bytes | int]]:
        """``pieces`` of each of many parts, those of Latin letters without a call for each."""
        if not self.letters_only:
            return {p: self.pieces(p, special) for p in parts}
        return {p: [p.lower().encode()] if p.isascii() and p.isalpha() else self.pieces(p, special) for p in parts}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of least rank, the leftmost of equals, is merged until none is left."""
        inner, merges = self.inner, self.merges
        ids = [inner[b] for b in word]
        ids[-1] = self.final[word[-1]]
        if len(ids) > HEAP_FROM:
            return self.merge_long(ids)
        found = [merges.get(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while found and (least := min(found)) < NONE:
            i = found.index(least)
            ids[i : i + 2] = [least & LOW]
            del found[i]
            if i:
                found[i - 1] = merges.get(ids[i - 1] << 32 | ids[i], NONE)
            if i < len(found):
                found[i] = merges.get(ids[i] << 32 | ids[i + 1], NONE)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with the pairs in a heap."""
        merges, n = self.merges, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (p := a << 32 | b) in merges]
        heapq.heapify(heap)
        while heap:
            found, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = found & LOW, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (p := ids[left] << 32 | ids[right]) in merges:
                    # the rank leads; of one pair the leftmost comes first
                    heapq.heappush(heap, (merges[p], left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]


    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and new id of each pair; ``NONE`` where it is not merged."""
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.merged[at], NONE)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many words, little-endian: all of about a length do one merge each at a time."""
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        while order and len(words[order[-1]]) > HEAP_FROM:
            i = order.pop()
            out[i] = array("I", self.merge(words[i])).tobytes()
        for at in range(0, len(order), MERGED_TOGETHER):
            rows = np.array(order[at : at + MERGED_TOGETHER])
            some = [words[i] for i in rows]
            n = np.array([len(w) for w in some])
            width = int(n[-1])
            columns = np.arange(width)
            inside = columns < n[:, None]
            letters = np.zeros((len(some), width), np.uint8)
            letters[inside] = np.frombuffer(b"".join(some), np.uint8)
            ids = np.where(columns == n[:, None] - 1, self.letter_ids[1][letters], self.letter_ids[0][letters])
            found = np.full((len(some), width), NONE)
            found[:, :-1][inside[:, 1:]] = self.ranks(ids[:, :-1][inside[:, 1:]], ids[:, 1:][inside[:, 1:]])
            while len(rows):
                place = found.argmin(1)
                every = np.arange(len(rows))
                least = found[every, place]
                done = np.flatnonzero(least == NONE)
                flat = ids[done][np.arange(ids.shape[1]) < n[done][:, None]].astype("<u4").tobytes()
                stops = 4 * np.cumsum(n[done])
                for k, a, b in zip(rows[done].tolist(), (stops - 4 * n[done]).tolist(), stops.tolist()):
                    out[k] = flat[a:b]
                go = np.flatnonzero(least < NONE)
                if not len(go):
                    break
                rows, n, place, least, every = rows[go], n[go] - 1, place[go], least[go], np.arange(len(go))
                # the right one of the pair leaves its row
                rest = np.arange(ids.shape[1] - 1)
                moved = rest + (rest > place[:, None])
                gone = rest + (rest >= place[:, None])
                ids, found = np.take_along_axis(ids[go], moved, 1), np.take_along_axis(found[go], gone, 1)
                ids[every, place] = least & LOW
                left, right = np.flatnonzero(place > 0), np.flatnonzero(place + 1 < n)
                found[left, place[left] - 1] = self.ranks(ids[left, place[left] - 1], ids[left, place[left]])
                found[right, place[right]] = self.ranks(ids[right, place[right]], ids[right, place[right] + 1])
                last = np.flatnonzero(place + 1 >= n)
                found[last, place[last]] = NONE
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str | None) -> Vocabulary:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Vocabulary(path)


#: Above every rank, and the half of a merge that holds the new id.
NONE, LOW = 1 << 62, (1 << 32) - 1

Output = tuple[int, ...]


def common(a: Output, b: Output) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class Builder:
    """Minimal acyclic transducer of words given in ascending order, each with a tuple of ids."""

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.keys: list[int] = []
        self.targets: list[int] = []
        self.outs: list[int] = []
        self.finals: list[int] = []
        self.pool: dict[Output, int] = {(): 0}
        # states of the last word's path, still open: arcs {byte: [target, output]} and the output at its end, if any
        self.path: list[tuple[dict[int, list], list]] = [({}, [])]
        self.last = b""

    def output(self, ids: Output) -> int:
        return self.pool.setdefault(ids, len(self.pool))

    def freeze(self, state: tuple[dict[int, list], list]) -> int:
        """Number of the state, that of an equal one where there is any."""
        arcs, end = state
        key = (tuple((b, *arc) for b, arc in sorted(arcs.items())), tuple(end))
        if key not in self.register:
            number = self.register[key] = len(self.finals)
            self.finals.append(self.output(end[0]) if end else -1)
            for b, target, out in key[0]:
                self.keys.append(number << 8 | b)
                self.targets.append(target)
                self.outs.append(self.output(out))
        return self.register[key]

    def close(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            state = self.path.pop()
            self.path[-1][0][self.last[len(self.path) - 1]][0] = self.freeze(state)

    def add(self, word: bytes, ids: Output) -> None:
        shared = len(os.path.commonprefix([self.last, word]))
        self.close(shared)
        for i in range(shared):
            arc = self.path[i][0][word[i]]
            n = common(arc[1], ids)
            rest, ids = arc[1][n:], ids[n:]
            arc[1] = arc[1][:n]
            if rest:  # what the words so far have and this one has not moves on
                arcs, end = self.path[i + 1]
                for other in arcs.values():
                    other[1] = rest + other[1]
                end[:] = [rest + e for e in end]
        for i in range(shared, len(word)):
            self.path[i][0][word[i]] = [-1, ids if i == shared else ()]
            self.path.append(({}, []))
        self.path[-1][1][:] = [()]
        self.last = word

    def arrays(self) -> dict[str, np.ndarray]:
        self.close(0)
        start = self.freeze(self.path[0])
        pool = list(self.pool)
        return {
            "start": np.array([start], "<i8"), "keys": np.array([*self.keys, 1 << 62], "<i8"), "targets": np.array([*self.targets, -1], "<i4"),
            "outs": np.array([*self.outs, 0], "<i4"), "finals": np.array(self.finals, "<i4"),
            "lengths": np.array([len(p) for p in pool], "<i4"), "ids": np.array([i for p in pool for i in p], "<u4"),
        }


def compiled(words: Iterable[bytes], merge: object) -> bytes:
    """The automaton of ``words`` as one file: the length of its table of contents, the table, the arrays."""
    builder = Builder()
    for word in sorted(set(words)):
        builder.add(word, tuple(merge(word)))
    parts, contents, at = [], {}, 0
    for name, a in builder.arrays().items():
        contents[name] = (a.dtype.str, len(a), at)
        parts.append(a.tobytes() + bytes(-a.nbytes % 8))
        at += len(parts[-1])
    head = json.dumps(contents).encode()
    head += b" " * (-len(head) % 8)
    return b"".join([np.int64(len(head)).tobytes(), head, *parts])


class Lexicon:
    """The memory-mapped automaton."""

    def __init__(self, path: str) -> None:
        data = np.memmap(path, np.uint8, "r")
        n = int(data[:8].view("<i8")[0])
        for name, (kind, length, at) in json.loads(data[8 : 8 + n].tobytes()).items():
            begin = 8 + n + at
            setattr(self, name, data[begin : begin + length * np.dtype(kind).itemsize].view(kind))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths[:-1])]).astype(np.int64)

    def look_up(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word, little-endian; None for those that are not held.  All words take a step together."""
        sizes = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        places = np.cumsum(sizes) - sizes
        state = np.where((sizes > 0) & (sizes <= LEXICON_LETTERS), self.start[0], -1)
        steps = min(int(sizes.max(initial=0)), LEXICON_LETTERS)
        passed = np.zeros((len(words), steps + 1), np.int32)
        for step in range(steps):
            on = np.flatnonzero((state >= 0) & (sizes > step))
            key = state[on] << 8 | letters[places[on] + step]
            arc = np.searchsorted(self.keys, key)
            hit = self.keys[arc] == key
            state[on] = np.where(hit, self.targets[arc], -1)
            passed[on, step] = np.where(hit, self.outs[arc], 0)
        ends = np.where(state >= 0, self.finals[state], -1)
        held = ends >= 0
        passed[:, steps] = np.where(held, ends, 0)
        passed[~held] = 0
        counts = self.lengths[passed]
        total = counts.sum(1)
        used = passed[passed > 0]
        n = self.lengths[used].astype(np.int64)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids = self.ids[np.repeat(self.starts[used], n) + inside].tobytes()
        stops = np.cumsum(total) * 4
        return [ids[b - 4 * t : b] if h else None for h, t, b in zip(held.tolist(), total.tolist(), stops.tolist(), strict=True)]


@lru_cache(maxsize=4)
def lexicon(path: str) -> Lexicon:
    return Lexicon(path)


@contextmanager
def no_collector() -> Iterator[None]:
    """Without Python's cyclic collector, which walks the many small lists of a batch again and again; there are no cycles."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def word_counts(docs: DataFrame, text_col: str, tokenizer_path: str | None) -> DataFrame:
    """(word, n) of all words of all texts, added up in tasks before they are shuffled."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    out = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer_path)
        counts: Counter[str] = Counter()

        def told() -> pa.RecordBatch:
            words: Counter[bytes] = Counter()
            with no_collector():
                for part, pieces in known.pieces_of(counts).items():
                    n = counts[part]
                    for piece in pieces:
                        if isinstance(piece, bytes) and len(piece) <= LEXICON_LETTERS:
                            words[piece] += n
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())], schema=out)

        for batch in batches:
            for data in batch.column(0):
                for part in slices((data.as_py() or b"").decode("utf-8", "replace")):
                    counts.update(words_of(part))
                    if len(counts) > COUNTED_WORDS:
                        yield told()
        if counts:
            yield told()

    return docs.select(text_bytes(f"`{text_col}`").alias("text")).mapInArrow(work, schema).groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, text_col: str, tokenizer_path: str | None, most: int) -> list[bytes]:
    """At most ``most`` words: all that occur more often than some count, which leaves no choice among equals."""
    counts = stored(word_counts(docs, text_col, tokenizer_path).where(F.col("n") >= LEAST_COUNT), "words")
    level = F.floor(8 * F.log2("n"))  # some hundred levels whatever the corpus
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()
    held, least = 0, None
    for r in levels:
        held += r.words
        if held > most:
            break
        least = r.level
    words = [] if least is None else [bytes(r.word) for r in counts.where(level >= least).select("word").collect()]
    discard(counts)
    return words


def write_shared(spark: SparkSession, data: bytes, name: str) -> str:
    """A file in the shared folder, through the file system that it is on."""
    path = scratch_path(spark, name)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path


def build_lexicon(docs: DataFrame, text_col: str = "text", *, tokenizer_path: str | None = None, most: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of ``docs`` and hand the file to the executors; returns its name."""
    spark = docs.sparkSession
    data = compiled(frequent_words(docs, text_col, tokenizer_path, most), vocabulary(tokenizer_path).merge)
    path = write_shared(spark, data, "lexicon")
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def encoded_words(parts: set[str], known: Vocabulary, held: Lexicon, special: bool = True) -> dict[str, bytes]:
    """Ids of each part of a text: by the automaton, else by merging."""
    pieces = known.pieces_of(parts, special)
    words = list({w for ps in pieces.values() for w in ps if isinstance(w, bytes)})
    ids: dict[bytes | int, bytes] = {s: array("I", [s]).tobytes() for s in known.special.values()}
    for at in range(0, len(words), TOGETHER):
        some = words[at : at + TOGETHER]
        found = held.look_up(some)
        ids |= {w: f for w, f in zip(some, found, strict=True) if f is not None}
        unseen = [w for w, f in zip(some, found, strict=True) if f is None]
        ids |= zip(unseen, known.merge_all(unseen), strict=True)
    return {p: ids[ps[0]] if len(ps) == 1 else b"".join(map(ids.__getitem__, ps)) for p, ps in pieces.items()}


def together(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose second column holds about ``size`` bytes, single longer values apart."""
    lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encode(
    docs: DataFrame, lexicon_name: str, id_col: str = "doc_id", text_col: str = "text", *, tokenizer_path: str | None = None,
) -> DataFrame:
    """(id, ids) of every row: ids as little-endian unsigned 32-bit integers.

    They are those of the tokenizers library without added special tokens; special tokens that stand in a text count as such.
    A NULL or empty text has none.  Repeated rows each get theirs.  Only the two named columns are read.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.BinaryType())])
    out = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = vocabulary(tokenizer_path), lexicon(SparkFiles.get(lexicon_name))
        table: dict[str, bytes] = {}
        for whole in batches:
            for batch in together(whole, TEXTS_TOGETHER):
                texts = [t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
                special = any(map(known.has_special, texts))
                # split once: the same strings, whose hashes Python keeps, are looked up again below
                split = [[words_of(part) for part in slices(text)] for text in texts]
                del texts
                parts = set().union(*(words for text in split for words in text))
                if len(table) > KEPT_PARTS:
                    table.clear()
                with no_collector():
                    table |= encoded_words(parts.difference(table), known, held, special)
                ids = [b"".join(b"".join(map(table.__getitem__, words)) for words in text) for text in split]
                del split, parts
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], schema=out)

    return docs.select(F.col(f"`{id_col}`"), text_bytes(f"`{text_col}`").alias("text_bytes")).mapInArrow(work, schema)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", *, tokenizer_path: str | None = None) -> DataFrame:
    """(id, ids, text) of every row: its tokens with a space between, special ones included, as the library joins them.

    NULL ids are none; an id that is not in the vocabulary has no token and is left out.
    """
    schema = T.StructType([encoded.schema[id_col], T.StructField("ids", T.BinaryType()), T.StructField("text", T.StringType())])
    out = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(tokenizer_path).tokens
        spelled, known = pa.array(tokens, pa.string()), np.array([*map(bool, tokens), False])
        for whole in batches:
            for batch in together(whole, TEXTS_TOGETHER):
                data = [(d.as_py() or b"") for d in batch.column(1)]
                ids = np.frombuffer(b"".join(data), "<u4")
                told = known[np.minimum(ids, len(tokens))]
                ends = np.cumsum([0, *(len(d) // 4 for d in data)])
                # where each text begins among the ids that have a token
                starts = np.concatenate([[0], np.cumsum(told)])[ends]
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), spelled.take(pa.array(ids[told])))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pc.binary_join(lists, " ")], schema=out)

    return encoded.select(F.col(f"`{id_col}`"), F.col(f"`{ids_col}`")).mapInArrow(work, schema)
