import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.util import docs_of, odd_docs
from tidewright.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "a \n b", "one two\nthree  four", "It's 12 o'clock, isn't it?", "né à ü  x  y", "a​ b",
    "<|endoftext|> a <|endoftext|>b", "tab\t x", "x 　y", "日本 語 text", "a\x1c b", "\n", "\n a", " \n", "end\n", "é ́ x",
]


@pytest.mark.parametrize("text", TEXTS)
def test_word_tokenizer(tokenizer, text):
    got = np.frombuffer(packing.word_tokenizer(None)(text), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_tokenizer_on_documents(spark, tokenizer):
    for (text,) in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        got = np.frombuffer(packing.word_tokenizer(None)(text), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def check_plan(counts, capacity):
    groups = packing.plan(counts, capacity)
    held = Counter()
    for bins, items in groups:
        assert bins > 0 and sum(s * n for s, n in items) <= capacity
        for s, n in items:
            held[s] += bins * n
    assert held == Counter({s: n for s, n in counts.items() if n})
    return sum(b for b, _ in groups)


def best_fit_decreasing(counts, capacity):
    gaps = []
    for size in sorted(Counter(counts).elements(), reverse=True):
        at = min((i for i, g in enumerate(gaps) if g >= size), key=lambda i: gaps[i], default=None)
        if at is None:
            gaps.append(capacity - size)
        else:
            gaps[at] -= size
    return len(gaps)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_as_good_as_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100])
    counts = Counter(min(capacity, max(1, int(rng.expovariate(3 / capacity)))) for _ in range(rng.randrange(400)))
    assert check_plan(counts, capacity) <= best_fit_decreasing(counts, capacity)


def test_plan_cases():
    assert packing.plan({}) == []
    assert check_plan({2048: 3}, 2048) == 3
    assert check_plan({1024: 5}, 2048) == 3
    assert check_plan({683: 3}, 2048) == 2
    assert check_plan({1: 10**12}, 2048) == -(-(10**12) // 2048)
    assert check_plan({1500: 2, 548: 1, 500: 2, 20: 5}, 2048) == 3


def check_packed(rows, docs, tokenizer, capacity):
    want = Counter()
    for key, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(key, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [2048, 40])
def test_pack_documents(spark, tokenizer, capacity):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack_documents(docs, capacity=capacity).collect()
    bins = check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, capacity)
    assert bins <= best_fit_decreasing(Counter(r.length for r in rows), capacity)


def test_odd_rows(spark, tokenizer):
    docs = odd_docs(spark)
    rows = packing.pack_documents(docs).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 2048)
    assert packing.pack_documents(docs_of(spark, [])).count() == 0


def test_ids_are_given(spark, tokenizer):
    docs = docs_of(spark, [(1, "some words here"), (2, None)])
    got = {r.doc_id: r.ids for r in packing.pack_documents(docs, with_ids=True).collect()}
    assert got == {1: [*tokenizer.encode("some words here", add_special_tokens=False).ids, 0], 2: [0]}
