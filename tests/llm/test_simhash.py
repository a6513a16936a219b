import random
from collections import defaultdict

import pytest
import xxhash

from tests.llm.util import docs_of, odd_docs
from tidewright.llm import simhash
from tidewright.llm.common import components


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [words[i : i + k] for i in range(len(words) - k + 1)] if len(words) > k else [words] * bool(words)
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{id: least id reachable} of {id: fingerprint}, all pairs."""
    root = {i: i for i in prints}
    ids = sorted(prints)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if j > i and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", " \t", "One", "one TWO", "A b c", "a b c D e", "É Ä b c d É", "x " * 500])
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) == brute_print(text)


def test_spark_hash_agrees(spark):
    got = spark.sql("select xxhash64('a b c') h").first().h
    assert got % (1 << 64) == simhash.shingle_hashes(b"A  b\nc", 3)[0]


def test_links_of_random_fingerprints(spark):
    rng = random.Random(5)
    prints = {}
    for i in range(60):
        base = rng.getrandbits(64)
        prints[len(prints)] = base
        for _ in range(rng.randrange(5)):
            base ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints[len(prints)] = base
        for bits in range(4):
            prints[len(prints)] = base ^ sum(1 << (7 * b) for b in range(bits))
    rows = [((f ^ (1 << 63)) - (1 << 63),) for f in set(prints.values())]
    edges = simhash.links(spark.createDataFrame(rows, "fp long"), 2)
    found = components(edges).collect()
    group = defaultdict(set)
    for node, root in found:
        group[root].add(node % (1 << 64))
    want = defaultdict(set)
    for i, r in brute_components(prints).items():
        want[r].add(prints[i])
    assert sorted(map(sorted, group.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_long_chain(spark):
    rng = random.Random(1)
    nodes = list(range(300))
    rng.shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(300)}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 3, None: by_id[None]}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 5), (False, 6), (True, 0)]


def test_empty_and_null_ids(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
    assert simhash.keep_first(docs_of(spark, [])).count() == 0
    docs = docs_of(spark, [(None, "a b c d"), (None, "a b c d"), (None, "q w e r t y u i o p")])
    assert simhash.keep_first(docs).count() == 2


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)
