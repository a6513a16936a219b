import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.util import docs_of, odd_docs
from tidewright.llm import queries, syncmers


def brute_edited(docs):
    """{id: edited text}: the last third replaced by the head of the next document, descending, in a ring."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        n = len(text) // 3
        out[key] = text[: len(text) - n] + after[:n]
    return out


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = queries.QUERIES["op5_syncmer_fingerprints"](spark, sf).collect()
    want = brute_edited(docs)
    assert {r.doc_id: r.edited_sha256 for r in rows} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in want.items()}
    text = dict(docs)
    prints = {}
    for r in rows:
        assert r.n_chars == len(text[r.doc_id]) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in rows if r.n_chars > 600]
    assert sum(r.near_edited for r in long) / len(long) > 0.35
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)


def brute_anchors(spark, words):
    """Selected k-mers by the definition, hashes of words, pairs and triples of pairs by Spark."""
    if not words:
        return []
    h = spark.createDataFrame([(words,)], "w array<string>").select(F.expr("transform(w, x -> hash(x)) h")).first().h
    pairs = [spark.range(1).select(F.hash(F.lit(a), F.lit(b))).first()[0] for a, b in zip(h, h[1:])]
    out = [i for i in range(len(words) - 5) if min(pairs[i : i + 5]) in (pairs[i], pairs[i + 4])]
    return out or [0]


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 30])
def test_selection(spark, n):
    rng = random.Random(n)
    words = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(n)]
    got = syncmers.anchors(docs_of(spark, [(1, " \n".join(words))])).first()
    assert [a.word for a in got.anchors] == brute_anchors(spark, words)


def test_anchors_do_not_depend_on_context(spark):
    rng = random.Random(4)
    run = [f"w{rng.randrange(50)}" for _ in range(60)]
    a = ["left"] * 11 + run + ["right"] * 9
    b = ["x", "y"] + run + ["z"] * 30
    rows = {r.doc_id: r.anchors for r in syncmers.anchors(docs_of(spark, [(1, " ".join(a)), (2, " ".join(b))])).collect()}
    inside = {k: {(x.word - at, x["hash"]) for x in rows[k] if at <= x.word <= at + len(run) - syncmers.K} for k, at in ((1, 11), (2, 2))}
    assert inside[1] == inside[2] and len(inside[1]) > 10


def test_likeness_is_exact_on_small_texts(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("abcdefghij") for _ in range(40)) + " " + "z y x w v u t s r q " * 2) for i in range(6)]
    rows = {r.doc_id: {a["hash"] for a in r.anchors} for r in syncmers.anchors(docs_of(spark, docs)).collect()}
    frame = syncmers.edited(docs_of(spark, docs)).withColumn("near", syncmers.likeness("sketch", "next_sketch"))
    for r in frame.collect():
        a, b = rows[r.doc_id], rows[(r.doc_id - 1) % 6]
        assert r.near == pytest.approx(len(a & b) / len(a | b))


def test_unspaced_script_and_long_words(spark):
    docs = [(1, "漢字仮名交文" * 20), (2, "漢字仮名交文" * 20 + "終"), (3, "q" * 5000)]
    rows = {r.doc_id: r for r in syncmers.anchors(docs_of(spark, docs)).collect()}
    assert all(rows[i].fingerprint for i in (1, 2, 3))
    assert set(a["hash"] for a in rows[1].anchors) <= set(a["hash"] for a in rows[2].anchors)


def test_odd_rows(spark):
    odd = odd_docs(spark).selectExpr("*", "1 as sketch", "'p' as prev", "2 as edited", "3 as anchors", "4 as prev_id")
    rows = syncmers.edited(odd.repartition(5)).collect()
    assert len(rows) == odd.count()
    assert syncmers.edited(docs_of(spark, [])).count() == 0
    only = syncmers.edited(docs_of(spark, [(1, "abcdef")])).first()
    assert only.edited == "abcdab" and syncmers.edited(docs_of(spark, [(None, None)])).first().edited == ""
    a = {r.doc_id: r.edited for r in syncmers.edited(docs_of(spark, [(5, "a\U0001F600é😀bc"), (7, "x"), (2, None), (-3, "klmnop")])).collect()}
    assert a == brute_edited([(5, "a\U0001F600é😀bc"), (7, "x"), (2, None), (-3, "klmnop")])
