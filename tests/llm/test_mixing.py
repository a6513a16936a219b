import math
from collections import Counter, defaultdict

import pytest

from tests.llm.util import docs_of, odd_docs, same_rows
from tidewright.llm import mixing

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    for c in SPACE[1:]:
        text = (text or "").replace(c, " ")
    return len([w for w in text.split(" ") if w])


def brute_targets(sizes, cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: cap * sizes[s] for s in over}


def check(rows, docs):
    text = defaultdict(list)
    for r in docs:
        text[r.source].append(words(r.text))
    sizes = {s: sum(v) for s, v in text.items()}
    want = brute_targets(sizes)
    by_size = Counter((r.doc_id, r.size) for r in rows)
    assert by_size == Counter((r.doc_id, words(r.text)) for r in docs)
    got = defaultdict(int)
    goal = {}
    for r in rows:
        assert 0 <= r.copies <= 3
        key = round(r.target, 6), r.source_size
        got[key] += r.copies * r.size
        goal[key] = max(goal.get(key, 0), r.size)
    assert {(round(want[s], 6), sizes[s]) for s in sizes} == set(goal)
    return got


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    for (target, _), taken in check(rows, docs.collect()).items():
        assert taken == pytest.approx(target, rel=0.02)


def test_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    keep = ["doc_id", "size", "target", "copies"]
    assert same_rows(mixing.mix(docs).select(keep), mixing.mix(docs.repartition(7)).select(keep))


def test_rates_are_tilted(spark):
    counts = spark.createDataFrame([("a", 1, 10), ("a", 10, 5), ("a", 40, 2), ("b", 5, 7), ("b", 9, 1)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 60.0), ("b", 3 * 44.0)], "source string, target double")
    found = {r.source: r for r in mixing.tilts(counts, goals).collect()}
    for s, target in (("a", 60.0), ("b", 132.0)):
        rows = [(r["size"], r.n) for r in counts.collect() if r.source == s]
        got = sum(n * z * min(3.0, math.exp(found[s].tilt * z / found[s]["mean"])) for z, n in rows)
        assert got == pytest.approx(target, rel=1e-5)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    check(mixing.mix(docs).collect(), docs.collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = mixing.mix(docs).agg({"copies": "sum"}).first()[0]
    assert mixed.count() == copies
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert mixing.mixed_documents(docs_of(spark, [])).count() == 0
    assert [r.copies for r in mixing.mix(docs_of(spark, [(1, None), (2, "")])).collect()] == [1, 1]
