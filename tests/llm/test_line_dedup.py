import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.util import docs_of, odd_docs
from tidewright.llm import line_dedup


def brute(docs, min_words):
    """{doc: lines kept}: deletes every line of a run of equal lines, min_words or more, that begins earlier."""
    full = {key: [(i, x.strip(), len(x.split())) for i, x in enumerate((text or "").split("\n")) if x.split()] for key, text in docs}
    gone = {key: set() for key, _ in docs}
    for key, a in full.items():
        for p in range(len(a)):
            for other, b in full.items():
                for q in range(len(b)):
                    if (other, q) < (key, p):
                        n = w = 0
                        while p + n < len(a) and q + n < len(b) and a[p + n][1] == b[q + n][1]:
                            w += a[p + n][2]
                            n += 1
                        if w >= min_words:
                            gone[key] |= set(range(a[p][0], a[p + n - 1][0] + 1))
    return {key: "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone[key]) for key, text in docs}


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 5))) for _ in range(12)] + ["", " \t"]
    docs = []
    for key in range(25):
        lines = [rng.choice(vocabulary) for _ in range(rng.randrange(14))]
        if docs and rng.random() < 0.6:
            old = rng.choice(docs)[1].split("\n")
            at = rng.randrange(len(old))
            lines[rng.randrange(len(lines) + 1) :] = old[at : at + rng.randrange(1, 8)]
        docs.append((key, "\n".join(lines)))
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(spark, docs), min_words=7).collect()}
    assert out == brute(docs, 7)


def test_first_instance_of_every_line_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = {x.strip() for r in docs.collect() for x in r.text.split("\n") if x.split()}
    after = {x.strip() for r in line_dedup.dedup_lines(docs, min_words=50).collect() for x in r.text.split("\n") if x.split()}
    assert before == after


def test_least_in():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 5, 60)
    first = rng.integers(0, 60, 200)
    last = np.minimum(59, first + rng.integers(0, 30, 200))
    got = line_dedup.least_in(values, first, last)
    for a, b, p in zip(first, last, got):
        assert a <= p <= b and values[p] == values[a : b + 1].min()
        assert (values[p + 1 : b + 1] != values[p]).all()
    assert len(line_dedup.least_in(values, first[:0], last[:0])) == 0


def test_cases(spark):
    passage = " ".join(f"p{i}" for i in range(51))
    short = " ".join(f"s{i}" for i in range(49))
    docs = docs_of(spark, [(1, f"a\n{passage}\nb"), (2, f"c\n  {passage}\t\nd"), (3, passage), (4, short), (5, short), (6, f"{passage}\n{passage}")])
    out = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert out == {1: (f"a\n{passage}\nb", 0), 2: ("c\nd", 1), 3: ("", 1), 4: (short, 0), 5: (short, 0), 6: ("", 2)}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = line_dedup.dedup_lines(docs.selectExpr("*", "'m' as mask", "'p' as place", "5 as removed", "1 as lines_removed")).collect()
    assert len(rows) == docs.count()
    text = {(r.doc_id, r.lang, r.source): r.text for r in docs.collect()}
    for r in rows:
        want = "" if r.doc_id == 7 else text[(r.doc_id, r.lang, r.source)]
        assert r.text == want and r["mask"] == "m" and r.lines_removed == int(r.doc_id == 7)
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0
    nulls = docs_of(spark, [(None, "x " * 60), (1, "x " * 60), (None, None)])
    assert Counter(r.text for r in line_dedup.dedup_lines(nulls).collect()) == {"x " * 60: 1, "": 1, None: 1}
