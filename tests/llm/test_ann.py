import math
import random

import numpy as np
import pytest

from tidewright.llm import ann

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k=5):
    """{query: [(id, cosine)]} of usable vectors, ties to the smaller id."""
    good = {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        if q in good:
            a = np.array(good[q], float)
            near = []
            for i, v in good.items():
                if i != q:
                    b = np.array(v, float)
                    near.append((-float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), i))
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in near)[:k]]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_small_table_is_searched_whole(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = ann.search(ann.build(vectors), vectors.where("vec_id % 50 = 0")).collect()
    plain = [(r.vec_id, r.embedding) for r in vectors.collect()]
    same(found(rows), brute(plain, [i for i, _ in plain if i % 50 == 0]))


@pytest.mark.parametrize("kind", ["clustered", "unstructured"])
def test_recall(spark, kind):
    """At least 0.9 with the defaults on a table that is searched in part."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (20_000, 32))
    if kind == "clustered":
        x = 0.3 * x + rng.normal(0, 1, (60, 32))[rng.integers(0, 60, len(x))]
    x = x.astype(np.float32).astype(float)
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").repartition(8)
    index = ann.build(vectors)
    rows = found(ann.search(index, vectors.where("vec_id % 100 = 0")).collect())
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q, near in rows.items():
        scores = unit @ unit[q]
        scores[q] = -2
        hits += len({i for i, _ in near} & set(np.argsort(-scores)[:5].tolist()))
    assert len(rows) == 200 and hits >= 0.9 * 5 * len(rows) and index.sizes.sum() > 4 * ann.LEAST_CANDIDATES


def test_walk_is_in_order():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.random(7), rng.random(5)
        sizes = rng.integers(0, 3, (7, 5))
        wanted = int(rng.integers(1, sizes.sum() + 2))
        cells = {(i, j) for i, js in ann.walk(a, b, sizes.tolist(), wanted).items() for j in js}
        order = sorted(((a[i] + b[j], i, j) for i in range(7) for j in range(5) if sizes[i, j]))
        held, want = 0, set()
        for _, i, j in order:
            if held < wanted:
                want.add((i, j))
                held += sizes[i, j]
        assert cells == want


def test_odd_vectors(spark):
    rng = random.Random(3)
    plain = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(80)]
    plain[10] = (10, plain[0][1])
    plain += [(i, plain[50][1]) for i in range(100, 120)] + [(120, [2 * x for x in plain[50][1]]), (150, [3e38, 0, 0, 0, 0, 0.0])]
    odd = [(200, None), (201, []), (202, [0.0] * 6), (203, [1, None, 0, 0, 0, 0.0]), (204, [1, float("nan"), 0, 0, 0, 0.0]),
           (205, [float("inf")] * 6), (250, [1.0, 2.0]), (None, [1.0] * 6), (0, None)]
    rows = [(i, v and [None if x is None else float(x) for x in v], 1) for i, v in plain + odd]
    vectors = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as id", "'v' as vector", "2 as cell")
    index = ann.build(vectors)
    rows = ann.search(index, vectors.where("vec_id % 50 = 0")).collect()
    floats = [(r.vec_id, r.embedding) for r in vectors.collect() if r.embedding and len(r.embedding) == 6]
    same(found(rows), brute(floats, [0, 50, 100, 150]))
    assert ann.build(vectors.where("vec_id > 199 and vec_id < 206")) is None
    assert ann.build(vectors.where("1 = 0")) is None
    few = vectors.where("vec_id in (0, 1, 2)")
    assert [len(v) for v in found(ann.search(ann.build(few), few.where("vec_id = 0")).collect()).values()] == [2]
    with pytest.raises(ValueError):
        ann.search(index, vectors, k=6)


def test_copies_of_the_query(spark):
    """A vector that is most of the table: neighbours are the least other ids."""
    vectors = spark.createDataFrame([(i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(300)] + [(300, [1.0, 0.0, 0.0, 0.0], 0)], VECTORS)
    got = found(ann.search(ann.build(vectors), vectors.where("vec_id % 50 = 0")).collect())
    for q in range(0, 300, 50):
        assert [i for i, _ in got[q]] == [i for i in range(7) if i != q][:5]
