import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from tidewright.llm import vector_codes as V
from tidewright.llm.queries import vector_code_compression

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """{row number: (code, error)} and the codebooks, by plain searches in Python integers."""
    kept = {}
    for k, (_, vector, _) in enumerate(rows):
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept[k] = [math.floor(256 * x) for x in np.array(vector, np.float32).tolist()]
    if not kept:
        return {}, []
    size = len(next(iter(kept.values()))) // parts
    cut = {k: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for k, v in kept.items()}
    first = sorted(kept, key=lambda k: (rows[k][0] is None, rows[k][0], kept[k]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for v in cut.values():
                held[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [
                tuple(sum(c) // len(held[i]) for c in zip(*held[i])) if i in held else e for i, e in enumerate(books[p])]
    found = {k: [nearest(v[p], books[p]) for p in range(parts)] for k, v in cut.items()}
    return {k: ("".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for k, f in found.items()}, books


def check_query(rows, got):
    found, books = brute(rows)
    labels = defaultdict(int)
    for k, (_, error) in found.items():
        labels[rows[k][2]] += error
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    want = sorted(repr((rows[k][0], code, error, labels[rows[k][2]], sha)) for k, (code, error) in found.items())
    assert sorted(repr((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in got) == want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check_query(rows, vector_code_compression(spark, f"/root/testdata/{sf}").collect())


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(1)
    vector = lambda: [float(x) for x in rng.normal(0, 0.2, 32).astype(np.float32)]
    same = vector()
    rows = [(k, vector(), k % 3) for k in range(90)] + [(k, same, None) for k in range(200, 260)] + [(7, same, 1), (7, vector(), 1), (None, vector(), None)]
    rows += [(300, None, 1), (301, [], 1), (302, [None] * 32, 1), (303, [float("nan")] * 32, 0), (304, [float("inf")] + [0.0] * 31, 0)]
    rows += [(305, [0.0] * 32, 9), (305, [0.0] * 32, 9), (306, [60_000.0] + [-0.001] * 31, 9)]
    path = str(tmp_path)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as v", "'c' as code", "2 as codes", "3 as part", "4 as n", "5 as x")
    df.repartition(3).write.parquet(f"{path}/embeddings.parquet")
    check_query(rows, vector_code_compression(spark, path).collect())


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5] * 16, None)], [(2, [0.5] * 16, 1), (1, [0.25] * 16, 1)]])
def test_few_rows(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    check_query(rows, vector_code_compression(spark, str(tmp_path)).collect())


def test_wrong_vectors_are_told(spark):
    with pytest.raises(ValueError, match="15 components"):
        V.compress(spark.createDataFrame([(1, [0.5] * 15, 1)], SCHEMA))
    with pytest.raises(Exception, match="does not have 16 components"):
        V.compress(spark.createDataFrame([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], SCHEMA))
    rows = [(k, [0.5] * 16, 1) for k in range(70)] + [(71, [70_000.0] * 16, 1)]
    with pytest.raises(Exception, match="does not have 16 components"):
        V.compress(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("keep", [1, 4, 12, 31])
def test_bounds_give_the_full_search(keep):
    rng = np.random.default_rng(keep)
    x = rng.integers(-60, 60, (3000, 4))
    book = x[rng.choice(len(x), 32)].copy()
    state, width = V.full_search(x, book, keep), keep
    for step in range(8):
        new = book + rng.integers(-9, 10, book.shape) // (step + 1) + (rng.random(book.shape) < 0.02) * 200
        moved = V.drifts(book[None], new[None])[0]
        now = max(1, width - 2) if step > 3 else width
        state, needed = V.bounded_search(x, new, moved, state, now)
        width, book = now, new
        full = V.full_search(x, book, width)
        assert (state.code == full.code).all() and (state.error == full.error).all()
        squares = V.distances(x, book)
        bound = np.repeat(state.outer[:, None], len(book), 1)
        np.put_along_axis(bound, state.kept, state.lower, 1)
        np.put_along_axis(bound, state.code[:, None], 0, 1)
        assert (bound.astype(np.int64) ** 2 <= squares * V.STEPS**2).all() or width + 1 >= len(book)
        assert (np.diff(state.lower, axis=1) >= 0).all()


def test_bounds_spare_most_searches():
    rng = np.random.default_rng(2)
    book = rng.integers(-200, 200, (32, 4))
    x = book[rng.integers(0, 32, 5000)] + rng.integers(-15, 16, (5000, 4))
    new = book + rng.integers(-1, 2, book.shape)
    _, needed = V.bounded_search(x, new, V.drifts(book[None], new[None])[0], V.full_search(x, book, 4), 4)
    assert (needed > 0).mean() < 0.05


def test_kept_entries_follow_the_need():
    assert V.adapted(np.array([980, 10, 5, 5, 0, 0]), 4, 24) == 1
    assert V.adapted(np.array([500, 300, 100, 90, 10, 0]), 4, 24) == 3
    assert V.adapted(np.array([500, 0, 0, 0, 0, 500]), 4, 24) == 8
    assert V.adapted(np.zeros(6, int), 4, 24) == 4


def test_more_rounds_with_growing_bounds(spark):
    rng = np.random.default_rng(9)
    rows = [(k, [float(x) for x in rng.normal(0, 0.3, 32).astype(np.float32)], 0) for k in range(1500)]
    coded = V.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), rounds=5)
    found, books = brute(rows, rounds=5)
    assert coded.books.tolist() == [[list(e) for e in b] for b in books]
    got = {r.vec_id: (r.codes.hex(), sum(r.part_error)) for r in coded.codes.collect()}
    assert got == {rows[k][0]: f for k, f in found.items()}
    assert len(coded.kept) == 6
