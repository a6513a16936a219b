"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length 1 and cut in two halves; each half has its own centroids, fitted on a
bounded sample.  An entry lies in the cell of its two nearest centroids.  A query walks the
pairs of centroids by summed distance with a heap until their cells hold enough entries, and these are
ranked by the exact cosine of the original vectors.  How many are enough is measured when the index is built: the
true neighbours of a bounded sample of entries, found among all entries, say how far walks have to go for the recall asked
for.  Clustered vectors need few entries whatever the size of the table; vectors without structure need a share of it.

Equal vectors are one entry with the ids of its least few rows, so copies cost nothing; a cell is searched
in blocks of entries and queries, each one numpy product that returns the best few of every query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import in_batches, stored

#: Bound of the sample that the centroids are fitted on: rows of the least id hashes.
TRAIN_ROWS = 20_000
#: Entries a cell that the number of centroids aims at, and most centroids of a half (a million cells).
CELL_ENTRIES = 0.5
MOST_CENTROIDS = 1_024
#: Recall that the length of the walks is set for, and the entries and neighbours of each that it is measured on.
RECALL = 0.94
MEASURED_ROWS = 256
MEASURED_NEAREST = 5
#: Least number of entries that the cells of a query hold before its walk ends.
LEAST_CANDIDATES = 4_000
#: Scores of one product that lie closer than this are told apart by the exact cosine.
MARGIN = 1e-9
#: Entries and queries of one block.
BLOCK = 2_048
#: Queries of one product, and the score of entries of other cells.
PRODUCT = 256
#: Queries that one task walks for.
WALKS = 128
OUTSIDE = -2.0
ROUNDS = 12

Rows = Iterator[tuple]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part: an id, and a vector of finite components that are not all zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where("id is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return rows.where(finite & F.exists("vector", lambda x: x != 0))


def scaled(vectors: list[list[float]]) -> np.ndarray:
    """Rows times a power of two, so that squares stay finite; cosines keep every bit."""
    v = np.array(vectors, float)
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, initial=0))[1][:, None])


def kmeans(points: np.ndarray, k: int) -> np.ndarray:
    """Centroids by Lloyd's rounds, seeded by points evenly spread over the sample's order."""
    centroids = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        near = nearest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=k)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(axis=1)


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(p, centroids).argmin(axis=1) for p in np.array_split(points, len(points) // 4096 + 1)])


def walk(a: np.ndarray, b: np.ndarray, entries: np.ndarray, wanted: int) -> dict[int, list[int]]:
    """Pairs of centroids in order of ``a[i] + b[j]`` until their cells hold ``wanted`` entries: by i, the j of cells in use.

    Of each i the next cell in use waits in the heap; an i joins once no pair of it can come before the heap's first.
    """
    rows, columns = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    x, y, entries = a[rows], b[columns], np.asarray(entries)
    bounds, heap, lines, cells, held = (x + y[0]).tolist(), [], [], {}, 0
    while held < wanted:
        while len(lines) < len(bounds) and (not heap or bounds[len(lines)] <= heap[0][0]):
            i = len(lines)
            counts = entries[rows[i]][columns]
            used = np.flatnonzero(counts)
            lines.append(((x[i] + y[used]).tolist(), columns[used].tolist(), counts[used].tolist(), cells.setdefault(int(rows[i]), [])))
            if len(used):
                heapq.heappush(heap, (lines[i][0][0], i, 0))
        if not heap:
            break
        _, i, j = heap[0]
        sums, of, counts, taken = lines[i]
        taken.append(of[j])
        held += counts[j]
        if j + 1 < len(sums):
            heapq.heapreplace(heap, (sums[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
    return {i: taken for i, taken in cells.items() if taken}


@dataclass
class MultiIndex:
    """Centroids of both halves and the entries (vector, ids, a, b), a stored table; ``sizes`` counts each cell (a, b).

    ``reach`` is the number of entries that walks have to pass for the recall asked for.
    """

    halves: tuple[np.ndarray, np.ndarray]
    entries: DataFrame
    sizes: np.ndarray
    keep: int
    reach: int = 0

    @property
    def length(self) -> int:
        return sum(h.shape[1] for h in self.halves)


def unit_halves(vectors: list[list[float]], at: int) -> tuple[np.ndarray, np.ndarray]:
    v = scaled(vectors)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return v[:, :at], v[:, at:]


def build(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, keep: int = 6, train_rows: int = TRAIN_ROWS,
    recall: float = RECALL,
) -> MultiIndex | None:
    """Index of every row that takes part; None if there is none.

    Vectors of another length than most have take no part.  Of equal vectors the ``keep`` least ids are kept: one more than neighbours asked for, as a query passes over itself.
    """
    rows = usable(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if lengths is None:
        return None
    rows = rows.where(F.size("vector") == lengths["length"])
    place = Window.partitionBy("vector").orderBy("id")
    least = rows.withColumn("n", F.row_number().over(place)).where(F.col("n") <= keep)
    distinct = stored(least.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("vector")).limit(train_rows).select("vector").collect()  # bounded by train_rows
    k = int(min(MOST_CENTROIDS, max(1, round(math.sqrt(n / CELL_ENTRIES))), len(sample)))
    at = len(sample[0][0]) // 2
    halves = tuple(kmeans(h, k) for h in unit_halves([r[0] for r in sample], at))

    def work(batch: list[tuple]) -> Rows:
        a, b = (nearest(h, c).tolist() for h, c in zip(unit_halves([r[0] for r in batch], at), halves, strict=True))
        yield from ((*row, i, j) for row, i, j in zip(batch, a, b, strict=True))

    schema = T.StructType([*distinct.schema.fields, T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    entries = stored(in_batches(distinct, [F.col("vector"), F.col("ids")], work, schema), "entries")
    sizes = np.zeros((k, k), np.int64)
    for i, j, count in entries.groupBy("a", "b").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        sizes[i, j] = count
    index = MultiIndex(halves, entries, sizes, keep)
    index.reach = reach(index, [r[0] for r in sample[:MEASURED_ROWS]], recall)
    return index


def reach(index: MultiIndex, sample: list[list[float]], recall: float, nearest: int = MEASURED_NEAREST) -> int:
    """Entries that walks have to pass so that they meet the share ``recall`` of the true neighbours of ``sample``.

    The sample is held against all entries, batch by batch; each batch returns its best few of every sampled vector.
    """
    asked = np.hstack(unit_halves(sample, len(sample[0]) // 2))

    def work(batch: list[tuple]) -> Rows:
        scores = np.hstack(unit_halves([r[0] for r in batch], asked.shape[1] // 2)) @ asked.T
        for q, best in enumerate(np.argsort(-scores, axis=0)[: nearest + 1].T.tolist()):
            yield from ((q, float(scores[e, q]), *batch[e][1:]) for e in best)

    schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("score", T.DoubleType()),
                           T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    met = in_batches(index.entries, [F.col(c) for c in ("vector", "a", "b")], work, schema)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "a", "b")
    # the first of each is the sampled entry itself; at most MEASURED_ROWS * MEASURED_NEAREST rows
    true = met.withColumn("n", F.row_number().over(order)).where(F.col("n").between(2, nearest + 1)).select("q", "a", "b").collect()
    if not true:
        return 1
    halves = unit_halves(sample, index.halves[0].shape[1])
    x, y = (distances(h, c) for h, c in zip(halves, index.halves, strict=True))
    passed = []
    for q, a, b in true:
        sums = x[q][:, None] + y[q]
        passed.append(int(index.sizes[sums <= sums[a, b]].sum()))
    return sorted(passed)[math.ceil(recall * len(passed)) - 1]


def cosines(query: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Cosines in double precision; each row is summed alone, so a pair scores the same in any block."""
    return (entries * query).sum(axis=1) / (np.sqrt((query**2).sum()) * np.sqrt((entries**2).sum(axis=1)))


def search(index: MultiIndex, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 5, candidates: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, itself left out by its id.

    Nearest by cosine, ties to the smaller id.  Rows without a usable vector are no queries; a query id that
    repeats with other vectors is searched for each of them and ranked once.
    """
    if k >= index.keep:
        raise ValueError("the index keeps too few ids of equal vectors")
    halves, sizes = index.halves, index.sizes
    wanted = candidates or max(LEAST_CANDIDATES, index.reach)
    asked = usable(queries, id_col, vector_col).where(F.size("vector") == index.length).distinct()

    def route(batch: list[tuple]) -> Rows:
        a, b = unit_halves([r[1] for r in batch], halves[0].shape[1])
        for (key, vector), x, y in zip(batch, distances(a, halves[0]), distances(b, halves[1]), strict=True):
            for i, cells in walk(x, y, sizes, wanted).items():
                yield key, vector, i, cells

    schema = T.StructType([*asked.schema.fields, T.StructField("a", T.LongType()), T.StructField("cells", T.ArrayType(T.IntegerType()))])
    asked = stored(asked, "asked")
    asked = asked.repartition(max(1, math.ceil(asked.count() / WALKS)), "id")
    routed = stored(in_batches(asked, [F.col("id"), F.col("vector")], route, schema), "routed")
    asks = np.zeros(len(sizes), np.int64)
    for i, count in routed.groupBy("a").count().collect():  # at most MOST_CENTROIDS rows
        asks[i] = count
    # the cells of a centroid are searched in blocks of entries by parts of queries
    blocks, parts = shares(sizes.sum(axis=1)), shares(asks)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = routed.withColumn("part", F.pmod(F.xxhash64("id"), parts("a"))).withColumn("block", every(blocks("a")))
    right = index.entries.withColumn("block", F.pmod(F.xxhash64("vector"), blocks("a"))).withColumn("part", every(parts("a")))

    def best(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asking) and len(held):
            ids, cell = held["ids"].to_list(), held["b"].to_numpy()
            least, matrix = np.array([i[0] for i in ids]), scaled(held["vector"].to_list())
            unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
            for from_ in range(0, len(asking), PRODUCT):
                some = asking.iloc[from_ : from_ + PRODUCT]
                q = scaled(some["vector"].to_list())
                opened = np.zeros((len(some), len(sizes)), bool)
                for row, cells in zip(opened, some["cells"], strict=True):
                    row[cells] = True
                near = np.where(opened[:, cell], (q / np.linalg.norm(q, axis=1, keepdims=True)) @ unit.T, OUTSIDE)
                # of k + 1 entries at most one is the query alone
                last = np.partition(near, -k - 1, axis=1)[:, [-k - 1]] if len(ids) > k + 1 else OUTSIDE
                few = (near >= last - MARGIN) & (near > OUTSIDE)
                for key, vector, row in zip(some["id"].tolist(), q, few, strict=True):
                    at = np.flatnonzero(row)
                    exact = cosines(vector, matrix[at])
                    top = [(-exact[e], i) for e in np.lexsort((least[at], -exact))[: k + 1] for i in ids[at[e]] if i != key]
                    found += [(key, i, -x) for x, i in sorted(top)[:k]]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["a", "block", "part"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score double")
    once = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def shares(sizes: np.ndarray):  # noqa: ANN201
    """Column function: number of shares of at most about BLOCK rows of a centroid; the table has a number for each."""
    n = np.maximum(1, -(-sizes // BLOCK))

    @F.pandas_udf("long")
    def of(centroid: pd.Series) -> pd.Series:
        return pd.Series(n[centroid.to_numpy()])

    return of
