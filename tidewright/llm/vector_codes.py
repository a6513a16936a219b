"""Vector codes: k-means codebooks of vector parts, by adaptive bounds in the manner of Drake and Hamerly.

Vectors become integers and are cut into equal parts; each part position has a codebook.  A row keeps, for each of its
parts, the entry it is assigned to, the b next nearest ones with a lower bound of each distance in ascending order, and one
outer bound for all other entries.  When entries move, the bounds shrink by as much; only parts whose bounds no longer prove
their entry the nearest are looked at: at first the listed entries, then, where the outer bound fails too, all of them.
Bounds are integers rounded down and drifts rounded up, distances are exact integers, so the codes are those of a full search.
b follows what the last round needed.

The rows and their bounds pass from round to round as stored tables.  Codebooks (parts x entries) are the only
thing that passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewright.llm.common import stored
from tidewright.session import discard

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Integer units of a component.
UNITS = 256
#: Components, in units, below which squared distances of vectors of up to 4,096 components fit in 64 bits.
MOST = 1 << 24
#: Bounds are kept in so many steps a unit, up to 65535 steps; a larger distance is bounded by that.
STEPS = 16
#: Nearest entries kept at first, and at most, besides the assigned one.
FIRST_KEPT, MOST_KEPT = 8, 24
#: Share of the parts whose search should end within the kept entries.
COVERED = 0.98
#: Labels with more than this share of the rows are joined by broadcast: there are fewer than its inverse.
HEAVY = 0.001

WRONG = "a vector does not have {} components, or has one of 2**16 or more"

STATE = "codes binary, kept binary, bounds binary, outer binary, part_error array<long>"
SUMS = "part int, entry int, count long, sums array<decimal(38,0)>, depth array<long>"


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the rows that take part: v is floor(256 x) of each component."""
    x = F.col("x").cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("x"),
    ).where(F.col("x").isNotNull() & (F.size("x") > 0) & fine)
    scaled = F.transform(x, lambda c: F.floor(F.when(F.abs(c * UNITS) < MOST, c * UNITS)).cast("int"))
    return kept.select("vec_id", "label", scaled.alias("v"))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks (part, entry, component) from the rows of the least ids; None without rows."""
    first = [r.v for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("vec_id", "v").limit(entries).collect()]
    if not first:
        return None
    if any(len(v) != len(first[0]) or None in v for v in first):
        raise ValueError(WRONG.format(len(first[0])))
    if len(first[0]) % parts:
        raise ValueError(f"vectors of {len(first[0])} components cannot be cut into {parts} equal parts")
    return np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()


def root_down(squares: np.ndarray) -> np.ndarray:
    """Square root in steps, rounded down, at most 65535."""
    n = np.minimum(squares, (65536 // STEPS) ** 2) * STEPS**2
    r = np.sqrt(n.astype(np.float64)).astype(np.int64)
    return np.minimum(r - (r * r > n), 65535)


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each entry moved, in steps rounded up."""
    return np.ceil(np.sqrt(((new - old).astype(np.float64) ** 2).sum(2)) * STEPS * (1 + 1e-9)).astype(np.int64)


def distances(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Exact squared distances of one part of rows to all entries of its codebook."""
    out = np.zeros((len(x), len(books)), np.int64)
    for d in range(x.shape[1]):
        step = x[:, d, None] - books[None, :, d]
        out += step * step
    return out


@dataclass
class Bounds:
    """What rows know of one part: nearest entries by lower bound, and a bound of all others."""

    code: np.ndarray
    kept: np.ndarray
    lower: np.ndarray
    outer: np.ndarray
    error: np.ndarray


def full_search(x: np.ndarray, book: np.ndarray, keep: int) -> Bounds:
    """Nearest entries, ties to the lower index."""
    squares = distances(x, book)
    near = np.argsort(squares, axis=1, kind="stable")[:, : keep + 2]
    sorted_squares = np.take_along_axis(squares, near, 1)
    lower = root_down(sorted_squares)
    outer = lower[:, keep + 1] if lower.shape[1] > keep + 1 else np.full(len(x), 65535)
    return Bounds(near[:, 0], near[:, 1 : keep + 1], lower[:, 1 : keep + 1], outer, sorted_squares[:, 0])


def bounded_search(x: np.ndarray, book: np.ndarray, drift: np.ndarray, old: Bounds, keep: int) -> tuple[Bounds, np.ndarray]:
    """The same from the bounds of the last round; also how many of the kept entries each row needed (one more: all entries)."""
    n, width = old.kept.shape
    lower = np.maximum(old.lower - drift[old.kept], 0)
    outer = np.maximum(old.outer - drift.max(), 0)
    step = x - book[old.code]
    error = (step * step).sum(1)
    code = old.code.copy()
    proof = lambda bound, square: bound * bound > np.minimum(square, 1 << 32) * STEPS**2
    # how deep a row has to look: behind the last bound that does not prove its entry
    open_ = ~proof(lower, error[:, None])
    needed = np.where(open_.any(1), width - np.argmax(open_[:, ::-1], 1), 0) if width else np.zeros(n, np.int64)
    rows = np.flatnonzero(needed)
    kept, kept_lower = old.kept.copy(), lower
    if len(rows):
        listed = np.concatenate([old.code[rows, None], old.kept[rows]], 1)
        step = x[rows][:, None, :] - book[listed]
        squares = (step * step).sum(2)
        order = np.lexsort((listed, squares), axis=1)
        listed, squares = np.take_along_axis(listed, order, 1), np.take_along_axis(squares, order, 1)
        code[rows], error[rows] = listed[:, 0], squares[:, 0]
        kept[rows], kept_lower[rows] = listed[:, 1:], root_down(squares[:, 1:])
    unsure = np.flatnonzero(~proof(outer, error)) if width + 1 < len(book) else np.zeros(0, np.int64)
    needed[unsure] = width + 1
    # ascending bounds; those no longer kept join the outer one
    order = np.argsort(kept_lower, axis=1, kind="stable")
    kept, kept_lower = np.take_along_axis(kept, order, 1), np.take_along_axis(kept_lower, order, 1)
    if keep < width:
        outer = np.minimum(outer, kept_lower[:, keep])
    out = Bounds(code, kept[:, :keep], kept_lower[:, :keep], outer, error)
    if len(unsure):
        found = full_search(x[unsure], book, keep)
        out.code[unsure], out.kept[unsure], out.lower[unsure] = found.code, found.kept, found.lower
        out.outer[unsure], out.error[unsure] = found.outer, found.error
    return out, needed


def flat(column: pa.Array, dtype: type, shape: tuple[int, ...]) -> np.ndarray:
    """A column of binary values of one length as an array."""
    data = b"".join(column.to_pylist())
    return (np.frombuffer(data, dtype).astype(np.int64) if data else np.zeros(0, np.int64)).reshape(shape)


def cells(a: np.ndarray, dtype: type) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(a.astype(dtype))]


def assign(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None, keep: int, width: int, last: bool) -> DataFrame:
    """Rows with their state, and the sums of each entry's parts as rows with NULL ``v``.

    ``moved`` holds the drifts since the state was written with ``width`` kept entries; None where there is no state.
    """
    parts, entries, size = books.shape
    schema = T.StructType([*[rows.schema[c] for c in ("vec_id", "label", "v")], *T._parse_datatype_string(f"{STATE}, {SUMS}").fields])
    out = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, size), np.int64)
        depth = np.zeros(width + 2, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = batch.column("v")
            x = v.flatten().to_numpy().astype(np.int64).reshape(n, parts, size)
            if moved is not None:
                codes, kept = flat(batch.column("codes"), np.uint8, (n, parts)), flat(batch.column("kept"), np.uint8, (n, parts, width))
                lower, outer = flat(batch.column("bounds"), np.uint16, (n, parts, width)), flat(batch.column("outer"), np.uint16, (n, parts))
            found = []
            for p in range(parts):
                if moved is None or keep > width:  # more entries are kept only after a full search
                    found.append(full_search(x[:, p], books[p], keep))
                else:
                    old = Bounds(codes[:, p], kept[:, p], lower[:, p], outer[:, p], None)
                    bounds, needed = bounded_search(x[:, p], books[p], moved[p], old, keep)
                    depth += np.bincount(needed, minlength=width + 2)
                    found.append(bounds)
                code = found[-1].code
                counts[p] += np.bincount(code, minlength=entries)
                for d in range(size):
                    sums[p, :, d] += np.bincount(code, x[:, p, d], entries).astype(np.int64)
            error = np.stack([b.error for b in found], 1)
            state = [
                pa.array(cells(np.stack([b.code for b in found], 1), np.uint8), pa.binary()),
                *([pa.nulls(n, pa.binary())] * 3 if last else [
                    pa.array(cells(np.stack([b.kept for b in found], 1).reshape(n, -1), np.uint8), pa.binary()),
                    pa.array(cells(np.stack([b.lower for b in found], 1).reshape(n, -1), np.uint16), pa.binary()),
                    pa.array(cells(np.stack([b.outer for b in found], 1), np.uint16), pa.binary())]),
                pa.array(error.tolist(), out.field("part_error").type) if last else pa.nulls(n, out.field("part_error").type),
            ]
            empty = [pa.nulls(n, f.type) for f in list(out)[3 + len(state) :]]
            arrays = [batch.column("vec_id"), batch.column("label"), v, *state, *empty]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, out, strict=True)], schema=out)
        if not last:
            used = np.argwhere(counts)
            rows_out = [
                {"part": int(p), "entry": int(e), "count": int(counts[p, e]), "sums": [int(s) for s in sums[p, e]], "depth": None} for p, e in used]
            rows_out.append({"part": -1, "entry": -1, "count": 0, "sums": None, "depth": depth.tolist()})
            for r in rows_out:
                r["sums"] = r["sums"] and [Decimal(s) for s in r["sums"]]
            yield pa.RecordBatch.from_pylist(rows_out, schema=out)

    return rows.mapInArrow(work, schema)


def moved_books(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New codebooks, each used entry the floor of its parts' mean, and how deep the round had to look."""
    parts, entries, size = books.shape
    sums = state.where("part >= 0").groupBy("part", "entry").agg(
        F.sum("count").alias("n"), *[F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(size)])
    new = books.copy()
    for r in sums.collect():  # at most parts x entries rows
        new[r.part, r.entry] = [int(r[f"s{d}"]) // r.n for d in range(size)]
    depths = state.where("part = -1").select(F.posexplode("depth")).groupBy("pos").agg(F.sum("col")).collect()
    depth = np.zeros(1 + max((r[0] for r in depths), default=0), np.int64)
    for r in depths:
        depth[r[0]] = r[1]
    return new, depth


def adapted(depth: np.ndarray, keep: int, most: int) -> int:
    """Entries to keep next: as many as the share ``COVERED`` of the parts needed, more where too many fell through."""
    total = depth.sum()
    if not total:
        return keep
    if depth[-1] > (1 - COVERED) * total:
        return min(2 * keep, most)
    return min(most, max(1, int(np.searchsorted(depth.cumsum(), COVERED * total))))


@dataclass(frozen=True)
class Coded:
    """``codes``: vec_id, label, code (array of entry indexes), part_error.  ``books``: (part, entry, component)."""

    codes: DataFrame
    books: np.ndarray
    kept: tuple[int, ...]


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Coded | None:
    """Codes of all vectors; None where none takes part.

    Vectors that are NULL, empty or hold NULL or non-finite components take no part.  The first codebooks are those of the least
    ids, NULL last, equal ids by their vectors; fewer rows than entries make smaller codebooks.  Repeated rows count each.
    All vectors must have the same number of components, a multiple of ``parts``, each below 2**16 in size: else
    ``ValueError``, or the job fails naming the fault.  Only the three named columns are read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index has to fit in a byte: 1 to 256 entries")
    rows = integers(vectors, id_col, vector_col, label_col)
    books = first_codebooks(rows, parts, entries)
    if books is None:
        return None
    size = books.shape[0] * books.shape[2]
    right = (F.size("v") == size) & ~F.exists("v", lambda c: c.isNull())
    rows = rows.withColumn("v", F.when(right, F.col("v")).otherwise(F.raise_error(F.lit(WRONG.format(size)))))
    keep, most = min(FIRST_KEPT, books.shape[1] - 1), min(MOST_KEPT, books.shape[1] - 1)
    moved, widths, held = None, [keep], None
    for _ in range(rounds):
        state = stored(assign(rows, books, moved, keep, widths[-1], False), "codes")
        new, depth = moved_books(state, books)
        moved, books = drifts(books, new), new
        widths.append(keep)
        keep = adapted(depth, keep, most)
        if held is not None:
            discard(held)
        held, rows = state, state.where("v is not null").select("vec_id", "label", "v", "codes", "kept", "bounds", "outer")
    done = stored(assign(rows, books, moved, 0, widths[-1], True).select("vec_id", "label", "codes", "part_error"), "codes")
    if held is not None:
        discard(held)
    return Coded(done, books, tuple(widths))


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, label, code, error) with ``label_error``: error summed over equal labels, NULLs together.

    Labels that many rows hold are few and joined by broadcast; the others by shuffle, none of them large.
    """
    sums = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = F.broadcast(sums.where(F.col("n") > HEAVY * total).drop("n"))
    light = sums.where(F.col("n") <= HEAVY * total).drop("n")
    out = [*[f"l.{c}" for c in rows.columns], "r.label_error"]
    equal = F.expr("l.label <=> r.label")
    in_heavy = rows.alias("l").join(heavy.alias("r"), equal).select(*out)
    in_light = rows.alias("l").join(heavy.alias("r"), equal, "left_anti").alias("l").join(light.alias("r"), equal).select(*out)
    return in_heavy.union(in_light)


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
