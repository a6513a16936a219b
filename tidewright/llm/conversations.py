"""Repair of conversation structure by Hirschberg's divide and conquer.

Rows of a conversation are kept, given another role, deleted or completed by inserted ones until the initials of their
roles read ``(s?(ua)+)?``, at least cost and with the ASCII-least audit (initials of the edits, in order).

Four states say what a repaired prefix ends in.  A forward vector holds the least cost of each state and how the
audits that reach them rank; a backward vector holds the least cost from each state to the end.  Where they meet, the
least sum wins and, among equals, the least rank: no audit that ends in a row's edit is a prefix of another one over the same
rows, so ranks compose.  Both halves are solved alike, in space linear in the rows.

A conversation is dealt out in sorted blocks, so that one with a third of all rows spreads over tasks: each block
becomes a matrix of costs and ranks, vectors meet at its edges, and only then is it solved by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewright.llm.common import same, stored

#: Rows of a block; a task holds one block at a time.
BLOCK_ROWS = 4096
#: White space of a text; the rest counts as characters.
SPACE = " \t\n\x0b\x0c\r"

# Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEVER = 1 << 40
#: A state that costs so much more than another one is on no best path: a few inserts, deletes and roles, well below this,
#: lead from any state to what another one can still become.
FAR = 64

# States: nothing yet, after the system's row, after a user's, after an assistant's.
STATES = range(4)
#: State after an inserted row, and its role.
INSERTED = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE = {2: "user", 3: "assistant"}
#: Inserts at the end of a conversation that is left in a state.
CLOSING = ("", "II", "I", "")

Vector = tuple[tuple[int, ...], tuple[int, ...]]


def row_edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state after) of each edit of a row; ``symbol`` as of ``symbol_of``."""
    yield "D", DELETE, state
    if symbol != "x":
        more = TRUNCATED * symbol.isupper()
        if (symbol.lower(), state) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
            yield "K", KEEP + more, 1 if symbol in "sS" else INSERTED[state]
        yield "R", REROLE + more, INSERTED[state]


@lru_cache(maxsize=None)
def steps(symbol: str) -> list[list[tuple[int, str]]]:
    """``[start][end]``: least cost, and least letters at that cost, of inserts and then the row's edit."""
    table = [[(NEVER, "")] * len(STATES) for _ in STATES]
    for start in STATES:
        at = start
        for inserts in range(3):
            for letter, cost, end in row_edits(symbol, at):
                table[start][end] = min(table[start][end], (INSERT * inserts + cost, "I" * inserts + letter))
            at = INSERTED[at]
    return table


def settled(best: list[tuple]) -> tuple[int, Vector]:
    """The least cost, and the vector relative to it, of the (cost, how its audit ranks) of each state."""
    least = min(b[0] for b in best)
    far = [b[0] - least > FAR for b in best]
    order = sorted({b[1:] for b, f in zip(best, far, strict=True) if not f})
    costs = tuple(NEVER if f else b[0] - least for b, f in zip(best, far, strict=True))
    return least, (costs, tuple(0 if f else order.index(b[1:]) for b, f in zip(best, far, strict=True)))


@lru_cache(maxsize=100_000)
def next_vector(vector: Vector, symbol: str) -> tuple[int, Vector]:
    """Cost to add to all states, and the vector after one more row, its least cost being zero."""
    costs, ranks = vector
    table = steps(symbol)
    return settled([min((costs[s] + table[s][e][0], ranks[s], table[s][e][1]) for s in STATES) for e in STATES])


@lru_cache(maxsize=100_000)
def previous_costs(costs: tuple[int, ...], symbol: str) -> tuple[int, tuple[int, ...]]:
    """Cost to add to all states, and the costs to the end before one more row, the least being zero."""
    table = steps(symbol)
    best = [min(table[s][e][0] + costs[e] for e in STATES) for s in STATES]
    least = min(best)
    return least, tuple(min(b - least, NEVER) for b in best)


def at_state(state: int) -> Vector:
    return tuple(0 if s == state else NEVER for s in STATES), (0,) * len(STATES)


def forward(symbols: str, vector: Vector) -> tuple[int, Vector]:
    total = 0
    for symbol in symbols:
        more, vector = next_vector(vector, symbol)
        total += more
    return total, vector


def backward(symbols: str, costs: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    total = 0
    for symbol in reversed(symbols):
        more, costs = previous_costs(costs, symbol)
        total += more
    return total, costs


def crossing(vector: Vector, costs: tuple[int, ...]) -> int:
    """The audit-least state among those where both sides cost least."""
    return min(STATES, key=lambda s: (vector[0][s] + costs[s], vector[1][s]))


CLOSING_COSTS = tuple(INSERT * len(c) for c in CLOSING)


def last_state(symbols: str) -> int:
    """State of a whole conversation before its closing inserts."""
    return crossing(forward(symbols, at_state(0))[1], CLOSING_COSTS)


def audit(symbols: str, start: int, end: int) -> str:
    """The least audit of rows between two states."""
    if len(symbols) < 2:
        return steps(symbols)[start][end][1] if symbols else ""
    half = len(symbols) // 2
    left, right = symbols[:half], symbols[half:]
    middle = crossing(forward(left, at_state(start))[1], backward(right, at_state(end)[0])[1])
    return audit(left, start, middle) + audit(right, middle, end)


@lru_cache(maxsize=100_000)
def short_audit(symbols: str, start: int, end: int) -> str:
    return audit(symbols, start, end)


def cost_of(letters: str, symbols: str) -> int:
    """Cost of an audit over the rows it belongs to."""
    rows = [c for c in letters if c != "I"]
    each = {"K": KEEP, "R": REROLE, "D": DELETE}
    cut = sum(TRUNCATED for c, s in zip(rows, symbols, strict=True) if c != "D" and s.isupper())
    return sum(each[c] for c in rows) + cut + INSERT * (len(letters) - len(rows))


def matrix(symbols: str) -> list[int]:
    """Costs and ranks of a block from each state to each state, as 32 numbers."""
    numbers: list[int] = []
    for state in STATES:
        total, (costs, ranks) = forward(symbols, at_state(state))
        numbers += [min(total + c, NEVER) for c in costs] + list(ranks)
    return numbers


def through(vector: Vector, numbers: list[int]) -> Vector:
    """The vector after a block with this matrix."""
    costs, ranks = vector
    return settled([
        min((costs[s] + numbers[8 * s + e], ranks[s], numbers[8 * s + 4 + e]) for s in STATES) for e in STATES])[1]


def before(costs: tuple[int, ...], numbers: list[int]) -> tuple[int, ...]:
    """The costs to the end before a block with this matrix."""
    best = [min(numbers[8 * s + e] + costs[e] for e in STATES) for s in STATES]
    return tuple(min(b - min(best), NEVER) for b in best)


def trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE))


def class_of(role: Column) -> Column:
    """``s``, ``u`` or ``a`` by the role's initial; ``o`` for others and for an empty role, which cannot be kept."""
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def symbol_of(role: Column, text: Column) -> Column:
    """``x``: blank.  Else the class of the role, in upper case where the text is truncated."""
    body = trimmed(text)
    kind = class_of(role)
    return F.when(body == "", "x").when(F.right(body, F.lit(1)).isin(".", "!", "?"), kind).otherwise(F.upper(kind))


ENTRY = ["turn", "role", "hash"]
KEY = ["conv", *ENTRY]
ORDER = ["part", "seq"]


def distinct_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, hash, kind, symbol, copies, first): each different row, and whether nothing like it is earlier.

    All by aggregation, so copies shrink before they are shuffled.
    """
    narrow = rows.select(*KEY, class_of(F.col("role")).alias("kind"), symbol_of(F.col("role"), F.col("text")).alias("symbol"))
    each = stored(narrow.groupBy(*KEY, "kind", "symbol").agg(F.count("*").alias("copies")), "rows")
    firsts = each.where("symbol <> 'x'").groupBy("conv", "role", "hash").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("least"))
    marks = firsts.select("conv", F.col("least.turn").alias("turn"), "role", "hash", F.lit(None), F.lit(None), F.lit(0), F.lit(True))
    both = each.withColumn("first", F.lit(False)).union(marks)
    return both.groupBy(*KEY).agg(
        F.max("kind").alias("kind"), F.max("symbol").alias("symbol"), F.sum("copies").alias("copies"), F.bool_or("first").alias("first"))


BLOCK = (
    "part int, seq int, whole boolean, symbols string, entries array<struct<turn:long, role:string, hash:binary>>, matrix array<long>, "
    "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, initials string"
)


class Block:
    """Rows of one conversation, in order, as they come."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.symbols: list[str] = []
        self.entries: list[dict] = []
        self.blank = self.duplicate = self.illegal = self.turns = 0
        self.low = self.high = None
        self.initials = ""

    def add(self, turn: int | None, role: str, digest: bytes, kind: str, symbol: str) -> None:
        self.symbols.append(symbol)
        if symbol != "x":
            self.entries.append({"turn": turn, "role": role, "hash": digest})
        if self.initials and self.initials[-1] + kind not in ("su", "ua", "au"):
            self.illegal += 1
        self.initials = self.initials[:1] + kind
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self, part: int, seq: int, whole: bool) -> tuple:
        symbols = "".join(self.symbols)
        truncated = sum(c.isupper() for c in symbols)
        return (
            self.conv, part, seq, whole, symbols, self.entries, None if whole else matrix(symbols), self.blank, self.duplicate, truncated,
            self.illegal, self.turns, self.low, self.high, (self.initials[:1] + self.initials[-1:]))


def blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of the sorted rows; ``whole`` ones hold a conversation for sure."""
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "hash"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([rows.schema["conv"], *T._parse_datatype_string(BLOCK).fields])
    out = to_arrow_schema(schema)
    names = [*KEY, "kind", "symbol", "copies", "first"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, conversations = TaskContext.get().partitionId(), 0, 0
        block: Block | None = None
        fresh = False  # the block starts its conversation, for sure
        done: list[tuple] = []
        for batch in batches:
            for conv, turn, role, digest, kind, symbol, copies, first in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if block is None or conv != block.conv:
                    if block is not None:
                        done.append(block.row(part, seq, fresh))
                        seq += 1
                    block, fresh = Block(conv), conversations > 0
                    conversations += 1
                for k in range(copies):
                    if len(block.symbols) == block_rows:
                        done.append(block.row(part, seq, False))
                        block, fresh, seq = Block(conv), False, seq + 1
                    faulty = symbol == "x" or k > 0 or not first
                    block.blank += symbol == "x"
                    block.duplicate += faulty and symbol != "x"
                    block.add(turn, role, digest, kind, "x" if faulty else symbol)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in done], schema=out)
                done = []
        if block is not None:
            done.append(block.row(part, seq, False))
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in done], schema=out)

    return dealt.select(*names).mapInArrow(cut, schema)


def meet(open_blocks: DataFrame) -> DataFrame:
    """Start and end state of each block of the conversations that are not whole, and what its edge adds to the counts.

    A conversation's matrices, one for ``BLOCK_ROWS`` rows, come together here; its rows do not.
    """

    def solve(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values(ORDER)
        matrices = [list(m) for m in blocks["matrix"]]
        costs = [CLOSING_COSTS]
        for numbers in reversed(matrices):
            costs.append(before(costs[-1], numbers))
        costs.reverse()
        vector, state, rows = at_state(0), 0, []
        initials, high = "", None
        for k, (part, seq, numbers, ends, low, top) in enumerate(
                zip(blocks["part"], blocks["seq"], matrices, blocks["initials"], blocks["low"], blocks["high"], strict=True)):
            vector = through(vector, numbers)
            start, state = state, crossing(vector, costs[k + 1])
            illegal = int(bool(initials) and initials[-1] + ends[0] not in ("su", "ua", "au"))
            repeated = int(high is not None and low == high)
            rows.append((part, seq, start, state, k + 1 == len(matrices), illegal, repeated))
            initials, high = ends, high if pd.isna(top) else top
        return pd.DataFrame(rows, columns=["part", "seq", "start", "end", "closes", "edge_illegal", "edge_turns"])

    schema = "part int, seq int, start int, end int, closes boolean, edge_illegal long, edge_turns long"
    numbers = open_blocks.select("conv", *ORDER, "matrix", "initials", F.col("low").cast("decimal(19,0)"), F.col("high").cast("decimal(19,0)"))
    return numbers.groupBy("conv").applyInPandas(solve, schema)


SOLVED = (
    "audit string, cost long, edits array<struct<place:int, edit:string, turn:long, role:string, hash:binary, new_role:string>>"
)


def solved(placed: DataFrame) -> DataFrame:
    """Blocks with their audit, its cost and every edit that leaves a row."""
    schema = T.StructType([placed.schema["conv"], *[placed.schema[c] for c in ORDER], *T._parse_datatype_string(SOLVED).fields])
    out = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                symbols, state, end = row["symbols"], row["start"] or 0, row["end"]
                if end is None:
                    end = last_state(symbols)
                letters = (short_audit if len(symbols) < 12 else audit)(symbols, state, end)
                cost = cost_of(letters, symbols)
                if row["closes"]:
                    letters += CLOSING[end]
                    cost += INSERT * len(CLOSING[end])
                entries, rows, edits = iter(row["entries"]), iter(symbols), []
                for place, letter in enumerate(letters):
                    symbol = None if letter == "I" else next(rows)
                    entry = next(entries) if symbol not in (None, "x") else {"turn": None, "role": None, "hash": None}
                    if letter != "D":
                        state = 1 if letter == "K" and symbol in "sS" else INSERTED[state]
                        edits.append({"place": place, "edit": letter, **entry, "new_role": entry["role"] if letter == "K" else ROLE[state]})
                done.append({"conv": row["conv"], "part": row["part"], "seq": row["seq"], "audit": letters, "cost": cost, "edits": edits})
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)

    return placed.select("conv", *ORDER, "symbols", "entries", "start", "end", "closes").mapInArrow(work, schema)


@dataclass(frozen=True)
class Repaired:
    """``summary``: one row a conversation.  ``rows``: those left, in the order of (part, seq, place), with their texts.

    summary: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.
    rows: conv, part, seq, place, edit (Keep, Rerole or Insert by initial), turn, role, text.
    """

    summary: DataFrame
    rows: DataFrame


def repair(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *,
    block_rows: int = BLOCK_ROWS,
) -> Repaired:
    """Repair every conversation.

    Rows are taken by turn, NULL turns first, rows of one turn by role and the hash of the text.  A NULL role or text is one space;
    a NULL id names one conversation.  Gaps that no long can hold are NULL.  Repeated rows are duplicates, and go.  Other columns take no part, whatever their names.  An empty
    table gives empty results.
    """
    column = lambda name: F.col(f"`{name}`")
    rows = conversations.select(
        column(conv_col).alias("conv"), column(turn_col).cast("long").alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(column(text_col).cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("hash", F.unhex(F.md5(F.col("text").cast("binary"))))
    cut = stored(blocks(distinct_rows(rows), block_rows), "blocks")
    whole, open_ = cut.where("whole"), cut.where("not whole")
    edges = stored(meet(open_), "edges")
    placed = open_.join(edges, ORDER).unionByName(
        whole.withColumns({
            "start": F.lit(0), "end": F.lit(None).cast("int"), "closes": F.lit(True), "edge_illegal": F.lit(0).cast("long"),
            "edge_turns": F.lit(0).cast("long")}))
    answers = stored(solved(placed), "audits")
    counts = placed.select(
        "conv", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("edge_illegal")).alias("illegal"),
        (F.col("turns") - F.col("edge_turns")).alias("turns"), "low", "high", F.lit(0).cast("long").alias("cost"), F.lit(None).cast("struct<part:int,seq:int,audit:string>").alias("said"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")]
    none = [F.lit(None).cast("long").alias(c) for c in ("low", "high")]
    costs = answers.select("conv", *zero, *none, "cost", F.struct(*ORDER, "audit").alias("said"))
    wide = lambda c: c.cast("decimal(20,0)")
    gaps = F.coalesce(wide(F.max("high")) - wide(F.min("low")) + 1 - F.sum("turns"), F.lit(0)).try_cast("long")
    summary = counts.unionByName(costs).groupBy("conv").agg(
        gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.array_sort(F.collect_list("said")), lambda s: s.audit), "").alias("audit"))
    left = answers.select("conv", *ORDER, F.explode("edits").alias("e")).select("conv", *ORDER, "e.*")
    texts = rows.dropDuplicates(KEY)
    kept = left.where("edit <> 'I'").alias("l").join(texts.alias("r"), same("l", "r", KEY)).select(
        "l.conv", *[f"l.{c}" for c in (*ORDER, "place", "edit", "turn")], F.col("l.new_role").alias("role"), "r.text")
    added = left.where("edit = 'I'").select("conv", *ORDER, "place", "edit", "turn", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repaired(summary, kept.union(added))


def repaired_hashes(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of the lines ``role:text`` of each conversation, hashed as they pass, in order."""
    schema = T.StructType([rows.schema["conv"], T.StructField("sha256", T.StringType())])
    out = to_arrow_schema(schema)
    order = [F.col("conv").asc_nulls_first(), *ORDER, "place"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if state is not None and conv == now:
                    state.update(b"\n")
                else:
                    if state is not None:
                        done.append({"conv": now, "sha256": state.hexdigest()})
                    now, state = conv, hashlib.sha256()
                state.update(line)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv": now, "sha256": state.hexdigest()}], schema=out)

    lines = rows.select("conv", *ORDER, "place", F.concat_ws(":", "role", "text").cast("binary").alias("line"))
    return lines.repartition("conv").sortWithinPartitions(*order).select("conv", "line").mapInArrow(work, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Faults at known places, by crc32 of ``conv_id:turn`` modulo 20; NULLs are one space.

    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")
