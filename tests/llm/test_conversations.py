import hashlib
import random
import sys
import zlib
from functools import lru_cache

import pytest

from tests.llm.util import same_rows
from tidewright.llm import conversations as C
from tidewright.llm.queries import conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
sys.setrecursionlimit(20_000)


def brute(symbols):
    """Least (cost, audit) of a conversation, over every edit at every place."""

    @lru_cache(maxsize=None)
    def best(i, said, inserts):
        options = []
        if i == len(symbols) and said in ("", "a"):
            options.append((0, ""))
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[said]
        if inserts < 3:
            for role in set(legal) & set("ua"):
                cost, audit = best(i, role, inserts + 1)
                options.append((2 + cost, "I" + audit))
        if i < len(symbols):
            symbol = symbols[i]
            cost, audit = best(i + 1, said, 0)
            options.append((3 + cost, "D" + audit))
            if symbol != "x":
                cut = symbol.isupper()
                if symbol.lower() in legal:
                    cost, audit = best(i + 1, symbol.lower(), 0)
                    options.append((cut + cost, "K" + audit))
                for role in set(legal) & set("ua"):
                    cost, audit = best(i + 1, role, 0)
                    options.append((2 + cut + cost, "R" + audit))
        return min(options, default=(10**9, ""))

    return best(0, "", 0)


def solve(symbols, cut=None):
    """By the operator; with ``cut`` in blocks of so many rows that meet by their matrices."""
    if cut is None:
        end = C.last_state(symbols)
        letters = C.audit(symbols, 0, end)
        return C.cost_of(letters, symbols) + 2 * len(C.CLOSING[end]), letters + C.CLOSING[end]
    parts = [symbols[i : i + cut] for i in range(0, len(symbols), cut)]
    costs = [C.CLOSING_COSTS]
    for part in reversed(parts):
        costs.append(C.before(costs[-1], C.matrix(part)))
    costs.reverse()
    vector, state, letters = C.at_state(0), 0, ""
    for k, part in enumerate(parts):
        vector = C.through(vector, C.matrix(part))
        start, state = state, C.crossing(vector, costs[k + 1])
        letters += C.audit(part, start, state)
    return C.cost_of(letters, symbols) + 2 * len(C.CLOSING[state]), letters + C.CLOSING[state]


@pytest.mark.parametrize("seed", range(40))
def test_audit_is_the_least(seed):
    rng = random.Random(seed)
    for _ in range(150):
        alphabet = "".join(rng.choices("suaoSUAOx", k=rng.randrange(1, 9)))
        symbols = "".join(rng.choices(alphabet, k=rng.randrange(0, 40)))
        want = brute(symbols)
        assert solve(symbols) == want, symbols
        assert solve(symbols, rng.randrange(1, 9)) == want, symbols


def expected(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines)} of rows after damage."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, symbols, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        initials = [r[:1] if r[:1] in ("s", "u", "a") else "o" for _, r, _ in turns]
        for (_, role, text), kind in zip(turns, initials):
            body = text.strip(SPACE)
            if not body:
                faults["blank"] += 1
                symbols += "x"
            elif (role, text) in seen:
                faults["duplicate"] += 1
                symbols += "x"
            elif body[-1] not in ".!?":
                faults["truncated"] += 1
                symbols += kind.upper()
            else:
                symbols += kind
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = brute(symbols)
        state, lines, at = "", [], iter(turns)
        for letter in audit:
            row = None if letter == "I" else next(at)
            if letter == "D":
                continue
            new = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            role = row[1] if letter == "K" else new
            state = role[0]
            lines.append(f"{role}:{row[2] if row else ''}")
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, "\n".join(lines))
    return out


def damaged(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(kind, text)
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def check_query(rows, got):
    want = expected(list(damaged([tuple(r) for r in rows])))
    assert sorted(map(repr, {r[0] for r in rows})) == sorted(repr(r.conv_id) for r in got)
    for r in got:
        *numbers, audit, text = want.get(r.conv_id, (0, 0, 0, 0, 0, 0, "", ""))
        assert [r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost] == numbers
        assert r.audit == audit
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").collect()
    check_query(rows, conversation_repair(spark, f"/root/testdata/{sf}").collect())


def odd_rows():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "what", " ", "", None, "a.\n", "x" * 50_000, "é?", "Yes."]
    rows = [
        (conv, rng.choice([None, 0, 1, 2, 3, 7, 9]), rng.choice(["user", "assistant", "system", "tool", None, "u", ""]), rng.choice(texts))
        for conv in [None, 1, 2, 3, 4] for _ in range(15)
    ]
    return rows + rows[:20] + [(5, None, None, None), (6, 2**62, "user", "Far."), (6, -(2**61), "assistant", "off.")]


def test_odd_rows(spark, tmp_path):
    rows = odd_rows()
    path = str(tmp_path)
    df = spark.createDataFrame(rows, SCHEMA)
    df.selectExpr("*", "1 as part", "'x' as conv", "2 as seq", "'k' as symbol", "3 as place", "'h' as hash").write.parquet(f"{path}/conversations.parquet")
    check_query(rows, conversation_repair(spark, path).collect())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert conversation_repair(spark, str(tmp_path)).count() == 0


def test_long_conversations_in_blocks(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", f"no {t}", f"Well {t}.", " "])) for t in range(700)]
    rows += [(2, 0, "user", "Same.")] * 300 + [(c, t, "user", f"{t}?") for c in range(3, 30) for t in range(3)]
    got = C.repair(spark.createDataFrame(rows, SCHEMA), block_rows=16)
    want = expected(rows)
    for r in got.summary.collect():
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == want[r.conv][:-1]
    lines = {}
    for r in got.rows.orderBy("part", "seq", "place").collect():
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    assert {c: "\n".join(x) for c, x in lines.items()} == {c: w[-1] for c, w in want.items() if w[-1]}
    assert same_rows(got.summary, C.repair(spark.createDataFrame(rows, SCHEMA)).summary)
