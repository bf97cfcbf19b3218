from __future__ import annotations

import heapq
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewise.llm import conversation_repair as cr
from gradewise.llm import queries
from tests.llm import plain
from tests.oracle import compare, connect

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("end", T.StringType()), T.StructField("audit", T.LongType()),
])
SOUND = re.compile("(s?(ua)+)?")


def search(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cheapest edits of (initial, must go, cut off) rows: readings in the order of (cost, audit), each a whole string of roles."""
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(rows) and SOUND.fullmatch(roles):
            return cost, audit
        state = (at, roles[-1:], "s" in roles)
        # Only equal cost and audit may pass twice; the first of a state is its cheapest.
        if state in done or not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        done.add(state)
        for role in "ua":
            heapq.heappush(heap, (cost + 5, audit + "I", at, roles + role))
        if at < len(rows):
            initial, must_go, cut_off = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles))
            if not must_go:
                heapq.heappush(heap, (cost + 5 * cut_off, audit + "K", at + 1, roles + (initial or "?")))
                for role in "ua":
                    heapq.heappush(heap, (cost + 5 * cut_off + 1, audit + "R", at + 1, roles + role))


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.booleans(), st.booleans()), max_size=14), st.integers(1, 5))
def test_front_finds_the_cheapest_edits(rows, aside):
    held, cr.ASIDE_ROWS = cr.ASIDE_ROWS, aside
    try:
        front = cr.Front(cr.Table(cr.GRAMMAR))
        for initial, must_go, cut_off in rows:
            front.read(initial, must_go, cut_off and not must_go)
    finally:
        cr.ASIDE_ROWS = held
    assert front.best() == search([(i, m, c and not m) for i, m, c in rows])


def test_grammar_with_several_moves():
    # Either reading of an "u" is followed: the tables have two reductions for one state and symbol.
    table = cr.Table((("start", ("x",)), ("x", ("y", "a")), ("x", ("z", "a", "a")), ("y", ("u",)), ("z", ("u",))))
    ends = lambda stacks: any(table.accepts(s) for s in stacks)
    one = {t for s in table.after(0, "u") for t in table.after(s, "a")}
    two = {t for s in one for t in table.after(s, "a")}
    assert ends(one) and ends(two) and not ends({t for s in two for t in table.after(s, "a")})


def test_long_conversation():
    front = cr.Front(cr._table())
    for k in range(40_000):
        front.read("ua"[k % 2] if k % 97 else "s", False, k % 89 == 0)
    cost, audit = front.best()
    assert len(audit) >= 40_000 and len(front.live) <= 10 and cost > 0


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf, size):
    folder = sf.replace("sf0.001", size)
    rows, problems = compare(queries.op13_conversation_repair(spark, folder), connect(folder), queries.oracle_sql()["op13_conversation_repair"])
    assert not problems and rows > 0


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def plain_repair(rows):
    """conv -> row of the contract, from rows (conv, turn, role, text)."""
    every = {r[0] for r in rows}
    out = {}
    for conv in every:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, kinds = set(), []
        for _, _, role, text in own:
            end = re.findall(r"[^\x20\x09-\x0D]", text)
            kinds.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        cost, audit = search([(i, k in ("blank", "duplicate"), k == "truncated") for i, k in zip(initials, kinds)])
        messages, at = [], 0
        for edit in audit:
            row = ("", "") if edit == "I" else own[at][2:]
            at += edit != "I"
            if edit == "K":
                messages.append(row)
            elif edit != "D":
                messages.append(("assistant" if messages and messages[-1][0][0] == "u" else "user", row[1]))
        turns = [r[1] for r in own if r[1] is not None]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            plain.sha256("\n".join(f"{r}:{t}" for r, t in messages)),
        )
    return out


def test_odd_rows(spark, tmp_path):
    rows = [
        (1, 0, "system", "Be good."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (1, None, None, None),
        (2, 5, "tool", "x"), (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 5, "", "No role."), (None, 1, "user", "a."), (None, None, "assistant", "b."),
        (3, 0, "user", " \t\n\x0b\f\r"), (3, 1, "assistant", "\x00"), (3, 9, "assistant", "End. \n"), (4, -3, "user", "q" * 300_000), (4, 3, "assistant", "Ü!"),
        *((5, k, "ua"[k % 2].replace("u", "user").replace("a", "assistant"), f"turn {k}.") for k in range(600)), *((6, 0, "user", "copy.") for _ in range(500)),
    ]
    rows += [(k, 0, "user", "one.") for k in range(100, 140)]  # some lose their only row
    full = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], ROWS)
    full.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_conversation_repair(spark, str(tmp_path)).collect()
    want = plain_repair(rows)
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want
    assert any(r.audit == "" for r in got)
    spark.createDataFrame([], ROWS).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert queries.op13_conversation_repair(spark, f"{tmp_path}/none").count() == 0


def test_repair_of_undamaged_rows(spark):
    rows = spark.createDataFrame([("a", 1, "assistant", "First."), ("a", 2, "assistant", "Second."), ("b", 1, "user", "Only?")], "conv string, t int, who string, said string")
    got = cr.repair(rows, id_col="conv", turn_col="t", role_col="who", text_col="said")
    found = {r.conv: (r.cost, r.audit, [tuple(m) for m in r.messages]) for r in got.collect()}
    assert found == {"a": (1, "RK", [("user", "First."), ("assistant", "Second.")]), "b": (2, "D", [])}
    assert got.select(F.sum("cost")).first()[0] == 3
