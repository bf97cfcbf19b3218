"""Repair of conversations by generalised LR parsing of their roles.

The roles of a sound conversation are a sentence of a small grammar: at most one system message, then user and
assistant in turn. The parser's tables are built from the grammar (`Table`), every way to read a row moves every live
stack, and equal stacks merge to the reading with the smallest (cost, audit). A stack is a chain of states whose lower
part other stacks share. The grammar is left-recursive, so there are but a few different stacks, however long a conversation is.

Readings of a row: Keep, Rerole to user or assistant, Delete; an empty message may be Inserted anywhere. The audit
writes the initials of the edits in order. Of equal cost the ASCII-least audit counts. Merging keeps that exact: with one
place and one cost, no audit is the beginning of another, since each further insert costs something.

Spark brings each conversation's rows together in order; a task reads them as a stream and holds one conversation:
the texts that may stay, which its one row of the result has too, and the audits of the live stacks, whose common beginnings are kept once.

Defined results: a null role or text is one space; rows lie by turn, nulls first, those of one turn by role and text; a
null conversation id is one conversation; a conversation without rows left has zeros and an empty audit; a row that is blank or seen before
(role and text) must go; columns besides the four don't matter; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (s?(ua)+)? with the initials of system, user and assistant as terminals.
GRAMMAR = (
    ("start", ("turns",)),
    ("turns", ()),
    ("turns", ("pairs",)),
    ("turns", ("s", "pairs")),
    ("pairs", ("pairs", "pair")),
    ("pairs", ("pair",)),
    ("pair", ("u", "a")),
)
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
FOLLOWING = ("su", "ua", "au")
WHITE = " \t\n\x0b\f\r"
# Rows after which the beginnings of the audits are put aside, and the size of an output batch.
ASIDE_ROWS = 256
BATCH_ROWS, BATCH_CHARS = 512, 4 << 20
END = "$"


class Table:
    """Shift and reduce moves of a grammar (SLR); several moves for one state and symbol are all followed."""

    def __init__(self, rules: tuple[tuple[str, tuple[str, ...]], ...]):
        self.rules = rules
        heads = {head for head, _ in rules}
        empty, first, follow = _sets(rules, heads)
        kernels = [self._closed({(0, 0)}, heads)]
        self.shift: list[dict[str, int]] = []
        self.reduce: list[dict[str, list[int]]] = []
        for state in kernels:
            moves: dict[str, set] = {}
            reduced: dict[str, list[int]] = {}
            for rule, dot in state:
                head, body = rules[rule]
                if dot < len(body):
                    moves.setdefault(body[dot], set()).add((rule, dot + 1))
                else:
                    for symbol in follow[head]:
                        reduced.setdefault(symbol, []).append(rule)
            self.reduce.append(reduced)
            self.shift.append({})
            for symbol, kernel in sorted(moves.items()):
                closed = self._closed(kernel, heads)
                if closed not in kernels:
                    kernels.append(closed)
                self.shift[-1][symbol] = kernels.index(closed)
        # A stack is (state, number of the stack below); equal ones have one number.
        self.stacks: list[tuple[int, int]] = [(0, -1)]
        self.number = {(0, -1): 0}
        self.moves: dict[tuple[int, str], tuple[int, ...]] = {}
        self.ends: dict[int, bool] = {}

    def _closed(self, kernel: set, heads: set) -> frozenset:
        items, todo = set(kernel), list(kernel)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            if dot < len(body) and body[dot] in heads:
                for k, (head, _) in enumerate(self.rules):
                    if head == body[dot] and (k, 0) not in items:
                        items.add((k, 0))
                        todo.append((k, 0))
        return frozenset(items)

    def _push(self, state: int, below: int) -> int:
        held = self.number.setdefault((state, below), len(self.stacks))
        if held == len(self.stacks):
            self.stacks.append((state, below))
        return held

    def _reduced(self, stack: int, symbol: str) -> Iterator[tuple[int, int]]:
        """(rule, stack) for each stack that reductions under the look-ahead `symbol` lead to; rule -1 for the stack itself."""
        todo, seen = [(-1, stack)], set()
        while todo:
            done, at = todo.pop()
            yield done, at
            for rule in self.reduce[self.stacks[at][0]].get(symbol, ()):
                head, body = self.rules[rule]
                base = at
                for _ in body:
                    base = self.stacks[base][1]
                goto = self.shift[self.stacks[base][0]].get(head)
                if rule == 0:
                    todo.append((0, base))
                elif goto is not None and (pushed := self._push(goto, base)) not in seen:
                    seen.add(pushed)
                    todo.append((rule, pushed))

    def after(self, stack: int, symbol: str) -> tuple[int, ...]:
        """The stacks that reading a terminal leads to."""
        found = self.moves.get((stack, symbol))
        if found is None:
            out = []
            for _, at in self._reduced(stack, symbol):
                state = self.shift[self.stacks[at][0]].get(symbol)
                if state is not None:
                    out.append(self._push(state, at))
            found = self.moves[stack, symbol] = tuple(dict.fromkeys(out))
        return found

    def accepts(self, stack: int) -> bool:
        if stack not in self.ends:
            self.ends[stack] = any(rule == 0 for rule, _ in self._reduced(stack, END))
        return self.ends[stack]


def _sets(rules, heads) -> tuple[set, dict, dict]:
    """Heads that may be empty, first terminals, and terminals that may follow each head."""
    empty: set[str] = set()
    first = {h: set() for h in heads}
    follow = {h: set() for h in heads}
    follow[rules[0][0]].add(END)
    size = -1
    while size != (size := len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values()))):
        for head, body in rules:
            if all(s in empty for s in body):
                empty.add(head)
            for s in body:
                first[head] |= first.get(s, {s})
                if s not in empty:
                    break
            behind = set(follow[head])
            for s in reversed(body):
                if s in heads:
                    follow[s] |= behind
                    behind = first[s] | (behind if s in empty else set())
                else:
                    behind = {s}
    return empty, first, follow


class Front:
    """The live stacks behind the rows read so far: stack -> (cost, base, audit behind the base).

    The bases are beginnings of audits put aside, in ASCII order, none the beginning of another.
    """

    def __init__(self, table: Table):
        self.table = table
        self.live: dict[int, tuple[int, int, str]] = {0: (0, 0, "")}
        self.bases: list[tuple] = [()]
        self.rows = 0
        self._insert()

    def _insert(self) -> None:
        live, todo = self.live, list(self.live)
        while todo:
            stack = todo.pop()
            cost, base, audit = live[stack]
            reading = (cost + INSERT, base, audit + "I")
            for symbol in ROLES:
                for to in self.table.after(stack, symbol):
                    if to not in live or reading < live[to]:
                        live[to] = reading
                        todo.append(to)

    def read(self, initial: str, must_go: bool, cut_off: bool) -> None:
        found: dict[int, tuple[int, int, str]] = {}
        after = self.table.after
        stays = CUT_OFF if cut_off else 0
        for stack, (cost, base, audit) in self.live.items():
            reading = (cost + DELETE, base, audit + "D")
            if stack not in found or reading < found[stack]:
                found[stack] = reading
            if must_go:
                continue
            reading = (cost + stays, base, audit + "K")
            for to in after(stack, initial):
                if to not in found or reading < found[to]:
                    found[to] = reading
            reading = (cost + stays + REROLE, base, audit + "R")
            for symbol in ROLES:
                for to in after(stack, symbol):
                    if to not in found or reading < found[to]:
                        found[to] = reading
        self.live = found
        self._insert()
        self.rows += 1
        if self.rows % ASIDE_ROWS == 0:
            self._put_aside()

    def _put_aside(self) -> None:
        bases: list[tuple] = []
        live, last = {}, None
        for stack, (cost, base, audit) in sorted(self.live.items(), key=lambda x: x[1][1:]):
            if last is None or last[0] != base or not audit.startswith(last[1]):
                last = (base, audit)
                bases.append((self.bases[base], audit))
            live[stack] = (cost, len(bases) - 1, audit[len(last[1]):])
        self.live, self.bases = live, bases

    def best(self) -> tuple[int, str]:
        """Cost and audit of the cheapest reading that the grammar accepts."""
        cost, base, audit = min(reading for stack, reading in self.live.items() if self.table.accepts(stack))
        parts, node = [audit], self.bases[base]
        while node:
            node, part = node
            parts.append(part)
        return cost, "".join(reversed(parts))


def edited(rows: list[tuple[str, str | None]], audit: str) -> list[tuple[str, str]]:
    """(role, text) of the messages that the edits leave."""
    out: list[tuple[str, str]] = []
    at = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if out and out[-1][0][:1] == "u" else "u"]
        out.append((role, text))
    return out


@lru_cache(maxsize=1)
def _table() -> Table:
    return Table(GRAMMAR)


class Conversation:
    def __init__(self, key):
        self.key = key
        self.front = Front(_table())
        self.rows: list[tuple[str, str | None]] = []
        self.seen: set[tuple[str, str]] = set()
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, blank: bool, cut_off: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.rows and self.rows[-1][0][:1] + role[:1] not in FOLLOWING:
            self.illegal += 1
        again = not blank and (role, text) in self.seen
        if blank:
            self.blank += 1
        elif again:
            self.duplicate += 1
        else:
            self.seen.add((role, text))
            self.truncated += cut_off
        must_go = blank or again
        self.rows.append((role, None if must_go else text))
        self.front.read(role[:1], must_go, cut_off and not must_go)

    def result(self) -> dict:
        cost, audit = self.front.best()
        return {
            "id": self.key, "gaps": self.high - self.low + 1 - self.turns if self.turns else 0, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit,
            "messages": [{"role": r, "text": t} for r, t in edited(self.rows, audit)],
        }


def _or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def _without_end_white(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def damage(
    rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The rows with faults, by crc32 of `id:turn` modulo 20: 0 drops the row, 1 empties its text, 2 takes its `.!?` out, 3 repeats it, 4 makes the role user.

    Columns are the four and `present`, which is false for a dropped row: it only names its conversation.
    """
    key = F.concat(_or_space(F.col(id_col)), F.lit(":"), _or_space(F.col(turn_col)))
    fault = F.crc32(key.cast("binary")) % 20
    text, role = _or_space(F.col(text_col)), _or_space(F.col(role_col))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(fault == 0, F.array(F.lit(False))).when(fault == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.lit(True)))
    return rows.select(
        F.col(id_col).alias(id_col), F.col(turn_col).alias(turn_col), F.when(fault == 4, "user").otherwise(role).alias(role_col),
        text.alias(text_col), F.explode(copies).alias("present"),
    )


def repair(
    rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    present_col: str | None = None,
) -> DataFrame:
    """Per conversation: id, gaps, blank, duplicate, truncated, illegal, cost (long), audit, messages (array of role and text).

    With `present_col`, rows for which it isn't true only name their conversation.
    """
    text = _or_space(F.col(text_col))
    present = F.lit(True) if present_col is None else F.coalesce(F.col(present_col), F.lit(False))
    ordered = rows.select(
        F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), _or_space(F.col(role_col)).alias("role"), text.alias("text"),
        present.alias("present"),
    ).withColumn("end", _without_end_white(F.col("text"))).select(
        "id", "turn", "role", "text", "present", (F.col("end") == "").alias("blank"),
        (~F.right("end", F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
    ).repartition("id").sortWithinPartitions("id", F.col("turn").asc_nulls_first(), "role", "text")
    message = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    schema = T.StructType([
        T.StructField("id", rows.schema[id_col].dataType),
        *(T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        T.StructField("audit", T.StringType()), T.StructField("messages", T.ArrayType(message)),
    ])
    return ordered.mapInArrow(_repaired, schema).withColumnRenamed("id", id_col)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    schema, chars, now = None, 0, None
    for batch in batches:
        if schema is None:
            counts = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
            message = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            schema = pa.schema([("id", batch.schema.field("id").type), *counts, ("audit", pa.string()), ("messages", message)])
        for key, turn, role, text, present, blank, cut_off in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.key != key:
                if now is not None:
                    out.append(now.result())
                    if len(out) >= BATCH_ROWS or chars >= BATCH_CHARS:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, chars = [], 0
                now = Conversation(key)
            if present:
                now.add(turn, role, text, blank, cut_off)
                chars += len(text)
    if now is not None:
        out.append(now.result())
        yield pa.RecordBatch.from_pylist(out, schema)
