"""Cheapest repair of conversations: shortest paths through a lattice by an auction.

A conversation's rows, in the order of their turns, are to become an optional system turn and then
pairs of a user's and an assistant's turn, or nothing. Nodes of the lattice are (rows done, state),
with the states: nothing yet, after system, after user, after assistant. Arcs are the edits K(eep),
R(erole) to user or assistant, D(elete) and I(nsert) of an empty turn, with whole costs.

Every node has a price, at most the cost of an arc from it plus the price of the node where that
leads. From an origin a path is extended along an arc that is as cheap as the price says; where
there is none the price rises to the cheapest and the path contracts by one node (an auction in
which nodes bid for their successor). A path that meets a node whose price is final ends there, and
its own nodes' prices are final: origins are taken from the last row to the first, so every auction
is short and all prices together take linear time. Final prices are exact distances; arcs that meet
them exactly are tight, and the least letters along tight arcs are the least of all cheapest edits.

Rows are sorted by range, so that a conversation of any length is spread over tasks, and worked on in
blocks of `BLOCK_ROWS` rows. Conversations within one block are done there. Of longer ones each block
tells, by four auctions, what it costs to get from a state to a state; these small tables are chained
per conversation from its end to give each block the prices beyond it, then each block tells where it
ends from where it may begin, which is chained from the beginning, and then it is traced.

Defined results: nulls in roles and texts are one space; rows of a null id are one conversation; rows
of equal turns (nulls come first) are in the order of the SHA-256 of the role's length, a colon, role and
text; repeated rows are duplicates of the first; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_arrow, staged, staged_with

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the lattice, and what a turn of a role (s, u, a) leads to from them.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What it costs to end in each state: nothing, or the turns that are inserted.
END = (0, 2 * INSERT, INSERT, 0)
#: More than any way costs, in a block of so many rows at most.
NEVER = 1 << 40
#: Rows and characters of a block: a block ends with the row that reaches either.
BLOCK_ROWS, BLOCK_CHARS = 1000, 1 << 18
#: Repeated (conversation, role, text) with a thousandth of the rows or more (and so many at least) are broadcast: a thousand at most.
LARGE_GROUPS, LARGE_AT_LEAST = 1000, 1000
ROLE = {"u": "user", "a": "assistant"}
#: Faults of a row.
FINE, BLANK, DUPLICATE, CUT_OFF, GONE = range(5)


@lru_cache(maxsize=None)
def arcs(kind: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state the arcs (letter, cost, state) over a row: its role's initial and its fault."""
    role, fault = kind[0], int(kind[1])
    out = []
    for state in range(4):
        here = [("D", DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED * (fault == CUT_OFF)
            if role in AFTER[state]:
                here.append(("K", KEEP + more, AFTER[state][role]))
            here += [("R", REROLE + more, AFTER[state][r]) for r in ROLE if r in AFTER[state]]
        out.append(tuple(here))
    return tuple(out)


#: The state that an inserted turn leads to, and the states that insertions can lead to.
INSERTED = tuple(next(AFTER[state][r] for r in ROLE if r in AFTER[state]) for state in range(4))
REACHED = tuple((state, *{INSERTED[state], INSERTED[INSERTED[state]]} - {state}) for state in range(4))


def prices(kinds: list[str], beyond: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The final prices of the nodes before each row and, as the last, of those beyond the rows."""
    final = [tuple(beyond)]
    for kind in reversed(kinds):
        after, over = final[-1], arcs(kind)
        direct = [min(cost + after[to] for _, cost, to in over[state]) for state in range(4)]
        # No arc from a state is cheaper than the cheapest way over the row from a state within reach.
        price = [min(direct[r] for r in REACHED[state]) for state in range(4)]
        done: set[int] = set()
        for origin in range(4):
            path = [origin]
            while path[-1] not in done:
                state = path[-1]
                insert = INSERT + price[INSERTED[state]]
                best = min(direct[state], insert)
                if price[state] < best:
                    price[state] = best
                    if len(path) > 1:
                        path.pop()  # contraction
                elif direct[state] == best:
                    break  # an extension to a node beyond the row, which is final
                else:
                    path.append(INSERTED[state])  # extension
            done.update(path)
        final.append(tuple(min(p, NEVER) for p in price))
    return final[::-1]


def trace(kinds: list[str], final: list[tuple[int, ...]], state: int) -> tuple[str, int]:
    """The least letters along tight arcs from a state, and the state where they end."""
    letters = []
    for k, kind in enumerate(kinds):
        while True:
            tight = [(letter, to) for letter, cost, to in arcs(kind)[state] if final[k][state] == cost + final[k + 1][to]]
            inserts = final[k][state] == INSERT + final[k][INSERTED[state]]
            letter, to = min(tight + [("I", INSERTED[state])] * inserts)
            letters.append(letter)
            state = to
            if letter != "I":
                break
    return "".join(letters), state


@lru_cache(maxsize=100_000)
def cheapest(kinds: tuple[str, ...]) -> tuple[int, str]:
    """Cost and letters of a whole conversation's edits."""
    final = prices(list(kinds), END)
    letters, state = trace(list(kinds), final, START)
    return final[0][START], letters + "I" * (END[state] // INSERT)


def passage(kinds: list[str]) -> list[int]:
    """What it costs to get from state to state over a block: 16 numbers."""
    columns = [prices(kinds, tuple(0 if s == to else NEVER for s in range(4)))[0] for to in range(4)]
    return [columns[to][state] for state in range(4) for to in range(4)]


def apply(letters: str, state: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired turns (role, text)."""
    out, k = [], 0
    for letter in letters:
        if letter != "D":
            role = next(r for r in ROLE if r in AFTER[state]) if letter in "IR" else rows[k][0][:1]
            out.append((rows[k][0] if letter == "K" else ROLE[role], "" if letter == "I" else rows[k][1]))
            state = AFTER[state][role]
        k += letter != "I"
    return out


def _flagged(rows: DataFrame) -> DataFrame:
    """rows with `fault`, their first one."""
    rows, seen = staged_with(rows.withColumns({"uid": F.monotonically_increasing_id(), "digest": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))}), "rows")
    here = F.struct(F.col("turn").isNotNull().alias("there"), "turn", "uid")
    groups = rows.where(~F.col("gone")).groupBy("conv", "digest").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = staged(groups.select(F.col("conv").alias("c"), F.col("digest").alias("d"), F.col("first.uid").alias("first"), (F.col("n") >= max(LARGE_AT_LEAST, seen["rows"] // LARGE_GROUPS)).alias("large")), "repeated")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    # Large groups are few, so they are broadcast; a join by digest would put each into one task.
    at_once = rows.join(F.broadcast(groups.where("large")), same, "left").drop("d", "c", "large")
    rest = at_once.where("first IS NULL").drop("first").join(groups.where("NOT large"), same, "left").drop("d", "c", "large")
    both = at_once.where("first IS NOT NULL").unionByName(rest)
    shown = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(F.col("gone"), GONE).when(shown == "", BLANK).when(F.col("first") != F.col("uid"), DUPLICATE).when(~F.substring(shown, -1, 1).isin(".", "!", "?"), CUT_OFF).otherwise(FINE)
    return both.withColumn("fault", fault).drop("first")


BLOCK = "part int, seq int, whole boolean, last boolean, turns long, low long, high long, illegal long, begins string, ends string, faults array<long>, kinds array<string>, passage array<long>, cost long, audit string, lines array<struct<role:string,text:string>>"
_NAMES = [f.split()[0] for f in BLOCK.split(", ")]


class _Block:
    """Rows of one conversation that follow one another."""

    def __init__(self):
        self.rows: list[tuple[str, str]] = []
        self.kinds: list[str] = []
        self.faults = [0, 0, 0, 0]
        self.turns = self.illegal = self.chars = 0
        self.low = self.high = self.begins = self.ends = None

    def add(self, turn, role: str, text: str, fault: int) -> None:
        if fault == GONE:
            return
        initial = role[:1]
        if self.rows:
            self.illegal += self.ends + initial not in ("su", "ua", "au")
        else:
            self.begins = initial
        self.ends = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.faults[fault] += 1
        self.rows.append((role, text))
        self.kinds.append((initial if initial in ("s", "u", "a") else "-") + str(fault))
        self.chars += len(text)

    @property
    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def row(self, part: int, seq: int, whole: bool, last: bool) -> tuple:
        common = (part, seq, whole, last, self.turns, self.low, self.high, self.illegal, self.begins, self.ends, self.faults)
        if whole:
            cost, audit = cheapest(tuple(self.kinds))
            return *common, None, None, cost, audit, _lines(apply(audit, START, self.rows))
        return *common, self.kinds, passage(self.kinds), None, None, _lines(self.rows)


def _lines(rows: list[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in rows]


def _with_types(df: DataFrame, more: str) -> StructType:
    return StructType([df.schema["conv"], *StructType.fromDDL(more).fields])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _mapped(df: DataFrame, more: str, rows_of) -> DataFrame:
    """mapInArrow over dicts of rows in order: rows_of(rows, partition) gives tuples of the id and what `more` names."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _with_types(df, more)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, size = [], 0
        for row in rows_of((r for b in batches for r in b.to_pylist()), TaskContext.get().partitionId()):
            out.append(row)
            size += 100 + sum(len(line["text"]) for line in row[-1]) if isinstance(row[-1], list) and row[-1] and isinstance(row[-1][0], dict) else 100
            if size > 8 * BLOCK_CHARS:
                yield _batch(out, arrow)
                out, size = [], 0
        if out:
            yield _batch(out, arrow)

    return map_arrow(df, run, schema)


def _cut(rows: Iterator[dict], part: int) -> Iterator[tuple]:
    """Blocks of a range of sorted rows. A conversation is whole if it is one block and not at an end of the range."""
    conv, block, seq, first, any_yet = None, None, 0, True, False
    for r in rows:
        if not any_yet or r["conv"] != conv:
            if any_yet:
                yield conv, *block.row(part, seq, not first and seq == 0, True)
                first = False
            conv, block, seq, any_yet = r["conv"], _Block(), 0, True
        elif block.full:
            yield conv, *block.row(part, seq, False, False)
            block, seq = _Block(), seq + 1
        block.add(r["turn"], r["role"], r["text"], r["fault"])
    if any_yet:
        yield conv, *block.row(part, seq, False, True)


def _backward(rows: Iterator[dict], _: int) -> Iterator[tuple]:
    """The prices beyond each block; rows come with the last block first."""
    conv, beyond = object(), END
    for r in rows:
        if r["conv"] != conv:
            conv, beyond = r["conv"], END
        yield conv, r["part"], r["seq"], list(beyond)
        way = r["passage"]
        beyond = tuple(min(way[4 * s + to] + beyond[to] for to in range(4)) for s in range(4))


def _ends(rows: Iterator[dict], _: int) -> Iterator[tuple]:
    for r in rows:
        final = prices(r["kinds"], r["beyond"])
        yield r["conv"], r["part"], r["seq"], r["beyond"], final[0], [trace(r["kinds"], final, s)[1] if final[0][s] < NEVER else s for s in range(4)]


def _forward(rows: Iterator[dict], _: int) -> Iterator[tuple]:
    """The state in which each block begins, and what the conversation costs with its first block."""
    conv, state = object(), START
    for r in rows:
        cost = 0
        if r["conv"] != conv:
            conv, state, cost = r["conv"], START, r["first"][START]
        begin, state = state, r["state"][state]
        yield conv, r["part"], r["seq"], r["beyond"], begin, cost


def _traced(rows: Iterator[dict], _: int) -> Iterator[tuple]:
    for r in rows:
        letters, state = trace(r["kinds"], prices(r["kinds"], r["beyond"]), r["begin"])
        lines = apply(letters, r["begin"], [(x["role"], x["text"]) for x in r["lines"]])
        if r["ending"]:
            tail = "I" * (END[state] // INSERT)
            letters, lines = letters + tail, lines + apply(tail, state, [])
        yield r["conv"], r["part"], r["seq"], False, r["ending"], r["turns"], r["low"], r["high"], r["illegal"], r["begins"], r["ends"], r["faults"], None, None, r["price"], letters, _lines(lines)


def _in_order(df: DataFrame, backward: bool = False) -> DataFrame:
    step = F.desc if backward else F.asc
    return df.repartition("conv").sortWithinPartitions("conv", step("part"), step("seq"))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: Column | None = None) -> DataFrame:
    """Blocks of repaired conversations: (conv, part, seq, counts of faults, cost, audit, lines (role, text)).

    Most conversations are one block; the others' come in the order of (part, seq), with the cost at the
    first. Rows for which `gone` holds only say that there is such a conversation.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"), (gone if gone is not None else F.lit(False)).alias("gone"))
    order = ["conv", "turn", "digest", "uid"]
    blocks = staged(_mapped(_flagged(rows).repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "fault"), BLOCK, _cut), "blocks")
    at = lambda a, b: F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv")) & (F.col(f"{a}.part") == F.col(f"{b}.part")) & (F.col(f"{a}.seq") == F.col(f"{b}.seq"))
    open_ = blocks.where("NOT whole")
    beyond = _mapped(_in_order(open_.select("conv", "part", "seq", "passage"), True), "part int, seq int, beyond array<long>", _backward)
    priced = open_.alias("x").join(beyond.alias("y"), at("x", "y")).select("x.conv", "x.part", "x.seq", "kinds", "beyond")
    ends = _mapped(priced, "part int, seq int, beyond array<long>, first array<long>, state array<int>", _ends)
    begins = staged(_mapped(_in_order(ends), "part int, seq int, beyond array<long>, begin int, price long", _forward), "begins")
    # The last block of a conversation is the one of the greatest place.
    tail = begins.groupBy("conv").agg(F.max(F.struct("part", "seq")).alias("tail"))
    begins = begins.alias("b").join(tail.alias("t"), F.col("b.conv").eqNullSafe(F.col("t.conv"))).select("b.*", (F.struct("part", "seq") == F.col("tail")).alias("ending"))
    joined = open_.alias("x").join(begins.alias("y"), at("x", "y")).select("x.*", "beyond", "begin", "price", "ending")
    return blocks.where("whole").unionByName(_mapped(joined, BLOCK, _traced)).drop("kinds", "passage")


def repaired_turns(blocks: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, part, seq, position, role, text) of repaired conversations; in the order of the three numbers."""
    turn = blocks.select(F.col("conv").alias(conv_col), "part", "seq", F.posexplode("lines").alias("position", "line"))
    return turn.select(conv_col, "part", "seq", "position", "line.role", "line.text")


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _summed(rows: Iterator[dict], _: int) -> Iterator[tuple]:
    """One row for each conversation from its blocks in order; texts go through the hash one block after another."""
    state = None

    def out() -> tuple:
        conv, t = state["conv"], state
        gaps = t["high"] - t["low"] + 1 - t["turns"] if t["turns"] else 0
        return conv, gaps, *t["faults"][BLANK : CUT_OFF + 1], t["illegal"], t["cost"], "".join(t["audit"]), t["hash"].hexdigest()

    for r in rows:
        if state is None or state["conv"] != r["conv"]:
            if state:
                yield out()
            state = {"conv": r["conv"], "turns": 0, "low": None, "high": None, "faults": [0] * 4, "illegal": 0, "ends": None, "cost": 0, "audit": [], "hash": hashlib.sha256(), "any": False}
        s = state
        s["turns"] += r["turns"] - (r["low"] is not None and r["low"] == s["high"])
        if r["low"] is not None:
            s["low"], s["high"] = r["low"] if s["low"] is None else s["low"], r["high"]
        s["illegal"] += r["illegal"] + (s["ends"] is not None and r["begins"] is not None and s["ends"] + r["begins"] not in ("su", "ua", "au"))
        s["ends"] = s["ends"] if r["ends"] is None else r["ends"]
        s["faults"] = [a + b for a, b in zip(s["faults"], r["faults"])]
        s["cost"] += r["cost"]
        s["audit"].append(r["audit"])
        for line in r["lines"]:
            s["hash"].update(("\n" * s["any"] + f"{line['role']}:{line['text']}").encode())
            s["any"] = True
    if state:
        yield out()


def summarise(blocks: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row for each conversation: gaps, faults, cost, audit and the SHA-256 of the repaired turns."""
    whole = blocks.where("whole")
    text = F.concat_ws("\n", F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])))
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0).cast("long"))
    at_once = whole.select("conv", gaps.alias("gaps"), *[F.col("faults")[k].alias(name) for k, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT_OFF, "truncated"))], "illegal", "cost", "audit", F.sha2(text, 256).alias("repaired_sha256"))
    rest = _mapped(_in_order(blocks.where("NOT whole")), SUMMARY, _summed)
    return at_once.unionByName(rest).withColumnRenamed("conv", conv_col)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that a hash of their place deals out, and `gone` for those that it drops."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = conversations.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), (fault == 0).alias("gone"), copies.alias("copy"))
    return rows.drop("copy")
