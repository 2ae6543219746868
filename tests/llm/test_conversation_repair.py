"""Repairs against a plain search over all edits, whole and in blocks."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion_marts.llm import conversation_repair as repair
from medallion_marts.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.rstrip(SPACE)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best_edits(rows):
    """(cost, audit, repaired) by trying every edit at every place; at most three insertions in a row."""
    faults = faults_of(rows)

    def fits(said, more):
        return more in "su" if not said else more == {"s": "u", "u": "a", "a": "u"}[said]

    @lru_cache(None)
    def go(k, said, inserted):
        found = []
        if k == len(rows) and said in ("", "a"):
            found.append((0, "", ()))
        if k < len(rows):
            role, text = rows[k]
            cost, audit, rest = go(k + 1, said, 0)
            found.append((cost + 4, "D" + audit, rest))
            if faults[k] not in ("blank", "duplicate"):
                more = 3 * (faults[k] == "truncated")
                for letter, to, price in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    if to[:1] in ("s", "u", "a") and fits(said, to[0]):
                        cost, audit, rest = go(k + 1, to[0], 0)
                        found.append((cost + price + more, letter + audit, (f"{to}:{text}", *rest)))
        if inserted < 3:
            for to in ("user", "assistant"):
                if fits(said, to[0]):
                    cost, audit, rest = go(k, to[0], inserted + 1)
                    found.append((cost + 3, "I" + audit, (f"{to}:", *rest)))
        return min(found, default=(10**9, "", ()))

    return go(0, "", 0)


def expected(conversations):
    """The contract's rows of {conv_id: [(turn, role, text)]}, in the order of the rows given."""
    out = {}
    for conv, rows in conversations.items():
        name = " " if conv is None else str(conv)
        after = []
        for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
            fault = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            role = "user" if fault == 4 else role
            text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
            after += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
        turns = {t for t, _, _ in after if t is not None}
        lines = [(r, t) for _, r, t in after]
        faults = faults_of(lines)
        cost, audit, repaired = best_edits(tuple(lines))
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(lines, lines[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def conversations_of(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role, text))
    return out


def results(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def run(df):
    return results(repair.summarise(repair.repair(repair.damaged(df), gone=F.col("gone"))))


def invented(seed, n, convs):
    rng = random.Random(seed)
    return [(rng.randrange(convs), k, rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]), rng.choice(["Yes.", "No", "", " \t", "Why?", f"Text {k}.", f"Cut {k}"])) for k in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x", ""]), st.sampled_from(["a.", "b", " ", "c!", "d?", "e"])), max_size=7))
def test_auction(rows):
    kinds = [(r[:1] if r[:1] in ("s", "u", "a") else "-") + {"": "0", "blank": "1", "duplicate": "2", "truncated": "3"}[f] for (r, _), f in zip(rows, faults_of(rows))]
    cost, audit, repaired = best_edits(tuple(rows))
    assert repair.cheapest(tuple(kinds)) == (cost, audit)
    assert tuple(f"{r}:{t}" for r, t in repair.apply(audit, repair.START, rows)) == repaired
    final = repair.prices(kinds, repair.END)
    for k, kind in enumerate(kinds):  # no price is above an arc and what lies beyond it
        for state in range(4):
            assert all(final[k][state] <= c + final[k + 1][to] for _, c, to in repair.arcs(kind)[state]) and final[k][state] <= 3 + final[k][repair.INSERTED[state]]


def test_passage_costs():
    kinds = ["u0", "a3", "-1", "s0", "u2"]
    way = repair.passage(kinds)
    for beyond in (repair.END, (5, 0, 9, 2)):
        assert repair.prices(kinds, beyond)[0] == tuple(min(way[4 * s + to] + beyond[to] for to in range(4)) for s in range(4))


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(QUERIES["op11_conversation_repair"](spark, small)) == expected(conversations_of(rows))


SHAPE = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_long_conversations_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rows = invented(block, 260, 3) + [(50 + k, j, "user", f"{j}.") for k in range(9) for j in range(k)]
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    assert run(df) == expected(conversations_of(rows))


def test_odd_rows(spark):
    rows = [(7, 1, "a\x00b", "c."), (7, 2, "a", "b\x00c."), (None, 1, "user", "a."), (None, 2, None, None), (1, None, "user", "b."), (1, 5, "assistant", "c."), (2, 3, "user", None), (3, None, None, "x"), (4, -7, "", "y."), (4, 9, "système", "é…"), (5, 1, "user", "z" * 300_000 + ".")]
    df = spark.createDataFrame(rows, SHAPE).withColumns({"conv": F.lit("clash"), "a.b": F.lit(1), "uid": F.lit(2), "digest": F.lit("d"), "gone": F.lit(True), "fault": F.lit(9)})
    assert run(df) == expected(conversations_of(rows))
    assert run(df.limit(0)) == {}
    text = spark.createDataFrame([("q", 1, "user", "a."), ("q", 2, "assistant", "b.")], "conv_id string, turn long, role string, text string")
    turns = repair.repaired_turns(repair.repair(text)).orderBy("part", "seq", "position").collect()
    assert [(r.conv_id, r.role, r.text) for r in turns] == [("q", "user", "a."), ("q", "assistant", "b.")]


def test_ties_and_repeats(spark, monkeypatch):
    """Rows of equal turns go by their hash; of repeated rows, many of them broadcast, only one stays."""
    monkeypatch.setattr(repair, "LARGE_AT_LEAST", 5)
    same = [(1, 1, "user", "a."), (1, 1, "assistant", "b.")]
    rows = same + [(2, k, "user", "again.") for k in range(40)] + [(2, 40, "assistant", "so.")]
    out = repair.repair(spark.createDataFrame(rows, SHAPE))
    got = results(repair.summarise(out))
    order = sorted(same, key=lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest())
    assert got[1][-2] == best_edits(tuple((r[2], r[3]) for r in order))[1]
    assert got[2][2] == 39 and got[2][-2] == "K" + "D" * 39 + "K"
