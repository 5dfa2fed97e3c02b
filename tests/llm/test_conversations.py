"""Auctions against dynamic programming, whole and cut conversations against the SQL twin and by hand."""

import hashlib
import random

import pytest

from seriesforge.llm import catalog, conversations as C
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, rank string, chunk string, copies string"
NOTHING = hashlib.sha256(b"").hexdigest()


def cheapest(symbols):
    """Least (cost, audit) by dynamic programming."""
    best = {C.START: (0, "")}

    def put(into, state, value):
        if state not in into or value < into[state]:
            into[state] = value

    def inserted(found):
        out = dict(found)
        for _ in range(3):
            for state, (cost, audit) in list(out.items()):
                put(out, C.NEXT[state], (cost + 5, audit + "I"))
        return out

    for initial, fault in symbols:
        before, best = inserted(best), {}
        for state, (cost, audit) in before.items():
            put(best, state, (cost + 2, audit + "D"))
            if fault in (1, 2):
                continue
            more, new = 5 * (fault == 3), C.NEXT[state]
            if initial == "s" and state == C.START:
                put(best, C.SYSTEM, (cost + more, audit + "K"))
            elif initial == C.ROLE[new][0]:
                put(best, new, (cost + more, audit + "K"))
            put(best, new, (cost + 1 + more, audit + "R"))
    best = inserted(best)
    return min(best[s] for s in (C.START, C.ASSISTANT) if s in best)


def draw(rng, n):
    return tuple((rng.choice(["s", "u", "a", "u", "a", ""]), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(n))


def test_auction_finds_the_cheapest_and_least_audit():
    rng = random.Random(5)
    for n in list(range(10)) * 60 + [64] * 5:
        symbols = draw(rng, n)
        assert C.solve(symbols) == cheapest(symbols)[1]


def test_prices_are_tight_on_every_cheapest_way_and_never_too_high():
    rng = random.Random(6)
    for _ in range(100):
        symbols = draw(rng, 7)
        arcs = C.lattice(symbols, C.OVER)
        prices = [0] * (len(arcs) + 1)
        assert C.auction(arcs, prices, C.START) == cheapest(symbols)[0]
        assert all(prices[i] <= cost + prices[j] for i, out in enumerate(arcs) for cost, _, j in out)


def test_cost_tables_of_chunks_add_up():
    rng = random.Random(7)
    for _ in range(60):
        a, b = draw(rng, 4), draw(rng, 3)
        first, second = C.table(a, False), C.table(b, True)
        whole = min(first[4 * C.START + m] + second[4 * m + e] for m in range(4) for e in (C.START, C.ASSISTANT))
        assert whole == cheapest(a + b)[0]


def test_whole_table_matches_sql(spark):
    assert compare(catalog.QUERIES["op13_conversation_repair"](spark, SF), connect(SF), catalog.ORACLES["op13_conversation_repair"]) is None


@pytest.mark.parametrize("size", [1, 4])
def test_cut_conversations_match_sql(spark, size):
    found = C.repair_conversations(spark.read.parquet(f"{SF}/conversations.parquet"), size)
    assert compare(found, connect(SF), C.ORACLE) is None


def hot(spark):
    rng = random.Random(8)
    rows = [(9, k // 2 if k % 50 else None, rng.choice(["user", "assistant", "system", "tool", None]),
             rng.choice(["Yes.", "No", "", None, f"Why {k}?", f"So {k}!\n"]), "x", "y", "z") for k in range(400)]
    return spark.createDataFrame(rows + [(1, 0, "user", "Hi.", "", "", ""), (1, 1, "assistant", "Hello.", "", "", "")], SCHEMA)


def test_a_long_conversation_is_the_same_in_any_chunks(spark):
    whole = sorted(map(tuple, C.repair_conversations(hot(spark), 1000).collect()))
    assert whole == sorted(map(tuple, C.repair_conversations(hot(spark), 16).collect()))
    damaged = C.materialize(C.damage(hot(spark)), "damaged")
    one, many = (sorted(map(tuple, C.repaired_rows(damaged, n).collect())) for n in (1000, 16))
    assert [(c, r, t) for c, _, r, t in one] == [(c, r, t) for c, _, r, t in many]
    text = "\n".join(f"{r}:{t}" for c, _, r, t in one if c == 9)
    assert hashlib.sha256(text.encode()).hexdigest() == next(r[-1] for r in whole if r[0] == 9)


def test_nulls_dropped_conversations_and_empty_tables(spark):
    import zlib

    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    kept = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 > 4 and zlib.crc32(f"{k}:1".encode()) % 20 > 4)
    rows = [(gone, 0, "user", "Gone."), (None, None, None, None), (None, None, None, None), (kept, 0, "user", "A."), (kept, 1, "assistant", "B.")]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    found = {r["conv_id"]: r for r in C.repair_conversations(df).collect()}
    assert set(found) == {gone, None, kept}
    assert tuple(found[gone])[1:] == (0, 0, 0, 0, 0, 0, "", NOTHING)
    assert found[None]["blank"] == 2 and found[None]["audit"] == "DD" and found[None]["gaps"] == 0
    assert (found[kept]["audit"], found[kept]["cost"]) == ("KK", 0)
    assert found[kept]["repaired_sha256"] == hashlib.sha256(b"user:A.\nassistant:B.").hexdigest()
    assert C.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    many = spark.createDataFrame([(gone, 0, "user", "Gone.", "", "", "")] * 5, SCHEMA)
    assert tuple(C.repair_conversations(many, 2).first())[1:] == (0, 0, 0, 0, 0, 0, "", NOTHING)
