"""Repair of conversation structure by the auction algorithm for shortest paths.

A conversation is a lattice: a node is (rows used up, what the kept turns end in), an arc is an edit
with an integer cost: keep a row, give it another role, delete it, insert an empty turn. Auction: a path
grows from the start to the neighbour of least cost plus price; where none is as cheap as the node's own
price, the price rises to the best neighbour's and the path shrinks by one node. When the path reaches the
end, every arc of every cheapest path is tight (its cost is the difference of its nodes' prices), so the
audit is traced along tight arcs that lead on to the end, the least letter first.

A conversation of at most ``chunk`` rows is one group and one auction. Longer ones, up to any share of the
rows, are ranked by one range shuffle and cut into chunks of that many rows: auctions between all four
states at a chunk's ends give its cost table, one backward pass over the tables (16 numbers a chunk) the
prices at its end, auctions against those prices the trace from each state, and one forward pass picks
the states. Texts stay in the chunks; a digest is fed with them in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import slices, worker_cache
from seriesforge.llm.ordering import numbered
from seriesforge.llm.sql import crc32_sql
from seriesforge.session import materialize, settle

CHUNK = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK = " \t\n\v\f\r"
FAULTS = ("", "blank", "duplicate", "truncated")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
INF = 1 << 60
# States: nothing kept yet, or the initial of the last kept turn. A new turn is the user's, or the answer to it.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
OVER = (0, None, None, 0)  # a conversation may end empty or with an answer

Symbol = tuple[str, int]  # initial of the role, fault
Arc = tuple[int, str, int]  # cost, letter, node


def lattice(symbols: tuple[Symbol, ...], ends: tuple[int | None, ...], last: bool = True) -> list[list[Arc]]:
    """Arcs by node 4 * rows used + state, letters ascending; the goal is the node after the last.

    ``ends`` has the cost from each state behind the rows to the goal, None where there is no way.
    Turns can be inserted before every row and, in the ``last`` part of a conversation, after it.
    Arcs to nodes from which no way leads to the goal are left out: prices there would rise for ever.
    """
    rows = len(symbols)
    arcs: list[list[Arc]] = [[] for _ in range(4 * rows + 4)]
    for k in range(rows + 1):
        for state in range(4):
            out, new = arcs[4 * k + state], NEXT[state]
            if k == rows:
                if ends[state] is not None:
                    out.append((ends[state], "", 4 * rows + 4))
                if last:
                    out.append((INSERT, "I", 4 * k + new))
                continue
            initial, fault = symbols[k]
            out += [(DELETE, "D", 4 * k + 4 + state), (INSERT, "I", 4 * k + new)]
            if fault in (1, 2):
                continue
            more = TRUNCATED if fault == 3 else 0
            if initial == "s" and state == START:
                out.append((KEEP + more, "K", 4 * k + 4 + SYSTEM))
            elif initial == ROLE[new][0]:
                out.append((KEEP + more, "K", 4 * k + 4 + new))
            out.append((REROLE + more, "R", 4 * k + 4 + new))
    leads = {4 * rows + 4}
    for k in range(rows, -1, -1):
        for _ in range(3):  # insertions stay among the nodes of one place
            leads.update(4 * k + state for state in range(4) if any(j in leads for _, _, j in arcs[4 * k + state]))
    return [[a for a in out if a[2] in leads] for out in arcs]


def auction(arcs: list[list[Arc]], prices: list[int], origin: int) -> int:
    """Raise ``prices`` until a path of tight arcs leads from ``origin`` to the goal; its cost, INF if there is none.

    Prices never exceed the true distances and stay good for the next origin.
    """
    goal, path = len(arcs), [origin]
    while path[-1] != goal:
        node = path[-1]
        best, to = INF, -1
        for cost, _, j in arcs[node]:
            if cost + prices[j] < best:
                best, to = cost + prices[j], j
        if prices[node] < best:  # contract
            prices[node] = best
            if len(path) > 1:
                path.pop()
        elif best >= INF:
            return INF
        else:  # extend
            path.append(to)
    return prices[origin]


def trace(arcs: list[list[Arc]], prices: list[int], origin: int) -> tuple[str, int]:
    """Least audit among the tight paths from ``origin`` to the goal, and the state it ends in."""
    goal = len(arcs)
    leads = {goal: True}

    def tight(node: int) -> Iterator[Arc]:
        return (a for a in arcs[node] if a[0] + prices[a[2]] == prices[node])

    def alive(node: int) -> bool:
        if node not in leads:
            leads[node] = any(alive(j) for _, _, j in tight(node))
        return leads[node]

    letters, node = [], origin
    while True:
        _, letter, to = next(a for a in tight(node) if alive(a[2]))
        if to == goal:
            return "".join(letters), node % 4
        letters.append(letter)
        node = to


def solve(symbols: tuple[Symbol, ...]) -> str:
    """The audit of a whole conversation."""
    arcs = lattice(symbols, OVER)
    prices = [0] * (len(arcs) + 1)
    auction(arcs, prices, START)
    return trace(arcs, prices, START)[0]


def table(symbols: tuple[Symbol, ...], last: bool) -> list[int]:
    """Cheapest cost between the states at both ends of a chunk: 4 * state before + state behind."""
    out = [INF] * 16
    for end in range(4):
        arcs = lattice(symbols, tuple(0 if s == end else None for s in range(4)), last)
        prices = [0] * (len(arcs) + 1)
        for state in range(4):
            out[4 * state + end] = auction(arcs, prices, state)
    return out


def faults(rows: list[tuple[str, str]], known: list[bool] | None = None) -> list[int]:
    """First fault of each (role, text): blank, duplicate of an earlier row, truncated.

    ``known`` says which are duplicates where earlier rows lie elsewhere.
    """
    seen, out = set(), []
    for k, (role, text) in enumerate(rows):
        body = text.rstrip(BLANK)
        again = known[k] if known is not None else (role, text) in seen
        out.append(1 if not body else 2 if again else 3 if body[-1] not in ".!?" else 0)
        if known is None:
            seen.add((role, text))
    return out


def symbols_of(rows: list[tuple[str, str]], fault: list[int]) -> tuple[Symbol, ...]:
    return tuple((role[:1] if role[:1] in ("s", "u", "a") else "", f) for (role, _), f in zip(rows, fault))


def replay(rows: list[tuple[str, str]], fault: list[int], audit: str, state: int = START) -> tuple[list[tuple[str, str]], int]:
    """The repaired rows an audit stands for and its cost."""
    out, at, cost = [], 0, 0
    for letter in audit:
        if letter == "I":
            state, cost = NEXT[state], cost + INSERT
            out.append((ROLE[state], ""))
            continue
        role, text = rows[at]
        if letter == "D":
            cost += DELETE
        else:
            cost += (KEEP if letter == "K" else REROLE) + (TRUNCATED if fault[at] == 3 else 0)
            system = letter == "K" and state == START and role[:1] == "s"
            state = SYSTEM if system else NEXT[state]
            out.append((role if letter == "K" else ROLE[state], text))
        at += 1
    return out, cost


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _lines(repaired: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in repaired)


# --- Spark ---------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the damage its rows' crc32 stands for: conv_id, turn, role, text, copies.

    Nulls are one space in role, text and the text that is hashed. ``copies`` is 0 for a dropped row,
    2 for a repeated one.
    """
    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    return plain.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


_REPORT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _in_order(found: list[dict]) -> tuple[list[tuple[str, str]], list[int | None]]:
    """Rows by turn (null first), role and text, repeated as often as they are to be."""
    found = sorted(found, key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"].encode(), r["text"].encode()))
    rows = [(r["role"], r["text"]) for r in found for _ in range(r["copies"])]
    return rows, [r["turn"] for r in found for _ in range(r["copies"])]


def _audit(symbols: tuple[Symbol, ...]) -> str:
    """Conversations of the same roles and faults have one audit; a worker remembers some of them."""
    known = worker_cache().setdefault("audits", {})
    if symbols not in known:
        if len(known) >= 50_000:
            known.clear()
        known[symbols] = solve(symbols)
    return known[symbols]


def _whole(batches: Iterator[pa.RecordBatch], rows_wanted: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for conv_id, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows, turns = _in_order(found)
            fault = faults(rows)
            audit = _audit(symbols_of(rows, fault))
            repaired, cost = replay(rows, fault, audit)
            if rows_wanted:
                out += [(conv_id, k, role, text) for k, (role, text) in enumerate(repaired)]
                continue
            known = [t for t in turns if t is not None]
            gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
            counts = (gaps, *[fault.count(f) for f in (1, 2, 3)], illegal([r[:1] for r, _ in rows]), cost)
            out.append((conv_id, *counts, audit, hashlib.sha256(_lines(repaired).encode()).hexdigest()))
        schema = _REPAIRED if rows_wanted else _REPORT
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)


def _chunk_rows(found: list[dict], chunk: int, size: int) -> tuple[list[tuple[str, str]], list[int], str | None]:
    """A chunk's rows, their faults, and the initial of the row before it."""
    found = sorted(found, key=lambda r: r["rank"])
    own = [r for r in found if r["rank"] >= chunk * size]
    before = next((r["role"][:1] for r in found if r["rank"] < chunk * size), None)
    rows = [(r["role"], r["text"]) for r in own]
    return rows, faults(rows, [r["again"] for r in own]), before


_TABLE = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), ("costs", pa.list_(pa.int64()))])
_ENDS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("ends", pa.list_(pa.int64()))])
_WAYS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("audits", pa.list_(pa.string())), ("stops", pa.list_(pa.int64()))])
_WAY = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("audit", pa.string()), ("state", pa.int64())])
_PIECE = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), *[(c, pa.int64()) for c in COUNTS[1:]], ("audit", pa.string()),
                    ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def _each(step: Callable[[dict], tuple], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row out for each row in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            out = [step(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def _tables(size: int, row: dict) -> tuple:
    rows, fault, _ = _chunk_rows(row["rows"], row["chunk"], size)
    return row["conv_id"], row["chunk"], row["last"], table(symbols_of(rows, fault), row["last"])


def _ways(size: int, row: dict) -> tuple:
    rows, fault, _ = _chunk_rows(row["rows"], row["chunk"], size)
    arcs = lattice(symbols_of(rows, fault), tuple(None if e >= INF else e for e in row["ends"]), row["last"])
    prices = [0] * (len(arcs) + 1)
    found = []
    for state in range(4):
        auction(arcs, prices, state)
        found.append(trace(arcs, prices, state))
    return row["conv_id"], row["chunk"], [a for a, _ in found], [s for _, s in found]


def _pieces(size: int, row: dict) -> tuple:
    rows, fault, before = _chunk_rows(row["rows"], row["chunk"], size)
    repaired, cost = replay(rows, fault, row["audit"], row["state"])
    initials = ([] if before is None else [before]) + [r[:1] for r, _ in rows]
    counts = (*[fault.count(f) for f in (1, 2, 3)], illegal(initials), cost)
    return row["conv_id"], row["chunk"], *counts, row["audit"], [{"role": r, "text": t} for r, t in repaired]


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prices behind each chunk; chunks come last first, only four numbers are carried on."""
    ends: list[int] = []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["last"]:
                ends = [INF if e is None else e for e in OVER]
            out.append((row["conv_id"], row["chunk"], ends))
            costs = row["costs"]
            ends = [min(INF, *(costs[4 * s + e] + ends[e] for e in range(4))) for s in range(4)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_ENDS)], schema=_ENDS)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way taken through each chunk; chunks come first first, only the state is carried on."""
    state = START
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["chunk"] == 0:
                state = START
            out.append((row["conv_id"], row["chunk"], row["audits"][state], state))
            state = row["stops"][state]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_WAY)], schema=_WAY)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its pieces in order. Texts are fed to the digest and let go."""
    held: dict | None = None

    def done() -> pa.RecordBatch:
        values = [held["conv_id"], 0, *held["counts"], "".join(held["audit"]), held["digest"].hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _REPORT)], schema=_REPORT)

    for batch in slices(batches, 256):
        for row in batch.to_pylist():
            if row["chunk"] == 0:
                if held:
                    yield done()
                held = {"conv_id": row["conv_id"], "counts": [0] * 5, "audit": [], "digest": hashlib.sha256(), "any": False}
            held["counts"] = [a + row[c] for a, c in zip(held["counts"], COUNTS[1:])]
            held["audit"].append(row["audit"])
            if row["repaired"]:
                text = _lines([(r["role"], r["text"]) for r in row["repaired"]])
                held["digest"].update((("\n" if held["any"] else "") + text).encode())
                held["any"] = True
    if held:
        yield done()


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["__conv"])


def _renamed(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("conv_id", "__conv")


def _by_chunk(chunks: DataFrame, more: DataFrame) -> DataFrame:
    more = _renamed(more).withColumnRenamed("chunk", "__chunk")
    return chunks.join(more, _same(chunks, more) & (chunks["chunk"] == more["__chunk"])).drop("__conv", "__chunk")


def long_pieces(rows: DataFrame, sizes: DataFrame, size: int) -> DataFrame:
    """Chunks of long conversations, repaired: counts, audit and rows of each.

    ``rows`` (conv_id, turn, role, text) is a stored table, ``sizes`` (conv_id, n) small beside it.
    """
    ranked = numbered(rows, "conv_id", ["turn", "role", "text"], "rank").withColumn(
        "key", F.sha2(F.concat("role", F.lit(":"), "text").cast("binary"), 256))
    ranked = materialize(ranked, "ranked")
    first = ranked.groupBy(F.col("conv_id").alias("__conv"), F.col("key").alias("__key")).agg(F.min("rank").alias("__first"))
    again = ranked.join(first, _same(ranked, first) & (ranked["key"] == first["__key"])).select(
        "conv_id", "turn", "role", "text", "rank", (F.col("rank") > F.col("__first")).alias("again"))
    n = _renamed(sizes)
    own = F.floor(F.col("rank") / size)
    ends = F.col("rank") % size == size - 1  # the next chunk has to know the role before it
    placed = again.join(n, _same(again, n)).withColumn("lastly", F.floor((F.col("n") - 1) / size)).withColumn(
        "chunk", F.explode(F.when(ends & (own < F.col("lastly")), F.array(own, own + 1)).otherwise(F.array(own))))
    chunks = materialize(placed.groupBy("conv_id", "chunk", (F.col("chunk") == F.col("lastly")).alias("last")).agg(
        F.collect_list(F.struct("rank", "role", "text", "again")).alias("rows")), "chunks")
    costs = chunks.mapInArrow(_each(partial(_tables, size), _TABLE), "conv_id long, chunk long, last boolean, costs array<long>")
    ends = materialize(costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk")).mapInArrow(
        _backward, "conv_id long, chunk long, ends array<long>"), "ends")
    ways = _by_chunk(chunks, ends).mapInArrow(_each(partial(_ways, size), _WAYS), "conv_id long, chunk long, audits array<string>, stops array<long>")
    way = materialize(ways.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        _forward, "conv_id long, chunk long, audit string, state long"), "ways")
    schema = "conv_id long, chunk long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"
    return materialize(_by_chunk(chunks, way).mapInArrow(_each(partial(_pieces, size), _PIECE), schema), "pieces")


def _split(damaged: DataFrame, size: int) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Conversations that are one group, rows of the longer ones (None if there are none), and those's sizes."""
    n = damaged.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("held"))
    # Dropped rows count as well: they are in the group that is collected.
    long_ = settle(n.where(F.greatest("n", "held") > size).select("conv_id", "n"), "long-conversations")
    if long_.isEmpty():
        return damaged, None, long_
    of = _renamed(long_)
    here = _same(damaged, of)
    rows = damaged.join(of, here, "left_semi").select(
        "conv_id", "turn", "role", "text", F.explode(F.expr("CASE WHEN copies > 0 THEN sequence(1, copies) ELSE array() END"))).drop("col")
    return damaged.join(of, here, "left_anti"), materialize(rows, "long-rows"), long_


def _groups(damaged: DataFrame) -> DataFrame:
    return damaged.groupBy("conv_id").agg(F.collect_list(F.when(F.col("copies") > 0, F.struct("turn", "role", "text", "copies"))).alias("rows"))


def report(damaged: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row a conversation of ``damaged`` (see ``damage``): conv_id, gaps, faults, illegal, cost, audit, repaired_sha256."""
    short, rows, sizes = _split(damaged, size)
    out = _groups(short).mapInArrow(lambda batches: _whole(batches, False), REPORT)
    if rows is None:
        return out
    pieces = long_pieces(rows, sizes, size)
    summed = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(_digests, REPORT).drop("gaps")
    turns = _renamed(rows.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")))
    of = summed.join(turns, _same(summed, turns)).select(*out.columns)
    # A long conversation of which every row was dropped.
    none = sizes.where("n = 0").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in COUNTS], F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    return out.unionByName(of).unionByName(none)


def repaired_rows(damaged: DataFrame, size: int = CHUNK) -> DataFrame:
    """The repaired conversations: conv_id, place, role, text; places ascend, those of long conversations with gaps."""
    short, rows, sizes = _split(damaged, size)
    out = _groups(short).mapInArrow(lambda batches: _whole(batches, True), "conv_id long, place long, role string, text string")
    if rows is None:
        return out
    pieces = long_pieces(rows, sizes, size).select("conv_id", "chunk", F.posexplode("repaired").alias("at", "turn"))
    # A chunk of ``size`` rows never needs more than three turns a row.
    return out.unionByName(pieces.select("conv_id", (F.col("chunk") * (3 * size + 3) + F.col("at")).alias("place"), "turn.role", "turn.text"))


def repair_conversations(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """Damage, then repair: one row per conv_id of ``conversations`` (see ``report``).

    A null conv_id is a conversation of its own, null turns come first, null roles and texts are one
    space; rows of one turn are ordered by role and text. A role that starts with none of s, u and a
    can't be kept as it is. Conversations without a row left have zeros, an empty audit and the digest
    of nothing. Repeated rows are duplicates of each other. Other columns are ignored; an empty table
    has no rows.
    """
    return report(materialize(damage(conversations), "damaged"), size)


_NEXT_SQL = "CASE state WHEN 2 THEN 3 ELSE 2 END"
_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: The cheapest audits by dynamic programming over rows, the best (cost, audit) of each state kept.
ORACLE = f"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM base WHERE kind <> 0),
ranked AS (
  SELECT *, rtrim(text, {_BLANKS_SQL}) AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k
  FROM damaged),
marked AS (
  SELECT conv_id, turn, role, text, k, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS pair,
    CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM ranked),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
best(conv_id, k, state, cost, audit, repaired) AS (
  SELECT conv_id, 0::BIGINT, 0, 0::BIGINT, '', '' FROM counts
  UNION ALL
  SELECT conv_id, k, state, min(cost), arg_min(audit, {{'c': cost, 'a': audit}}), arg_min(repaired, {{'c': cost, 'a': audit}})
  FROM (
    SELECT m.conv_id, m.k, m.text, e.letter, i.audit || e.letter AS audit,
      i.cost + CASE e.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e.letter <> 'D' AND fault = 3 THEN 5 ELSE 0 END AS cost,
      CASE WHEN e.letter = 'D' THEN state WHEN e.letter = 'K' AND state = 0 AND left(role, 1) = 's' THEN 1 ELSE {_NEXT_SQL} END AS state,
      repaired || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
        ELSE chr(10) || CASE {_NEXT_SQL} WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || text END AS repaired
    FROM (
      SELECT conv_id, k, state, cost, audit, repaired FROM best
      UNION ALL
      SELECT conv_id, k, {_NEXT_SQL}, cost + 5, audit || 'I',
        repaired || chr(10) || CASE {_NEXT_SQL} WHEN 2 THEN 'user:' ELSE 'assistant:' END FROM best
      UNION ALL
      SELECT conv_id, k, CASE state WHEN 2 THEN 2 ELSE 3 END, cost + 10, audit || 'II',
        repaired || chr(10) || CASE state WHEN 2 THEN 'assistant:' || chr(10) || 'user:' ELSE 'user:' || chr(10) || 'assistant:' END FROM best
    ) i
    JOIN marked m ON m.conv_id IS NOT DISTINCT FROM i.conv_id AND m.k = i.k + 1
    JOIN (VALUES ('D'), ('K'), ('R')) e(letter) ON e.letter = 'D' OR fault IN (0, 3) AND (e.letter = 'R'
      OR state = 0 AND left(role, 1) = 's' OR left(role, 1) = CASE {_NEXT_SQL} WHEN 2 THEN 'u' ELSE 'a' END)
  ) GROUP BY conv_id, k, state),
ends AS (
  SELECT b.conv_id, b.cost, b.audit, b.repaired FROM best b JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.k = c.n WHERE state IN (0, 3)
  UNION ALL
  SELECT b.conv_id, b.cost + 5, audit || 'I', repaired || chr(10) || 'assistant:'
  FROM best b JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.k = c.n WHERE state = 2
  UNION ALL
  SELECT b.conv_id, b.cost + 10, audit || 'II', repaired || chr(10) || 'user:' || chr(10) || 'assistant:'
  FROM best b JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.k = c.n WHERE state = 1),
chosen AS (
  SELECT conv_id, min(cost) AS cost, arg_min(audit, {{'c': cost, 'a': audit}}) AS audit, arg_min(repaired, {{'c': cost, 'a': audit}}) AS repaired
  FROM ends GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(substr(repaired, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN chosen h ON o.conv_id IS NOT DISTINCT FROM h.conv_id
"""
