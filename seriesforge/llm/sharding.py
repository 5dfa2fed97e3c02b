"""Sharding by a k-d tree over document metadata with distributed weighted medians.

A node that has to give ``k`` shards is cut along its widest metadata dimension (size, language,
source; widths as shares of the whole table's range) at the weighted quantile that gives the left
child ``k // 2`` of them, until a leaf is one shard and holds its share of the bytes. Quantiles are
exact: byte sums by 12-bit digits of the coordinate, then of a hash that orders ties, close in on the
cut; a pass sums in the map tasks and returns one row a node. What a pass has to know of the nodes, at
most one a shard, is a broadcast table of literals, so every pass is the same compiled plan.

Equal texts are one item with the metadata of the group, so copies stay together. Groups larger than
``part`` of a shard are dealt out in parts by the place of the row in the stored table, so copies that
also share their id are dealt out as well: there are at most ``shards / part`` of them, which
bounds the broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import gapless, materialize

SHARDS, PART, OVERHEAD = 40, 1 / 256, 16
DIMS = ("size", "lang", "source")
DIGIT, COORDINATE, TIE = 12, 36, 60


@dataclass
class Node:
    """A node that gives the shards from ``first`` to ``first + count - 1``."""

    number: int
    first: int
    count: int
    dim: int = 0
    cut: tuple[int, int] | None = None  # coordinate and tie; smaller ones go left


def _initial(text: Column) -> Column:
    """The first six bytes of a string as a number, so strings have an order and a width."""
    bytes_ = F.rpad(F.hex(F.substring(F.coalesce(text, F.lit("")).cast("binary"), 1, 6)), 12, "0")
    return F.conv(bytes_, 16, 10).cast("double")


def _values(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A table of integer literals, one row a node."""
    listed = ", ".join(f"({', '.join(f'{int(v)}L' for v in row)})" for row in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {listed} AS t({names})"))


def _coordinate() -> Column:
    out = F.col("c0")
    for d in range(1, len(DIMS)):
        out = F.when(F.col("dim") == d, F.col(f"c{d}")).otherwise(out)
    return out


def _medians(placed: DataFrame, nodes: list[Node], weights: dict[int, int], tolerance: float) -> None:
    """Set the cut of each node at its weighted quantile, or as near as its rows allow."""
    target = {n.number: weights[n.number] * (n.count // 2) // n.count for n in nodes}
    below = {n.number: 0 for n in nodes}  # weight before the prefix
    prefix = {n.number: (0, 0) for n in nodes}  # coordinate and tie digits so far
    open_ = list(nodes)
    for r in range((COORDINATE + TIE) // DIGIT):
        if not open_:
            break
        on_tie = r >= COORDINATE // DIGIT
        shift = (COORDINATE + TIE if on_tie else COORDINATE) - DIGIT * (r + 1)
        known = _values(placed.sparkSession, "node, dim, on_tie, shift, cpre, tpre, goal", [
            (n.number, n.dim, on_tie, shift, *prefix[n.number], target[n.number] - below[n.number]) for n in open_])
        at, tie = F.when(F.col("on_tie") == 1, F.col("tie")).otherwise(_coordinate()), F.col("on_tie") == 1
        high, digit = (f"shiftright(at, int(shift + {DIGIT}))", f"shiftright(at, int(shift)) & {(1 << DIGIT) - 1}L")
        inside = F.when(tie, (_coordinate() == F.col("cpre")) & (F.expr(high) == F.col("tpre"))).otherwise(F.expr(high) == F.col("cpre"))
        near = placed.join(known, "node").withColumn("at", at).where(inside)
        sums = near.groupBy("node", "goal", F.expr(digit).alias("digit")).agg(F.sum("bytes").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("digit"))
        # One node's digits are at most 4,096 rows. The cut falls into the first that passes the goal.
        found = sums.withColumn("upto", upto).where("upto > goal and upto - w <= goal")
        rows = {row["node"]: row for row in found.collect()}
        still = []
        for n in open_:
            row, (c, t) = rows.get(n.number), prefix[n.number]
            if row is None:  # nothing beyond the goal: all to the left
                n.cut = (1 << (COORDINATE + 1), 0)
                continue
            before = below[n.number] + row["upto"] - row["w"]
            if on_tie:
                t = (t << DIGIT) | row["digit"]
            else:
                c = (c << DIGIT) | row["digit"]
            short, over = target[n.number] - before, before + row["w"] - target[n.number]
            if min(short, over) <= tolerance or r == (COORDINATE + TIE) // DIGIT - 1:
                step = 0 if short <= over else 1
                n.cut = (c, (t + step) << shift) if on_tie else ((c + step) << shift, 0)
            else:
                below[n.number], prefix[n.number] = before, (c, t)
                still.append(n)
        open_ = still


def place(items: DataFrame, shards: int, tolerance: float) -> DataFrame:
    """Items (c0, c1, c2, tie, bytes, ...) with their shard: the tree is grown level by level."""
    root = Node(0, 0, shards)
    placed, level, number, done = items.withColumn("node", F.lit(0).cast("long")), [root], 1, [root]
    while level := [n for n in level if n.count > 1]:
        extremes = [f(f"c{d}").alias(f"{name}{d}") for d in range(len(DIMS)) for name, f in (("low", F.min), ("high", F.max))]
        stats = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("bytes").alias("w"), *extremes).collect()}
        level = [n for n in level if n.number in stats]
        if not level:
            break
        for n in level:
            width = [stats[n.number][f"high{d}"] - stats[n.number][f"low{d}"] for d in range(len(DIMS))]
            n.dim = width.index(max(width))
        _medians(placed, level, {n.number: stats[n.number]["w"] for n in level}, tolerance)
        cuts, below = [], []
        for n in level:
            half = n.count // 2
            below += [Node(number, n.first, half), Node(number + 1, n.first + half, n.count - half)]
            cuts.append((n.number, n.dim, *n.cut, number, number + 1))
            number += 2
        known = _values(items.sparkSession, "node, dim, c, t, left, right", cuts)
        at = _coordinate()
        left = (at < F.col("c")) | ((at == F.col("c")) & (F.col("tie") < F.col("t")))
        moved = F.when(F.col("c").isNull(), F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
        placed = materialize(placed.join(known, "node", "left").select(*items.columns, moved.alias("node")), "level")
        done += below
        level = below
    shard = _values(items.sparkSession, "node, shard", [(n.number, n.first) for n in done])
    return placed.join(shard, "node").select(*items.columns, F.col("shard").cast("int").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, part: float = PART) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shards are near equal in size. A null text has no bytes and counts as
    empty; null languages and sources sort first; missing ``lang`` or ``source`` columns count as
    null. Slots number a shard's rows from 0. Repeated rows share a shard where one can hold them.
    grown_shard is null under this law.
    """
    meta = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in DIMS[1:]]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"), *meta,
            F.monotonically_increasing_id().alias("place"),
        ), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    most = max(1.0, total / shards * part)
    large = rows.groupBy("h").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > most)
    large = materialize(large.select("h", F.ceil(F.col("bytes") / most).cast("int").alias("parts")), "large-groups")
    dealt = rows.join(F.broadcast(large), "h", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("place"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    items = dealt.groupBy("h", "part").agg(
        F.sum("size").alias("bytes"), F.max("size").alias("size"), F.min("lang").alias("lang"), F.min("source").alias("source"))
    values = [F.log2("size"), _initial(F.col("lang")), _initial(F.col("source"))]
    items = materialize(items.select("h", "part", "bytes", *[v.alias(f"v{d}") for d, v in enumerate(values)]), "items")
    range_ = items.agg(*[f(f"v{d}").alias(f"{n}{d}") for d in range(len(DIMS)) for n, f in (("low", F.min), ("high", F.max))]).first()
    unit = lambda d: (F.col(f"v{d}") - F.lit(range_[f"low{d}"])) / F.lit(max(range_[f"high{d}"] - range_[f"low{d}"], 1e-9))
    coordinates = [
        F.least(F.floor(unit(d) * float(1 << COORDINATE)).cast("long"), F.lit((1 << COORDINATE) - 1)).alias(f"c{d}") if total else F.lit(0).cast("long").alias(f"c{d}")
        for d in range(len(DIMS))
    ]
    tie = F.shiftrightunsigned(F.xxhash64("h", "part"), 64 - TIE).alias("tie")
    items = materialize(items.select("h", "part", "bytes", *coordinates, tie), "coordinates")
    placed = place(items, shards, most / 2).select("h", "part", "shard")
    out = materialize(dealt.select("h", "part", "doc_id", "place", "size", "text_crc32").join(placed, ["h", "part"]), "sharded")
    return gapless(out, "shard", ["h", "doc_id", "place"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
